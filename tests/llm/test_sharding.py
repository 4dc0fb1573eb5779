"""Histogram sort against cuts by a plain running sum."""

import hashlib
import zlib
from collections import Counter

import pytest
from framequery.llm import sharding
from pyspark.sql import functions as F


def key(text, i):
    return tuple(hashlib.md5(("" if x is None else str(x)).encode()).hexdigest()[:15] for x in (text, i))


def plain(docs, n):
    rows = sorted(((*key(t, i), len((t or "").encode()) + 16, i, t) for i, t in docs), key=lambda r: r[:2])
    total, largest, group = sum(r[2] for r in rows), max(r[2] for r in rows), Counter()
    for r in rows:
        group[r[0]] += r[2]
    out, slots, below, start = [], Counter(), 0, {}
    for a, _, size, i, t in rows:
        start.setdefault(a, below)
        low, own = (start[a], group[a]) if group[a] <= largest else (below, size)
        shard = ((2 * low + own) * n - 1) // (2 * total)
        out.append((i, size, zlib.crc32((t or "").encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        below += size
    return sorted(out, key=str)


def held(rows, docs, n):
    """The law by itself: gapless slots, and each shard's bytes within the largest row of an equal share."""
    sizes = Counter()
    slots = {}
    for r in rows:
        sizes[r.shard] += r.size if isinstance(r.size, int) else r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    share, largest = sum(sizes.values()) / n, max(r["size"] for r in rows)
    assert all(0 <= k < n for k in sizes) and all(abs(sizes[k] - share) <= largest for k in range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((str(r.doc_id), r.text_crc32) for r in rows) == Counter((str(i), zlib.crc32((t or "").encode())) for i, t in docs)


@pytest.mark.parametrize("probes", [16, 1 << 16])
def test_whole_table(spark, sf, monkeypatch, probes):
    monkeypatch.setattr(sharding, "PROBES", probes)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.digest(docs).collect()
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=str) == plain(pairs, 40)
    held(got, pairs, 40)


def test_groups_and_many_parts(spark, tmp_path):
    docs = [(k, "copy " * 40 if k % 3 == 0 else f"text {k} " * (k % 11)) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sharding.digest(df, 13).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, 13)
    held(got, docs, 13)
    # several parts a shard move the same rows to the same shards, and the files hold whole rows in order
    sharding.write(df, str(tmp_path / "s"), 13, part_bytes=900)
    rows = sharding.read(spark, str(tmp_path / "s"), df.schema)
    assert rows.columns == ["doc_id", "text", "shard", "slot"]
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in got)
    assert rows.select(F.count_distinct("shard")).first()[0] == 13


def test_a_third_of_the_rows_are_one_row(spark):
    docs = [(7, "the same row")] * 1000 + [(k, f"own {k} " * 3) for k in range(1000, 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9, F.col("doc_id") % 9)
    got = sharding.digest(df, 13).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    share = sum(sizes.values()) / 13
    assert len(got) == 3000 and all(abs(sizes[k] - share) < 0.03 * share for k in range(13))
    assert sorted((r.shard, r.slot) for r in got) == [(k, s) for k in range(13) for s in range(sum(r.shard == k for r in got))]


def test_edge_cases(spark, tmp_path):
    docs = [(1, None), (2, ""), (None, "é" * 9), (4, "x " * 30_000), (4, "x " * 30_000), (5, "y"), (-6, "y")]
    rows = [(*d, 3, "k", 0.5) for d in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, _key string, slot double")
    for n in (1, 3, 40):
        got = sharding.digest(df, n).collect()
        assert Counter((str(r.doc_id), r["size"]) for r in got) == Counter((str(i), len((t or "").encode()) + 16) for i, t in docs)
        assert all(0 <= r.shard < n for r in got)
    sharding.write(df, str(tmp_path / "s"), 3)
    back = sharding.read(spark, str(tmp_path / "s"), df.schema, "in_shard", "in_slot")
    assert Counter(map(str, back.drop("in_shard", "in_slot").collect())) == Counter(map(str, df.collect()))
    assert sharding.digest(df.limit(0)).count() == 0
