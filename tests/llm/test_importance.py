"""Importance resampling against a plain version on whole texts."""

import hashlib
import math
import re
import zlib

import numpy as np
from framequery.llm import importance

OUT = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]], len(w)


def plain(docs, bench):
    s, t = [0] * 10_000, [0] * 10_000
    own = [(i, *features(x)) for i, x in docs]
    for _, f, _ in own:
        for b in f:
            s[b] += 1
    for x in bench:
        for b in features(x)[0]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for i, f, n in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 25 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def same(spark, docs, bench):
    found = importance.resample(docs, bench)
    assert found.columns == OUT and {f.dataType.simpleString() for f in found.schema.fields} == {"bigint"}
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in bench.select("text").collect()])
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == want
    return got


def test_whole_table(spark, sf):
    rows = same(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert sum(r[4] is not None for r in rows) > 10


def test_edge_cases(spark):
    words = " ".join(f"w{k % 37}" for k in range(60))
    texts = [None, "", " .,;", "A", "ÀB aB\x00c-d_e", "x" * 300 + " " + "y" * 700 + " z", words, words, words.upper(), "é" * 200 + " ü" * 30, ("lorem IPSUM, " * 60_000) + "end"]
    rows = [(k, x, 5, "p") for k, x in enumerate(texts)] + [(None, words, 1, None), (6, words, 5, "p"), (6, words, 5, "p"), (-3, words, 5, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int, buckets string")
    bench = spark.createDataFrame([("i1", "lorem ipsum w1 w2"), ("i2", None), ("i3", "")], "item_id string, text string")
    same(spark, docs, bench)
    same(spark, docs, bench.limit(0))
    assert importance.resample(docs.limit(0), bench).count() == 0


def test_hot_id_and_pieces(spark, monkeypatch):
    # a third of the rows repeat one row; the ranks still run without gaps
    words = " ".join(f"w{k % 37}" for k in range(60))
    docs = spark.createDataFrame([(k if k % 3 else 3, words if k % 3 == 0 else f"{words} {k}") for k in range(600)], "doc_id long, text string")
    bench = spark.createDataFrame([("a", "w1 w2 w3")], "item_id string, text string")
    same(spark, docs.repartition(7), bench)
    monkeypatch.setattr(importance, "PIECE", 5)
    own = importance.Splitter()
    text = "one two-three  four " * 9 + "five" * 20
    flat, ends = own.buckets([text, "", text])
    want = features(text)[0]
    assert sorted(flat[: ends[0]]) == sorted(want) == sorted(flat[ends[1] :]) and ends[0] == ends[1] and isinstance(flat, np.ndarray)
