"""Packing: every id in its place, no gap or overlap, and few sequences."""

import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from framequery.llm import packing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows):
    library = Tokenizer.from_file(PATH)
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            yield i, k, at, len(own), zlib.crc32(np.asarray(own, "<u4").tobytes())


def held(got, rows):
    want = list(plain_pieces(rows))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(w[3] for w in want) // 2048)
    assert len(by) <= least * 1.02 + 2


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held(packing.packed(docs, PATH).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "tiger " * 5000), (4, "<|endoftext|> x"), (5, " \n "), (6, "Ünï  cödé  x")]
    df = spark.createDataFrame([(*r, 5, "q") for r in rows], "doc_id long, text string, length int, rank string")
    held(packing.packed(df, PATH).collect(), rows)
    assert packing.packed(df.limit(0), PATH).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), min_size=1, max_size=12))
def test_plan_uses_up_the_histogram(histogram):
    p = packing.plan(histogram, 30)
    used = sum((c * n for c, n in p.configurations), np.zeros(len(p.lengths), np.int64))
    assert dict(zip(p.lengths.tolist(), used.tolist(), strict=True)) == histogram
    assert all((c * p.lengths).sum() <= 30 for c, _ in p.configurations)
    assert p.bound <= p.sequences <= p.bound * 1.15 + 2


def test_knapsack_against_all_configurations():
    lengths, values = np.array([3, 5, 7]), np.array([2.0, 3.9, 5.2])
    counts, value = packing.best_configuration(lengths, values, 16)
    every = [c for k in range(6) for c in combinations_with_replacement(range(3), k) if sum(lengths[list(c)]) <= 16]
    assert value == pytest.approx(max(values[list(c)].sum() for c in every))
    assert (counts * values).sum() == pytest.approx(value) and (counts * lengths).sum() <= 16


@pytest.mark.parametrize("capacity", [64, 2048])
def test_the_program_gives_most_sequences(capacity):
    rng = np.random.default_rng(3)
    for n in (200, 5000):
        lengths, counts = np.unique(np.minimum(capacity, rng.lognormal(np.log(capacity / 4), 1.0, n).astype(int) + 1), return_counts=True)
        p = packing.plan(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), capacity)
        assert p.programmed >= p.sequences / 2
        assert p.sequences <= p.bound * 1.02 + 2


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.tuples(st.floats(0.1, 9), st.integers(1, 4)), min_size=1, max_size=4))
def test_bounded_knapsack_against_all_choices(items):
    lengths = np.array(sorted(items))
    values, stock = np.array([items[int(n)][0] for n in lengths]), np.array([items[int(n)][1] for n in lengths])
    counts = packing.priced_configuration(lengths, values, stock, 17)
    assert (counts <= stock).all() and (counts * lengths).sum() <= 17
    every = np.stack(np.meshgrid(*[np.arange(n + 1) for n in stock], indexing="ij"), -1).reshape(-1, len(lengths))
    best = (every @ values)[(every @ lengths) <= 17].max()
    assert counts @ values == pytest.approx(best)
