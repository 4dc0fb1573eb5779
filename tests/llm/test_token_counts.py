"""Counts without tokens against the tokenizers library's own unigram model."""

import public_tokenizers
from framequery.llm import token_counts as tc
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    t = Tokenizer(models.Unigram(pieces, 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tc.MARK, prepend_scheme="always")
    return t


def held(spark, docs, rows):
    own = library(tc.vocabulary(PATH))
    want = [(i, len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(tuple, tc.counts(docs, PATH).collect()), key=str) == sorted(want, key=str)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held(spark, docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_cases(spark):
    texts = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb \n c", f"x{tc.MARK}y", tc.MARK, f"{tc.MARK}z", "日本 語\u0000 😀😀 𝔘", "<0x41> <s>x</s> <unk>", "word " * 50_000, "y" * 3000]
    rows = [*enumerate(texts), (4, "a"), (None, "null id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    held(spark, df, rows)
    assert tc.counts(df.limit(0), PATH).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("ab▁", min_size=1, max_size=4), st.integers(-4, -1).map(float), min_size=1, max_size=12), st.text("abc ", max_size=12))
def test_ties(pieces, text):
    vocab = [("<unk>", 0.0), *((f"<0x{b:02X}>", -5.0) for b in range(256)), *pieces.items()]
    assert tc.WordCounts(vocab).total(text) == len(library(vocab).encode(text, add_special_tokens=False).ids)
