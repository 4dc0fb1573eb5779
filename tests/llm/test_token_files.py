"""Token files: the ids read back are the library's own, in document order."""

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from framequery.llm import token_files
from framequery.llm.common import scratch
from framequery.llm.tokens import Encoder
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", " a", "a ", " ", "a\n b", "a \n\n b", "\t", "x  y", "<|endoftext|> a", "it's 3 o'clock", "é　x", "a\x1c b"]


def held(spark, docs, rows):
    path = scratch(spark, "test-tokens")
    token_files.write(docs, path, PATH)
    library = Tokenizer.from_file(PATH)
    got = sorted(token_files.digest(spark, path).collect(), key=lambda r: (r.start, r.n_tokens))
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = lambda t: np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(((i, len(ids(t)), zlib.crc32(ids(t).tobytes())) for i, t in rows), key=str)
    return path


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    path = held(spark, docs, rows)
    part = token_files.read(spark, path, F.col("doc_id").between(10, 12))
    assert sorted(r.doc_id for r in part.select("doc_id").collect()) == [10, 11, 12]
    for f in Path(path.removeprefix("file:")).glob("part-*"):
        column = pq.ParquetFile(f).metadata.row_group(0)
        kinds = {column.column(i).path_in_schema: column.column(i).encodings for i in range(3)}
        assert "DELTA_BINARY_PACKED" in kinds["doc_id"] and any("DICTIONARY" in e for e in kinds["ids.list.element"])
        assert column.column(0).has_offset_index and column.column(0).has_column_index


def test_edge_cases(spark):
    rows = [(3, None), (1, ""), (1, "twice"), (1, "twice"), (None, "no id"), (9, "long words " * 20_000), *((20 + k, t) for k, t in enumerate(ODD))]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, ids int, part string")
    held(spark, df, rows)
    path = scratch(spark, "test-tokens")
    token_files.write(df.limit(0), path, PATH)
    assert token_files.digest(spark, path).count() == 0


def test_kept_units_change_nothing(monkeypatch):
    own = Encoder(PATH)
    for t in [*ODD, "the cat. the cat, the\ncat", "tail words"]:
        assert list(own.encode([t, "the cat.", t])) == [own.whole(t), own.whole("the cat."), own.whole(t)]


OWN = {name: Encoder(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "The", "é", " ", " ", "\n", "\n", ".", ",", "!", "'s", "'", "1", "\t", "\xa0", "\u3000", "\x1c", "́", "|", "Σ", "😀"]), max_size=25).map("".join))
def test_any_mixture_of_spaces_and_signs(text):
    for own in OWN.values():
        assert list(own.encode([text])) == [own.whole(text) if text else b""]
