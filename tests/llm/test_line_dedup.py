"""Line dedup against a plain single-machine version, and the chunker's resistance to shifts."""

import pyarrow as pa
from framequery.llm import common, line_dedup


def plain(rows):
    """Texts after cutting all but the least (doc_id, line) copy of each chunk that counts."""
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for a, b in line_dedup.chunks(t) if t else ():
            own = "\n".join(t.split("\n")[a:b])
            if line_dedup._counts(own.split("\n")):
                first.setdefault(own, (i, a))
    out = []
    for i, t in rows:
        if not t or i is None:
            out.append((i, t))
            continue
        lines = t.split("\n")
        kept = []
        for a, b in line_dedup.chunks(t):
            own = "\n".join(lines[a:b])
            if first.get(own, (i, a)) == (i, a):
                kept += lines[a:b]
        out.append((i, "\n".join(kept)))
    return out


def held(df, rows):
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    held(docs, rows)
    assert line_dedup.dedup_lines(docs).columns == docs.columns


def test_planted_passages_go_once(spark):
    line = lambda k: f"alone {k} " + " ".join(f"w{k}x{j}" for j in range(12))
    passage = "\n".join(" ".join(f"p{r}q{j}" for j in range(60)) for r in range(2))
    short = "\n".join(" ".join(f"s{r}t{j}" for j in range(8)) for r in range(12))
    rows = [(k, "\n".join([line(k), passage, line(-k), short, line(k + 1000)])) for k in range(1, 20)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1]
    for k in range(2, 20):
        assert passage.split("\n")[0] not in got[k] and passage.split("\n")[1] not in got[k]
        assert sum(part in got[k] for part in short.split("\n")) <= 6
        assert line(-k) in got[k] or line(-k) + "\n" in got[k]


def test_edge_cases(spark):
    long = "\n".join(f"line {k} of a very long text" for k in range(5000))
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "one line"), (5, "one line"), (6, long), (7, long), (7, long), (None, long), (8, "a b\nc d\ne f\ng h"), (9, "a b\nc d\ne f\ng h")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, first int, h string")
    held(df, rows)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_chunks_cover_and_resist_shifts():
    lines = [f"{k} {k * 7919 % 104729} text" for k in range(400)]
    whole = line_dedup.chunks("\n".join(lines))
    assert [a for a, _ in whole] == [0, *[b for _, b in whole[:-1]]] and whole[-1][1] == 400
    shifted = line_dedup.chunks("\n".join(["new first line", *lines]))
    ends = {b for _, b in whole}
    assert len(ends & {b - 1 for _, b in shifted}) > 0.9 * len(ends)


def plain_passages(rows):
    """Texts without the lines of later copies of any run of LONG_WORDS words, by trying every run."""
    first, runs = {}, []
    for i, t in sorted(rows):
        lines = t.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[a:b]) >= line_dedup.LONG_WORDS:
                    runs.append((i, a, b, "\n".join(lines[a:b])))
                    first.setdefault(runs[-1][3], (i, a))
    gone = {(i, k) for i, a, b, own in runs if first[own] != (i, a) for k in range(a, b)}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_passages_of_short_lines_go_whole(spark):
    rows, unique = [], lambda k: f"alone {k} " + " ".join(f"w{k}x{j}" for j in range(12))
    shapes = [(2, 30), (3, 20), (5, 12), (10, 8), (20, 10)]
    plant = ["\n".join(" ".join(f"p{n}r{r}q{j}" for j in range(words)) for r in range(n)) for n, words in shapes]
    for k in range(12):
        parts = [x for m, p in enumerate(plant) for x in (unique(100 * k + m), p)]
        rows.append((k, "\n".join([*parts, unique(100 * k + 99)])))
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_passages(rows)
    assert got[0] == rows[0][1]
    for k in range(1, 12):
        assert got[k].split("\n") == [unique(100 * k + m) for m in (0, 1, 2, 3, 4, 99)]


def test_passages_edge_cases(spark):
    like = "\n".join(["same words here again"] * 30)
    one = " ".join(f"o{j}" for j in range(60))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "one line"), (5, "one line"), (6, like), (7, f"x\n{one}\ny"), (7, f"x\n{one}\ny"), (7, f"z\nz\n{one}"), (8, f"{one}\nend"), (None, f"n\n{one}"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_passages(df, count_col="cut")
    want = [(1, None, 0), (2, "", 0), (3, "\n\n", 0), (4, "one line", 0), (5, "one line", 0), (6, "\n".join(["same words here again"] * 10), 20), (7, "x\ny", 1), (7, "x\ny", 1), (7, "z\nz", 1), (8, "end", 1), (None, f"n\n{one}", 0), (None, None, 0)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert line_dedup.dedup_passages(df.limit(0)).count() == 0


def test_stray_rows_of_an_id_keep_no_chunk(spark):
    """A second null id, or a repeated id with another or a null text, once made a shared chunk look like two texts."""
    long = " ".join(f"o{j}" for j in range(60))
    shared = [(1, long), (2, f"a\n{long}"), (3, long)]
    for stray in ([(None, long), (None, "other\ntext")], [(None, long), (None, None)], [(3, "other\ntext")], [(3, None)]):
        df = spark.createDataFrame([*shared, *stray], "doc_id long, text string")
        got = [tuple(r) for r in line_dedup.dedup_lines(df).collect()]
        want = [(1, "" if (None, long) in stray else long), (2, "a"), (3, ""), *stray]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert sorted(map(tuple, line_dedup.dedup_passages(df).collect()), key=str) == sorted(want, key=str)


def test_digests_that_stand_for_several_texts(spark, monkeypatch):
    """With three digests in all, each stands for many texts; the byte comparison tells them apart."""
    monkeypatch.setattr(line_dedup, "_digest", lambda digests: (len(digests) % 3, 0))
    passage = lambda name, n: "\n".join(" ".join(f"{name}{r}x{j}" for j in range(21)) for r in range(n))
    rows = [(k, "\n".join([f"own {k} start", passage(f"p{k % 3}", 4), passage(f"q{k % 2}", 3), f"own {k} end"])) for k in range(8)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_passages(rows)


def test_many_copies_of_one_chunk(spark):
    """A chunk that most rows hold is a hot key; it goes by broadcast, and the result is the same."""
    shared = " ".join(f"s{j}" for j in range(50))
    rows = [(k, f"{shared}\nown line {k}") for k in range(3000)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[k] == f"own line {k}" for k in range(1, 3000))


def plain_runs(rows):
    """Texts of {id: text} rows without later copies of chunks that count and of smallest runs, keyed by the text itself."""
    first, spans = {}, []
    for i, t in sorted(rows):
        lines = t.split("\n")
        n = [len(x.split()) for x in lines]
        own = {(a, b) for a, b in line_dedup.chunks(t) if line_dedup._counts(lines[a:b])}
        worded = [k for k, x in enumerate(n) if x]
        for a in worded:
            own |= {(a, b + 1) for b in [next((b for b in worded if b >= a and sum(n[a : b + 1]) >= line_dedup.LONG_WORDS), None)] if b is not None}
        for b in worded:
            own |= {(a, b + 1) for a in [next((a for a in reversed(worded) if a <= b and sum(n[a : b + 1]) >= line_dedup.LONG_WORDS), None)] if a is not None}
        for a, b in sorted(own):
            spans.append((i, a, b, "\n".join(lines[a:b])))
            first.setdefault(spans[-1][3], (i, a, b))
    gone = set()
    for i, a, b, text in spans:
        j, c, d = first[text]
        if (i, a) != (j, c):
            gone |= {(i, k) for k in range(max(a, d) if i == j else a, b)}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_passages_of_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(docs).select("doc_id", "text").collect()}
    assert got == plain_runs(rows)


def test_batches_are_read_in_slices():
    texts = ["a" * 700_000, None, "b" * 500_000, "", "c" * 3_000_000, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["k", "text"])
    parts = list(common.slices(batch, 1))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6))
    assert len(parts) > 3 and all(p.num_rows == 1 or p.nbytes < (1 << 20) + 1000 for p in parts)
    assert not list(common.slices(batch.slice(0, 0), 1))
