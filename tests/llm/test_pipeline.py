"""The pipeline's stages against plain versions, each judged on its own input."""

import corpus_pipeline as pipeline
from framequery.llm import mixing, quality_rules

from .test_line_dedup import plain_runs
from .test_packing import held as packed_right
from .test_quality_rules import plain_stats
from .test_simhash import plain_components, plain_fingerprint


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_on_their_own_input(spark, sf):
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    (_, rules), (_, lines), (_, near), (_, mix), (_, pack) = pipeline.STAGES

    good = rules(spark, docs, sf).cache()
    assert good.columns == columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    want = quality_rules.judge(docs, labels).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in want.collect()) == sorted(r.doc_id for r in good.collect())

    cut = lines(spark, good, sf).cache()
    assert cut.columns == columns
    by_id = dict(rows_of(good))
    assert len(by_id) == good.count()
    assert dict(rows_of(cut)) == plain_runs(list(by_id.items()))

    single = near(spark, cut, sf).cache()
    assert single.columns == columns
    ids, texts = zip(*rows_of(cut), strict=True)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(plain_components([plain_fingerprint(t) for t in texts], ids)))

    mixed = mix(spark, single, sf).cache()
    assert mixed.columns == columns
    packed_right(pack(spark, mixed, sf).collect(), rows_of(mixed))


def test_run_is_the_stages(spark, sf):
    """run() against a plain run: plain rules, passages, fingerprints and pieces, and the mix's own rows in between."""
    got = pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.fit(docs, labels)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    source = {i: s for i, _, s in rows}
    good = [(i, t) for i, t, _ in rows if plain_kept(t, rules)]
    cut = plain_runs(good)
    ids = sorted(cut)
    single = sorted(set(plain_components([plain_fingerprint(cut[i]) for i in ids], ids)))
    left = spark.createDataFrame([(i, cut[i], source[i]) for i in single], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mixture(left).collect()}
    mixed = [(i, cut[i]) for i in single for _ in range(copies[i])]
    packed_right(got.collect(), mixed)


def plain_kept(text, rules):
    """The base rules and the learned list over one text's counts, worked out again here."""
    counts = dict(zip(quality_rules._FIELDS, (*plain_stats(text), sum("A" <= c <= "Z" for c in text), text.count("!"), text.count("\n") + 1), strict=True))
    chars, words, lines = (max(1, counts[c]) for c in ("word_chars", "n_words", "n_lines"))
    x = {
        "n_words": counts["n_words"], "mean_word": counts["word_chars"] / words, "symbol_share": counts["n_symbols"] / chars, "dup_line_share": counts["n_dup_lines"] / lines,
        "repeat_share": counts["n_repeat_words"] / words, "upper_share": counts["n_upper"] / chars, "bang_share": counts["n_bang"] / chars, "words_per_line": counts["n_words"] / lines,
    }
    if counts["n_words"] < 10 or 100 * counts["n_repeat_words"] > 20 * counts["n_words"]:
        return False
    hold = lambda c: x[c.feature] >= c.threshold if c.at_least else x[c.feature] <= c.threshold
    return not any(all(hold(c) for c in rule) for rule in rules)
