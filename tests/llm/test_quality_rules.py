"""Quality rules: counts against regular expressions, rules against planted labels."""

import re

import numpy as np
from framequery.llm import quality_rules as q
from hypothesis import given, settings
from hypothesis import strategies as st


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    worded = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(worded) - len(set(worded)), len(inside)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "\n", "é", "#", "\xa0", "\x1c", "\t", "|", "\x85"]), max_size=60).map("".join))
def test_counts(text):
    assert q.text_stats(text)[:5] == plain_stats(text)


def test_whole_table(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rules = q.fit(docs, labels)
    got = q.judge(docs, labels).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = plain_stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        hits = [k for k, rule in enumerate(rules, 1) if all(holds(c, r) for c in rule)]
        assert r.rule == (hits[0] if hits else 0) and r.kept == (not r.base_failed and not hits)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {r.doc_id for r in got if r.kept}
    assert len(good & kept) > 0.95 * len(good & {r.doc_id for r in got if not r.base_failed})


def holds(c, r):
    chars, words, lines = max(1, r.word_chars), max(1, r.n_words), max(1, r.n_lines)
    x = {"n_words": r.n_words, "mean_word": r.word_chars / words, "symbol_share": r.n_symbols / chars, "dup_line_share": r.n_dup_lines / lines, "repeat_share": r.n_repeat_words / words, "upper_share": r.n_upper / chars, "bang_share": r.n_bang / chars, "words_per_line": r.n_words / lines}
    return x[c.feature] >= c.threshold if c.at_least else x[c.feature] <= c.threshold


def test_learns_planted_rules():
    rng = np.random.default_rng(3)
    x = {n: rng.random(3000) for n in ("u", "v", "w")}
    bad = ((x["u"] > 0.8) & (x["v"] < 0.4)) | (x["w"] > 0.93)
    rules = q.learn(x, bad, np.arange(3000) % 3)
    found = np.zeros(3000, bool)
    for r in rules:
        found |= q._covers(r, x)
    assert len(rules) >= 2 and (found == bad).mean() > 0.98
    assert q.learn(x, np.zeros(3000, bool), np.arange(3000) % 3) == []
    assert q.learn(x, rng.random(3000) < 0.5, np.arange(3000) % 3) == []


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " ".join(f"word{k}" for k in range(60_000)), 0), (None, "one two three four five six seven eight nine ten", 1), (4, "same " * 40, 2), (4, "same " * 40, 2)], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    got = sorted(q.judge(docs, labels).select("doc_id", "n_words", "base_failed", "kept").collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, 0, True, False), (2, 0, True, False), (3, 60_000, False, True), (None, 10, False, True), (4, 40, True, False), (4, 40, True, False)], key=str)
    assert q.keep_good(docs, labels.limit(0)).columns == docs.columns
    assert q.judge(docs.limit(0), labels).count() == 0
