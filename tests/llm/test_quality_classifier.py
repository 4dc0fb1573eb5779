"""Co-training: views against plain counts, the learner on planted data, held-out accuracy on the tables."""

import numpy as np
import xxhash
from framequery.llm import quality_classifier as q


def plain_odds(model, text, lang, source, n_chars):
    words = {}
    for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text if c not in ".,:;").encode().split():
        k = xxhash.xxh64_intdigest(w) % q.WORD_BUCKETS
        words[k] = words.get(k, 0) + 1
    v = {k: np.log1p(min(n, 255)) * model.idf[k] for k, n in words.items()}
    norm = np.sqrt(max(1e-12, sum(x * x for x in v.values())))
    z_text = sum(x / norm * model.text.w[k] for k, x in v.items()) + model.text.b
    form = np.array(q.page_form(text, n_chars), np.float32)
    ones = [np.searchsorted(model.edges[k], form[k]) + k * (q.BINS + 1) for k in range(len(form))]
    names = [xxhash.xxh64_intdigest(f"{kind}={x}".encode()) % q.NAME_BUCKETS for kind, x in (("lang", lang), ("source", source))]
    ones += [len(form) * (q.BINS + 1) + names[0], len(form) * (q.BINS + 1) + q.NAME_BUCKETS + names[1]]
    return z_text, sum(model.page.w[k] for k in ones) / np.sqrt(len(ones)) + model.page.b


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    model = q.co_train(q.labelled_features(docs, labels))
    for r in docs.orderBy("doc_id").limit(60).collect():
        a, b, c = model.scores(*(np.array([z]) for z in plain_odds(model, r.text, r.lang, r.source, r.n_chars)))
        g = got[r.doc_id]
        assert np.allclose([g.text_score, g.page_score, g.score], [a[0], b[0], c[0]], atol=1e-6)
    truth = {r.doc_id: r.good for r in q.good_label(labels).collect()}
    held = [i for i in truth if xxhash.xxh64_intdigest(str(i).encode(), 5) % 5 == 0]
    clean = [got[i].kept for i in truth if truth[i]]
    assert np.mean(clean) > 0.97
    assert np.mean([(got[i].score > 0.5) == truth[i] for i in held]) > 0.8
    junk = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert np.mean([not got[i].kept for i in junk]) > 0.8


def test_a_view_teaches_the_other(spark):
    """Only the words tell good from bad where labels are; page form follows them on unlabelled pages."""
    rng = np.random.default_rng(2)
    good = rng.random(400) < 0.5
    rows = [(i, " ".join(rng.choice(["fine", "nice", "calm"] if g else ["bad", "foul", "rank"], 12)) + ("" if g else " !!!!!!"), "en", f"s{i % 3}", None) for i, g in enumerate(good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in enumerate(good[:40])], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert np.mean([(got[i].score > 0.5) == g for i, g in enumerate(good)]) > 0.98
    assert np.mean([(got[i].page_score > 0.5) == g for i, g in enumerate(good)]) > 0.9


def test_edge_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "x y", "en", "a", 3), (3, "word " * 60_000, "en", "b", 300_000), (4, "!!! ###", None, "b", -5)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")
    labels = spark.createDataFrame([(1, 0, None), (3, 1, 0), (3, 1, 0), (4, None, 1), (None, 1, 0), (2, 0, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = q.classify(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "4", "None"]
    assert all(0 <= r.score <= 1 for r in got)
    assert q.classify(docs.limit(0), labels).count() == 0
    one = q.classify(docs, labels.where("quality = 1")).collect()
    assert {(r.score, r.kept) for r in one} == {(1.0, True)}
    assert {r.score for r in q.classify(docs, labels.limit(0)).collect()} == {0.5}
    bare = docs.select("doc_id", "text")
    assert q.classify(bare, labels).count() == len(rows)


def test_toxic_words_show_in_long_texts(spark):
    """A few insults in a long text; half of the toxic documents have no label."""
    rng = np.random.default_rng(5)
    plain = [f"w{k}" for k in range(3000)]
    rows, toxic = [], rng.random(600) < 0.3
    for i, bad in enumerate(toxic):
        words = list(rng.choice(plain, 400 if i % 2 else 40))
        for at, w in zip(rng.integers(0, len(words), 3), rng.choice(["slur", "jeer", "taunt", "sneer", "scoff"], 3), strict=True):
            words[at] = w if bad else words[at]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(toxic) if i % 4 < 2], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in q.classify(docs, labels).collect()}
    assert np.mean([not kept[i] for i, t in enumerate(toxic) if t]) > 0.95
    assert np.mean([kept[i] for i, t in enumerate(toxic) if not t]) > 0.95


def test_toxic_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.kept for r in q.classify(docs, labels).collect()}
    toxic = [r.doc_id for r in labels.where("toxic = 1").collect() if xxhash.xxh64_intdigest(str(r.doc_id).encode(), 5) % 5 == 0 or r.quality == 1]
    assert np.mean([not got[i] for i in toxic]) > 0.6


def test_labels_that_training_never_saw(spark):
    """A third split: a seventh of the labelled documents takes part in neither fit, calibration nor threshold."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.kept for r in q.classify(docs, labels.where("doc_id % 7 != 3")).collect()}
    unseen = labels.where("doc_id % 7 = 3").collect()
    clean = [got[r.doc_id] for r in unseen if r.quality == 1 and r.toxic == 0]
    junk = [not got[r.doc_id] for r in unseen if r.quality == 0]
    toxic = [not got[r.doc_id] for r in unseen if r.toxic == 1]
    print(f"unseen: clean kept {np.mean(clean):.3f} of {len(clean)}, junk caught {np.mean(junk):.3f} of {len(junk)}, toxic caught {np.mean(toxic):.3f} of {len(toxic)}")
    assert np.mean(clean) > 0.97 and np.mean(junk) > 0.85 and np.mean(toxic) > 0.6


def test_repeated_ids_stay_bounded(spark):
    """Rows that repeat an id with another text count once in every sample that reaches the driver."""
    rows = [(i % 20, f"good fine word{i}" if i % 2 else f"bad !!! foul{i}", "en", "a", None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    features = q.labelled_features(docs, labels)
    model = q.co_train(features, rounds=1)
    found = q.surest(features, model, frozenset(), 3)
    assert all(t.num_rows == 3 and len(set(t.column("doc_id").to_pylist())) == 3 for t in found.values())
    assert q.classify(docs, labels).count() == 400
