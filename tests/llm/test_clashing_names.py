"""Operators that return the table's columns leave all of them alone, also those named as their helpers."""

import pytest
from framequery.llm import line_dedup, mixing, pii, quality_rules, simhash

HELPERS = ["__found", "__new", "__id", "__row", "__spans", "__wrong", "__stat_n_words", "__label_id", "__quality", "__mix_source", "__mix_size", "__mix_copies", "__row0", "__row1", "__rest_", "root", "doc.id"]


@pytest.mark.parametrize("name", ["pii", "lines", "passages", "rules", "mix", "one"])
def test_helper_names(spark, name):
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(k, f"{word} {k} call +1 521-555-6210\nlambda mu nu xi omicron pi rho sigma tau {k * 7}", f"s{k % 2}") for k in range(12)]
    df = spark.createDataFrame([(*d, *range(3, 3 + len(HELPERS))) for d in docs], "doc_id long, text string, source string, " + ", ".join(f"`{h}` int" for h in HELPERS))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    out = {
        "pii": lambda: pii.pseudonymize(df, "key"),
        "lines": lambda: line_dedup.dedup_lines(df),
        "passages": lambda: line_dedup.dedup_passages(df),
        "rules": lambda: quality_rules.keep_good(df, labels),
        "mix": lambda: mixing.mix(df),
        "one": lambda: simhash.keep_one(df),
    }[name]()
    assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    rows = out.collect()
    assert rows and all(list(r)[3:] == list(range(3, 3 + len(HELPERS))) for r in rows)
    assert all(r.source == f"s{r.doc_id % 2}" for r in rows)
