"""Numbers, sums, last values and quantiles by ranges against plain versions, a third of the rows in one group."""

import numpy as np
import pytest
from framequery.operators import ranges
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    made = [(None if k % 17 == 0 else "hot" if k % 3 == 0 else f"g{k % 40}", int(rng.integers(0, 400)), k, None if k % 5 == 0 else float(rng.integers(-50, 50)), int(rng.integers(0, 9))) for k in range(3000)]
    return made, spark.createDataFrame(made, "g string, t long, id long, x double, n long").repartition(5)


def grouped(made):
    out = {}
    for r in sorted(made, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_numbers_sums_and_last_values(rows):
    made, df = rows
    order = [F.col("t"), F.col("id")]
    number = {r.id: r.out for r in ranges.numbered(df, ["g"], order, "out").collect()}
    total = {r.id: r.out for r in ranges.running_sum(df, ["g"], order, "n", "out").collect()}
    last = {r.id: r.out for r in ranges.last_value(df, ["g"], order, "x", "out").collect()}
    for own in grouped(made).values():
        n, seen = 0, None
        for k, r in enumerate(own):
            seen = r[3] if r[3] is not None else seen
            assert (number[r[2]], total[r[2]], last[r[2]]) == (k, n, seen)
            n += r[4]
    everywhere = {r.id: r.out for r in ranges.numbered(df, [], order, "out").collect()}
    assert [everywhere[r[2]] for r in sorted(made, key=lambda r: (r[1], r[2]))] == list(range(3000))


@pytest.mark.parametrize("cells", [2, 1024])
def test_quantiles(rows, spark, monkeypatch, cells):
    monkeypatch.setattr(ranges, "CELLS", cells)
    made, df = rows
    shares = [0.0, 0.02, 0.5, 0.98, 1.0]
    got = {(r.g, r.share): r.value for r in ranges.quantiles(df, "g", "x", shares).collect()}
    for g, own in grouped(made).items():
        x = [r[3] for r in own if r[3] is not None]
        for s in shares if x else ():
            assert got.pop((g, s)) == pytest.approx(np.quantile(x, s), abs=1e-9)
    assert not got
    wide = spark.createDataFrame([("a", v) for v in (-1.7e308, 1.7e308, 0.0, float("nan"))] + [("b", None)], "g string, x double")
    assert {(r.g, r.share): r.value for r in ranges.quantiles(wide, "g", "x", [0.5, 1.0]).collect()} == {("a", 0.5): 0.0, ("a", 1.0): 1.7e308}


def test_empty(spark):
    none = spark.createDataFrame([], "g string, t long, x double")
    assert ranges.numbered(none, ["g"], [F.col("t")], "n").count() == 0
    assert ranges.running_sum(none, ["g"], [F.col("t")], "x", "n").count() == 0
    assert ranges.last_value(none, ["g"], [F.col("t")], "x", "n").count() == 0
    assert ranges.quantiles(none, "g", "x", [0.5]).count() == 0
