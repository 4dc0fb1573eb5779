"""Streaming twins with state and timers equal the batch operators, whatever the triggers and across a restart."""

import datetime as dt
import random

import pytest
from framequery.operators import sequences
from framequery.streaming import stateful
from pyspark.sql import functions as F

SCHEMA = "stream long, frame long, value double, ts timestamp"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Frames of four streams shuffled over six files, the last of which also ends them by a much later row."""
    rnd = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(s, k, rnd.uniform(0, 10), start + dt.timedelta(minutes=k)) for s, n in enumerate((40, 1, 5, 23)) for k in range(n)]
    mixed = rows[:]
    rnd.shuffle(mixed)
    folder = tmp_path_factory.mktemp("frames")
    parts = [mixed[k::6] for k in range(6)]
    parts.append([(99, 0, 0.0, start + dt.timedelta(days=90))])
    return rows, parts, folder


def put(spark, folder, part, n):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(folder / f"{n:02d}"))


def run(spark, df_of, folder, out, check):
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    q = df_of(source).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(check)).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


@pytest.mark.parametrize("kind", ["keyframes", "windows"])
def test_twins(spark, made, tmp_path, kind):
    rows, parts, _ = made
    folder = tmp_path / "in"
    if kind == "keyframes":
        twin = lambda s: stateful.keyframes(s, 3.0, warm=4, late="2 days")
    else:
        twin = lambda s: stateful.blended_windows(s, 8, 3, late="2 days")
    for n, part in enumerate(parts[:3]):
        put(spark, folder, part, n)
    run(spark, twin, folder, tmp_path / "out", tmp_path / "check")
    for n, part in enumerate(parts[3:]):
        put(spark, folder, part, n + 3)
    run(spark, twin, folder, tmp_path / "out", tmp_path / "check")  # from the checkpoint
    found = spark.read.parquet(str(tmp_path / "out")).where("stream < 99").collect()
    batch = spark.createDataFrame(rows, SCHEMA)
    if kind == "keyframes":
        want = {tuple(r) for r in sequences.select_keyframes(batch, "stream", "frame", "value", 3.0).collect()}
        assert sorted(map(tuple, found)) == sorted(want)
        assert {(s, n - 1) for s, n in enumerate((40, 1, 5, 23))} <= want
        return
    held = batch.withColumn("w", F.explode(sequences.window_of(F.col("frame"), 8, 3)))
    means = held.groupBy("stream", "w").agg(F.avg("value").alias("mean"))
    want = sequences.blended(held.join(means, ["stream", "w"]), "stream", "frame", "w", F.col("value") - F.col("mean"), 8, 3, "out").collect()
    got = {(r.stream, r.frame): r.value for r in found}
    assert len(got) == len(found) == len(want)
    assert all(abs(got[r.stream, r.frame] - r.out) < 1e-9 for r in want)
