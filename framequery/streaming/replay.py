"""Streaming twins: daily totals and keyframe choice over a table replayed file by file."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def source(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The Parquet files of a folder as a stream, a file a trigger at most."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def daily_totals(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Count and total of each stream and day; a day is final ``late`` after its end."""
    w = events.withWatermark("ts", late).groupBy(F.col("user_id").alias("stream_id"), F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select("stream_id", F.col("window.start").alias("day"), "n", "total")


def keyframes(events: DataFrame, threshold: float) -> DataFrame:
    """Frames that differ by more than ``threshold`` from the last one taken of their stream, as they come.

    State holds one number a stream. Frames of one trigger are put in order of (ts, event_id);
    a stream's triggers must come in order.
    """

    def walk(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        reference = state.get[0] if state.exists else None
        found = []
        for event_id, x in zip(rows["event_id"].tolist(), rows["value"].tolist(), strict=True):
            if reference is None or abs(x - reference) > threshold:
                reference = x
                found.append((key[0], event_id))
        state.update((reference,))
        yield pd.DataFrame(found, columns=["stream_id", "event_id"])

    return events.groupBy("user_id").applyInPandasWithState(walk, "stream_id long, event_id long", "reference double", "append", GroupStateTimeout.NoTimeout)
