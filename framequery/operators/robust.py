"""Robust estimates by groups with weights that tighten from round to round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written


def annealed_mean(rows: DataFrame, by: str, x: str, threshold: float, mu: float = 1.0, mu_step: float = 3.0, mu_most: float = 1e6, mu_steps: int = 4, inner: int = 2) -> DataFrame:
    """(by, mean, mu, kept): each group's mean under graduated truncated least squares.

    It starts from the plain mean. In each of ``mu_steps`` times ``inner`` rounds values within
    sqrt(mu / (mu + 1)) of the threshold count fully, those beyond sqrt((mu + 1) / mu) of it
    not at all, and between them the less the further; then the group's mu grows. kept is the sum
    of the last weights. A group whose values all count for nothing keeps its mean. Null
    values don't count; a group without others has a null mean, and null groups are left out.
    """
    rows = rows.select(by, F.col(x).cast("double").alias("x")).where(F.col(by).isNotNull())
    state = rows.groupBy(by).agg(F.avg("x").alias("mean")).select(by, "mean", F.lit(float(mu)).alias("mu"), F.lit(0.0).alias("kept"))
    c2 = threshold * threshold
    for n in range(mu_steps * inner):
        r2 = (F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean"))
        between = F.greatest(F.sqrt(c2 * F.col("mu") * (F.col("mu") + 1) / F.greatest(r2, F.lit(1e-12))) - F.col("mu"), F.lit(0.0))
        w = F.when(F.col("mu") >= mu_most, F.when(r2 < c2, 1.0).otherwise(0.0)).when(r2 < F.col("mu") / (F.col("mu") + 1) * c2, 1.0).when(r2 <= (F.col("mu") + 1) / F.col("mu") * c2, between).otherwise(0.0)
        met = rows.join(state.drop("kept"), by).select(by, "mean", "mu", "x", w.alias("w"))
        grown = F.least(F.col("mu") * mu_step, F.lit(mu_most)) if (n + 1) % inner == 0 else F.col("mu")
        sums = met.groupBy(by, "mean", "mu").agg(F.sum(F.col("w") * F.col("x")).alias("s"), F.sum(F.when(F.col("x").isNotNull(), F.col("w")).otherwise(0.0)).alias("kept"))
        state = written(sums.select(by, F.when(F.col("kept") > 0, F.col("s") / F.col("kept")).otherwise(F.col("mean")).alias("mean"), grown.alias("mu"), "kept"), "annealed")
    return state
