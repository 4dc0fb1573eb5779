"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Document rates r are those of least relative entropy to one copy each, under one token
constraint a source, sum(size * r) = target, and a ceiling of ``MOST`` copies. The convex
dual has one multiplier a source and r = min(MOST, exp(multiplier * size / scale)). Rates
depend on source and size alone, so the distributed Newton iterations run on the counts of
(source, size), and rounding runs on them too: in order of size, each size gets the copies
by which the rounded running total of rates rises, so that a source's tokens miss their
target by about one document. Which documents of a size get the odd copies is set by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, salted_rank, salts_for, shielded, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
_EXACT = "decimal(38,9)"


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size), one a source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes; a target above MOST times its source's size stops there and the excess is
    shared by weight among the rest. With sources ordered by size for weight, those that
    stop come first, so running sums find them. These windows hold one row a source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    cap = MOST * F.col("source_size")
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", cap.cast("double"))
        .withColumn("total", share * F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("full_below", F.coalesce(F.sum("cap").over(filling), F.lit(0.0)))
        .withColumn("weight_below", F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    )
    stops = F.col("weight") * (F.col("total") - F.col("full_below")) >= F.col("cap") * (F.col("weights") - F.col("weight_below"))
    rows = rows.withColumn("stops", stops)
    full = F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), F.col("cap")).otherwise(F.try_divide((F.col("total") - full) * F.col("weight"), free))
    return rows.select("source", "source_size", target.alias("target"))


def _rate() -> Column:
    return F.when(F.col("multiplier").isNull(), F.lit(float(MOST))).otherwise(F.least(F.lit(float(MOST)), F.exp(F.col("multiplier") * F.col("size") / F.col("scale"))))


def balance(counts: DataFrame, goals: DataFrame, tolerance: float = 1e-7, most_rounds: int = 60) -> DataFrame:
    """(source, multiplier, scale): the dual's solution for each source.

    ``counts`` has (source, size, n), ``goals`` (source, source_size, target). A round is one
    join and one grouped sum over ``counts``. It starts from the multiplier that would do if all
    documents had the scale's size; Newton steps that leave the bracket kept so far
    become bisections. Sums are of decimals, so that reruns agree to the last digit. A null
    multiplier stands for infinity: the source's target is its ceiling, or it has no words.
    """
    scale = (F.sum((F.col("n") * F.col("size") * F.col("size")).cast("double").cast(_EXACT)) / F.nullif(F.sum((F.col("n") * F.col("size")).cast(_EXACT)), F.lit(0).cast(_EXACT))).cast("double")
    least = F.min(F.when(F.col("size") > 0, F.col("size")))
    shapes = counts.groupBy(F.col("source").alias("s")).agg(scale.alias("scale"), least.alias("least"))
    state = goals.join(shapes, goals["source"].eqNullSafe(shapes["s"]))
    ends = (F.col("source_size") == 0) | (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12))
    hi = F.log(F.lit(float(MOST))) * F.col("scale") / F.col("least")
    # exp() of the lower end is so small that even a source of 1e18 words would be taken less than once
    state = materialize(state.select("source", "target", "scale", F.when(~ends, F.log(F.try_divide("target", "source_size"))).alias("multiplier"), (F.lit(-64.0) * F.col("scale") / F.col("least")).alias("lo"), hi.alias("hi"), ends.alias("done")), "dual")
    for _ in range(most_rounds):
        if state.where(~F.col("done")).isEmpty():
            break
        live = state.where(~F.col("done")).select(F.col("source").alias("s"), "multiplier", "scale")
        tilted = counts.join(live, counts["source"].eqNullSafe(live["s"]))
        taken = F.col("n") * F.col("size") * _rate()
        slope = F.when(_rate() < MOST, taken * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = tilted.groupBy("s").agg(F.sum(taken.cast(_EXACT)).cast("double").alias("g"), F.sum(slope.cast(_EXACT)).cast("double").alias("h"))
        s = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left")
        miss = F.col("g") - F.col("target")
        lo = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(miss >= 0, F.col("multiplier")).otherwise(F.col("hi"))
        s = s.withColumn("miss", miss).withColumn("lo2", lo).withColumn("hi2", hi)
        step = F.col("multiplier") - F.col("miss") / F.when(F.col("h") > 0, F.col("h"))
        step = F.when((step > F.col("lo2")) & (step < F.col("hi2")), step).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        near = F.abs("miss") <= tolerance * F.col("target")
        done = F.col("done") | near
        state = materialize(
            s.select("source", "target", "scale", F.when(done, F.col("multiplier")).otherwise(step).alias("multiplier"), F.when(done, F.col("lo")).otherwise(F.col("lo2")).alias("lo"), F.when(done, F.col("hi")).otherwise(F.col("hi2")).alias("hi"), done.alias("done")),
            "dual",
        )
    else:
        if not state.where(~F.col("done")).isEmpty():
            raise RuntimeError(f"the dual of a source isn't solved to {tolerance} after {most_rounds} rounds")
    return state.select("source", "multiplier", "scale")


def _plan(sized: DataFrame, share: float, weights: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """((source, size, each, odd), (source, source_size, target)): copies of each document of a size, and how many get one more."""
    counts = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    goals = materialize(targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), share, weights), "goals")
    dual = balance(counts, goals).withColumnRenamed("source", "s")
    running = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    rated = counts.join(dual, counts["source"].eqNullSafe(dual["s"])).withColumn("total", F.sum((F.col("n") * _rate()).cast(_EXACT)).over(running))
    upto = F.floor(F.col("total") + F.lit(0.5))
    before = F.lag(upto, 1, 0).over(Window.partitionBy("source").orderBy("size"))
    copies = rated.select("source", "size", "n", (upto - before).cast("long").alias("copies"))
    odd = F.pmod(F.col("copies"), F.col("n"))
    return copies.select("source", "size", ((F.col("copies") - odd) / F.col("n")).cast("long").alias("each"), odd.alias("odd")), goals


def _with_copies(sized: DataFrame, id_col: str, share: float, weights: tuple[int, ...]) -> DataFrame:
    """Add __mix_source_size, __mix_target and __mix_copies to rows with __mix_source and __mix_size."""
    small = materialize(sized.select(id_col, "__mix_source", "__mix_size"), "sizes")
    plan, goals = _plan(small.withColumnsRenamed({"__mix_source": "source", "__mix_size": "size"}).select("source", "size"), share, weights)
    order = [F.xxhash64(F.col(id_col), F.lit(7)), F.col(id_col)]
    ranked = salted_rank(sized, ["__mix_source", "__mix_size"], order, [id_col], "__mix_rank", salts_for(small.count()), small)
    goals = goals.select(F.col("source").alias("__g_source"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"))
    plan = plan.withColumnsRenamed({"source": "__p_source", "size": "__p_size", "each": "__p_each", "odd": "__p_odd"})
    plan = plan.join(goals, F.col("__p_source").eqNullSafe(F.col("__g_source")))
    rows = ranked.join(plan, F.col("__mix_source").eqNullSafe(F.col("__p_source")) & (F.col("__mix_size") == F.col("__p_size")))
    copies = F.col("__p_each") + F.when(F.col("__mix_rank") < F.col("__p_odd"), 1).otherwise(0)
    return rows.withColumn("__mix_copies", copies).select(*sized.columns, "__mix_source_size", "__mix_target", "__mix_copies")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of ``docs``.

    size counts the words of the text, 0 for null; a null source is a source of its own, the
    last. A document is taken 0 to MOST times and taken counts all its words then; one
    without words adds none. Repeated rows are documents of their own. An empty table gives
    no rows. Texts are read once, for their sizes; other columns aren't read.
    """
    sized = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("__mix_source"), word_count(F.col(text_col)).alias("__mix_size")), "mix")
    rows = _with_copies(sized, "doc_id", share, weights)
    return rows.select(
        "doc_id", F.col("__mix_source").alias("source"), F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"), F.col("__mix_copies").alias("copies"), (F.col("__mix_copies") * F.col("__mix_size")).alias("taken")
    )


@shielded
def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as mixture() takes it, all columns as they were."""
    sized = docs.withColumn("__mix_source", F.col(source_col).cast("string")).withColumn("__mix_size", word_count(F.col(text_col)))
    rows = _with_copies(sized, id_col, share, weights).where("__mix_copies > 0")
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies"))).alias("__mix_copy")).select(*docs.columns)
