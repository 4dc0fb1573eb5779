"""Sparse symmetric block systems solved by nested block elimination, many graphs at a time.

Variables of one graph are numbered; blocks of 64 neighbours by number are a segment. Of two
coupled variables in different segments the lower one waits, and so do the shared ones, whose
numbers are negative; all others are eliminated, each segment in a task of its own, which
leaves a smaller system among those that wait. Segments eight times as wide follow, until
what is left of a graph fits one task. Solutions run back the same way. Unlike iteration the
result is exact; a task holds a segment and what it is coupled to, never a graph.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written

DIM = 6
ENTRIES = [(p, q) for p in range(DIM) for q in range(DIM)]
H = [f"h{p}{q}" for p, q in ENTRIES]
G = [f"g{n}" for n in range(DIM)]
X = [f"x{n}" for n in range(DIM)]
#: Variables of a graph solved in one task, log2 of a segment's numbers, of their growth, and the most that a segment may hold.
TOGETHER, SEGMENT, WIDER, MOST = 192, 6, 3, 2048
_BLOCK, _SIDE, _FACTOR = 0, 1, 2
_OUT = "graph long, seg long, kind int, p long, q long, " + ", ".join(f"{c} double" for c in H) + ", inner array<long>, border array<long>, u binary, v binary"


def _eliminated(rows: pd.DataFrame) -> pd.DataFrame:
    """A segment's updates of what waits, and the factor that gives its variables once those are known."""
    inner = sorted(set(rows["p"][rows["p_inner"]]) | set(rows["q"][rows["q_inner"]]))
    border = sorted((set(rows["p"]) | set(rows["q"])) - set(inner))
    if len(inner) > MOST:
        raise ValueError(f"{len(inner)} variables of one segment are coupled to others further off; the most is {MOST}")
    at = {v: k for k, v in enumerate(inner + border)}
    n, m = len(inner), len(at)
    a, b = np.zeros((m, DIM, m, DIM)), np.zeros((m, DIM))
    for kind, p, q, h in zip(rows["kind"], rows["p"].map(at), rows["q"].map(at), rows[H].to_numpy().reshape(-1, DIM, DIM), strict=True):
        if kind == _SIDE:
            b[p] += h[0]
        else:
            a[p, :, q, :] += h
            if p != q:
                a[q, :, p, :] += h.T
    a, b = a.reshape(m * DIM, -1), b.ravel()
    k = n * DIM
    solved = np.linalg.solve(a[:k, :k], np.column_stack([a[:k, k:], b[:k]]))
    v, u = -solved[:, :-1], solved[:, -1]
    less, side = (a[:k, k:].T @ v).reshape(m - n, DIM, m - n, DIM), (-a[:k, k:].T @ u).reshape(-1, DIM)
    pairs = [(p, q) for p in range(m - n) for q in range(p, m - n)]
    out = [(_BLOCK, border[p], border[q], less[p, :, q, :].ravel()) for p, q in pairs]
    out += [(_SIDE, p, p, np.append(s, np.zeros(DIM * DIM - DIM))) for p, s in zip(border, side, strict=True)]
    out.append((_FACTOR, 0, 0, np.zeros(DIM * DIM)))
    done = pd.DataFrame(np.array([x[3] for x in out]), columns=H)
    done.insert(0, "graph", rows["graph"].iloc[0])
    done.insert(1, "seg", rows["seg"].iloc[0])
    for k, (c, own) in enumerate(zip(("kind", "p", "q"), zip(*(x[:3] for x in out), strict=True), strict=True)):
        done.insert(2 + k, c, own)
    last = len(out) - 1
    for c, value in {"inner": inner, "border": border, "u": u.tobytes(), "v": v.tobytes()}.items():
        done[c] = pd.Series([None] * last + [value], dtype=object)
    return done


def _summed(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def _level(blocks: DataFrame, sides: DataFrame, shift: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, sides, factors): the system of those that wait, and how the others follow from them."""
    sizes = sides.groupBy("graph").agg((F.count(F.lit(1)) <= TOGETHER).alias("small"))
    seg = lambda v: F.when(F.col("small"), F.lit(0).cast("long")).when(F.col(v) >= 0, F.shiftright(v, shift))
    named = blocks.join(sizes, "graph").withColumns({"p_seg": seg("p"), "q_seg": seg("q")})
    # numbers ascend with segments, so the lower of two is p
    waits = named.where(F.col("p_seg") != F.col("q_seg")).select("graph", "p").distinct()
    states = sides.select("graph", "p").join(sizes, "graph").join(waits.withColumn("waits", F.lit(True)), ["graph", "p"], "left")
    states = states.select("graph", "p", seg("p").alias("seg"), (F.col("waits").isNull() & seg("p").isNotNull()).alias("inner"))
    states = written(states, "states")
    of = lambda v: states.select("graph", F.col("p").alias(v), F.col("seg").alias(f"{v}_seg"), F.col("inner").alias(f"{v}_inner"))
    placed = blocks.join(of("p"), ["graph", "p"]).join(of("q"), ["graph", "q"])
    owner = F.when(F.col("p_inner"), F.col("p_seg")).when(F.col("q_inner"), F.col("q_seg"))
    wide = sides.join(of("p"), ["graph", "p"])
    padded = [F.col(G[n]).alias(H[n]) if n < DIM else F.lit(0.0).alias(H[n]) for n in range(len(H))]
    own = placed.select("graph", owner.alias("seg"), F.lit(_BLOCK).alias("kind"), "p", "q", "p_inner", "q_inner", *H)
    own_sides = wide.select("graph", F.when(F.col("p_inner"), F.col("p_seg")).alias("seg"), F.lit(_SIDE).alias("kind"), "p", F.col("p").alias("q"), "p_inner", F.col("p_inner").alias("q_inner"), *padded)
    tasks = own.unionByName(own_sides).where(F.col("seg").isNotNull())
    made = written(tasks.groupBy("graph", "seg").applyInPandas(_eliminated, _OUT), "eliminated")
    kept = placed.where(~F.col("p_inner") & ~F.col("q_inner")).select("graph", "p", "q", *H)
    left = _summed(kept.unionByName(made.where(F.col("kind") == _BLOCK).select("graph", "p", "q", *H)), ["graph", "p", "q"], H)
    turned = made.where(F.col("kind") == _SIDE).select("graph", "p", *[F.col(H[n]).alias(G[n]) for n in range(DIM)])
    left_sides = _summed(wide.where(~F.col("p_inner")).select("graph", "p", *G).unionByName(turned), ["graph", "p"], G)
    return written(left, "blocks"), written(left_sides, "sides"), made.where(F.col("kind") == _FACTOR).select("graph", "seg", "inner", "border", "u", "v")


def _known(factors: DataFrame, x: DataFrame) -> DataFrame:
    """(graph, p, x0..): a level's variables from those that waited."""
    wanted = factors.select("graph", "seg", F.posexplode("border").alias("n", "p")).join(x, ["graph", "p"])
    met = wanted.groupBy("graph", "seg").agg(F.sort_array(F.collect_list(F.struct("n", F.array(*X).alias("x")))).alias("met"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for graph, inner, border, u, v, met in zip(b["graph"], b["inner"], b["border"], b["u"], b["v"], b["met"], strict=True):
                at = np.frombuffer(u)
                if len(border):
                    at = at + np.frombuffer(v).reshape(len(at), -1) @ np.concatenate([np.asarray(w["x"], float) for w in met])
                yield pd.DataFrame(at.reshape(-1, DIM), columns=X).assign(graph=graph, p=np.asarray(inner))[["graph", "p", *X]]

    joined = factors.join(met, ["graph", "seg"], "left").select("graph", "inner", "border", "u", "v", "met")
    return joined.mapInPandas(run, "graph long, p long, " + ", ".join(f"{c} double" for c in X))


def solve(blocks: DataFrame, sides: DataFrame) -> DataFrame:
    """(graph, p, x0..x5): the solution of each graph's system.

    ``blocks`` has (graph, p, q, h00..h55) for p <= q, each pair once, and ``sides`` (graph, p,
    g0..g5) for every variable; the matrix must be positive definite. Blocks of variables
    without a side are left out. No rows give no rows.
    """
    blocks, sides = written(blocks.select("graph", "p", "q", *H), "blocks"), written(sides.select("graph", "p", *G), "sides")
    shift, levels, schema = SEGMENT, [], sides.sparkSession.createDataFrame([], "graph long, p long, " + ", ".join(f"{c} double" for c in X))
    while not sides.isEmpty():
        blocks, sides, factors = _level(blocks, sides, shift)
        levels.append(factors)
        shift += WIDER
    found = [schema]
    for factors in reversed(levels):
        found.append(written(_known(factors, reduce(DataFrame.unionByName, found)), "known"))
    return reduce(DataFrame.unionByName, found)
