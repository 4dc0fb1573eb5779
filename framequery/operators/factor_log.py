"""Factor graphs as logs: edges added, aged, retired, evicted and renumbered, replayed graph by graph into versions.

Events of a graph rest on one another, so a walk takes them in order, holding the graph's
edges; graphs are spread over the cluster. The walk tells only what changed, each edge with a number
of its own, and the edges at any event are the last versions up to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTIVE, INACTIVE, USED, GONE = "active", "inactive", "used", "gone"
SCHEMA = "graph long, seq long, edge long, i long, j long, age long, state string"
#: Keyframes before the first of an update whose retired edges still take part in it.
REACH = 3


class Graph:
    """The edges of one graph, by number: [i, j, age]; each step returns the versions it makes."""

    def __init__(self, most: int) -> None:
        self.most, self.next = most, 0
        self.active: dict[int, list[int]] = {}
        self.inactive: dict[int, list[int]] = {}

    def add(self, pairs: list[tuple[int, int]]) -> Iterator[tuple]:
        """Edges that are neither active nor retired, once each; the oldest make room, the earlier added of equal age first."""
        known = {(e[0], e[1]) for own in (self.active, self.inactive) for e in own.values()}
        new = [p for p in dict.fromkeys(pairs) if p not in known]
        over = len(self.active) + len(new) - self.most
        if new and self.most > 0 and over > 0:
            yield from self._retire(sorted(self.active, key=lambda n: (-self.active[n][2], n))[:over])
        for i, j in new:
            self.active[self.next] = [i, j, 0]
            yield self.next, i, j, 0, ACTIVE
            self.next += 1

    def _retire(self, numbers: list[int]) -> Iterator[tuple]:
        for n in numbers:
            self.inactive[n] = self.active.pop(n)
            yield n, *self.inactive[n], INACTIVE

    def age(self) -> Iterator[tuple]:
        for e in self.active.values():
            e[2] += 1
        return iter(())

    def retire(self, older: int) -> Iterator[tuple]:
        """Edges older than a number of updates become inactive and keep what they know."""
        yield from self._retire([n for n, e in self.active.items() if e[2] > older])

    def drop(self, keyframe: int) -> Iterator[tuple]:
        """A keyframe goes with its edges; later ones move up by one."""
        for own, state in ((self.active, ACTIVE), (self.inactive, INACTIVE)):
            for n in [n for n, e in own.items() if keyframe in e[:2]]:
                yield n, *own.pop(n), GONE
            for n, e in own.items():
                if max(e[:2]) > keyframe:
                    e[0], e[1] = (v - (v > keyframe) for v in e[:2])
                    yield n, *e, state

    def use(self, first: int) -> Iterator[tuple]:
        """Retired edges near the window that begins at ``first``, which an update takes along; their state stays."""
        for n, e in self.inactive.items():
            if min(e[:2]) >= first - REACH:
                yield n, *e, USED

    def step(self, op: str, pairs: list[tuple[int, int]], n: int) -> Iterator[tuple]:
        return {"add": lambda: self.add(pairs), "age": self.age, "retire": lambda: self.retire(n), "drop": lambda: self.drop(n), "use": lambda: self.use(n)}[op]()


def replay(events: DataFrame, most: int = 0) -> DataFrame:
    """(graph, seq, edge, i, j, age, state): the versions that each event of (graph, seq, op, pairs, n) makes.

    op is add (``pairs``, an array of structs i, j), age, retire (older than ``n`` updates),
    drop (keyframe ``n``) or use (from keyframe ``n`` on). Of a graph's active edges there are at
    most ``most``, 0 for no bound, unless one batch alone has more. Events of one graph go by seq; other ops and null
    graphs are left out. A duplicate inside a batch is added once and eviction takes the oldest edges.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, graph = None, Graph(most)
        for b in batches:
            found = []
            for k, seq, op, pairs, n in b.itertuples(index=False):
                if k != key:
                    key, graph = k, Graph(most)
                pairs = [(int(p["i"]), int(p["j"])) for p in pairs] if pairs is not None else []
                found += [(k, seq, *v) for v in graph.step(op, pairs, 0 if pd.isna(n) else int(n))]
            yield pd.DataFrame(found, columns=["graph", "seq", "edge", "i", "j", "age", "state"])

    known = events.where(F.col("graph").isNotNull() & F.col("op").isin("add", "age", "retire", "drop", "use")).select("graph", "seq", "op", "pairs", "n")
    return known.repartition("graph").sortWithinPartitions("graph", "seq").mapInPandas(walk, SCHEMA)


def edges_at(versions: DataFrame, seq: int | None = None) -> DataFrame:
    """(graph, edge, i, j, state) of the edges after event ``seq`` of every graph, or after all events."""
    upto = versions.where(F.col("state") != USED)
    upto = upto if seq is None else upto.where(F.col("seq") <= seq)
    # within an event an edge changes at most twice, last of all to gone
    order = F.struct("seq", (F.col("state") == GONE).alias("gone"))
    last = upto.groupBy("graph", "edge").agg(F.max_by(F.struct("i", "j", "state"), order).alias("v"))
    return last.select("graph", "edge", "v.i", "v.j", "v.state").where(F.col("state") != GONE)
