"""Best-fit packing of token sequences through the configuration linear program.

A configuration is a multiset of lengths that fits one sequence. The program covers each
length's count with as few configurations as possible. It is solved over the histogram of
lengths, at most ``CAPACITY`` numbers whatever the corpus, by multiplicative weights: each
round prices lengths by how far they lag and a knapsack recurrence finds the configuration
worth most. The fractional solution is rounded down, what it leaves is solved again and rounded
by greatest remainder, and the last remains are filled greedily, longest first, each time with the
lengths that close the gap best. The plan is then dealt to the pieces by rank within length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, salted_rank, salts_for
from .tokens import encoded

CAPACITY = 2048
END_ID = 0
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and an end id, cut at ``capacity`` if longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, ids, ends in encoded(tokenizer_path, b.column(1)):
                full, bounds = np.insert(ids, ends, end_id), np.append(0, ends + np.arange(1, hi - lo + 1))
                n = np.diff(bounds)
                parts = -(-n // capacity)
                row = np.repeat(np.arange(hi - lo), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                raw, first = memoryview(full.astype("<u4", copy=False)).cast("B"), bounds[row] + start
                crc = [zlib.crc32(raw[4 * s : 4 * (s + k)]) for s, k in zip(first.tolist(), length.tolist(), strict=True)]
                columns = [b.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, _PIECE)


def best_configuration(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Counts of each length in the configuration of greatest value, by the unbounded knapsack recurrence."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    until = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        with_one = best[room - lengths[: until[room]]] + values[: until[room]]
        k = int(with_one.argmax())
        if with_one[k] > best[room - 1]:
            best[room], last[room] = with_one[k], k
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if last[room] < 0 or best[room] == best[room - 1]:
            room -= 1
            continue
        counts[last[room]] += 1
        room -= int(lengths[last[room]])
    return counts, float(best[capacity])


def priced_configuration(lengths: np.ndarray, values: np.ndarray, stock: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of the configuration of greatest value that uses no length beyond its stock, by the bounded knapsack recurrence.

    A length enters as lots of 1, 2, 4, ... copies; a lot is one pass over all rooms at once.
    """
    best, lots = np.zeros(capacity + 1), []
    for k, (size, value) in enumerate(zip(lengths.tolist(), values.tolist(), strict=True)):
        allowed, lot = min(int(stock[k]), capacity // size), 1
        while allowed > 0:
            n = min(lot, allowed)
            with_lot = best[: capacity + 1 - n * size] + n * value
            better = with_lot > best[n * size :]
            np.maximum(best[n * size :], with_lot, out=best[n * size :])
            lots.append((k, n, better))
            allowed, lot = allowed - n, 2 * lot
    counts, room = np.zeros(len(lengths), np.int64), capacity
    for k, n, better in reversed(lots):
        at = room - n * int(lengths[k])
        if at >= 0 and better[at]:
            counts[k] += n
            room = at
    return counts


def multiplicative_weights(lengths: np.ndarray, demand: np.ndarray, capacity: int, priced: int = 96, share: float = 0.5, rate: float = 1.0) -> tuple[dict[bytes, float], float]:
    """A fractional solution that covers no length beyond its demand, and a lower bound on sequences.

    A token of a length weighs exp(-rate * share covered), per token so that a configuration
    that wastes room is worth less. Each round prices ``priced`` lengths that are still in
    demand, half of them the heaviest (of equal weight, the longest) and half spread over all,
    and takes as much of the best configuration as covers ``share`` of the demand of any
    length in it, or all that is left of it. Rounds end when nothing is in demand, after a few
    for each length.
    Any weights, divided by the value of their best configuration of all lengths, are a
    feasible dual, which gives the bound; it is evaluated at the start and the end.
    """
    covered = np.zeros(len(lengths))
    taken: dict[bytes, float] = {}

    def dual() -> float:
        price = lengths * np.exp(-rate * covered / demand)
        return float((demand * price).sum() / best_configuration(lengths, price, capacity)[1])

    bound = dual()
    for k in range(4 * len(lengths)):
        left = demand - covered
        wanted = np.flatnonzero(left > 1e-9 * demand)
        if not len(wanted):
            break
        heaviest = wanted[np.lexsort((-wanted, covered[wanted] / demand[wanted]))[: priced // 2]]
        spread = wanted[(np.arange(priced // 2) * len(wanted) // (priced // 2) + 7 * k) % len(wanted)]
        some = np.unique(np.append(heaviest, spread))[::-1]
        price = lengths[some] * np.exp(-rate * covered[some] / demand[some])
        counts = np.zeros(len(lengths), np.int64)
        counts[some] = priced_configuration(lengths[some], price, np.ceil(left[some]), capacity)
        held = counts > 0
        step = float((np.minimum(np.maximum(share * demand[held], 1e-6), left[held]) / counts[held]).min())
        taken[counts.tobytes()] = taken.get(counts.tobytes(), 0.0) + step
        covered[held] += counts[held] * step
    return taken, max(bound, dual())


def _fill(lengths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """One configuration from what is left: the longest, then what fills the rest best.

    The longest comes first; a bounded subset-sum over the other lengths then finds the
    fullest filling, preferring long lengths.
    """
    counts = np.zeros(len(lengths), np.int64)
    top = int(np.flatnonzero(left)[-1])
    counts[top] = 1
    room = capacity - int(lengths[top])
    stock = left - counts
    # reach[r]: the length last added to sum to r, longest lengths tried first
    reach = np.full(room + 1, -1)
    reach[0] = len(lengths)
    for k in np.flatnonzero(stock)[::-1]:
        size = int(lengths[k])
        if size > room or reach[room] >= 0:
            continue
        have = reach >= 0
        for _ in range(min(int(stock[k]), room // size)):
            moved = np.zeros(room + 1, bool)
            moved[size:] = have[:-size]
            fresh = moved & (reach < 0)
            if not fresh.any():
                break
            reach[fresh] = k
            have = fresh
    r = int(np.flatnonzero(reach >= 0)[-1])
    while r:
        counts[reach[r]] += 1
        r -= int(lengths[reach[r]])
    return counts


def counting_bound(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by counting lengths that can't share.

    For a cut a of at most half the capacity: lengths over half need a sequence each, and of
    those only ones of at most capacity - a leave room for lengths from a up to a half.
    """
    rows = [0, *lengths[2 * lengths <= capacity].tolist()]
    count, total = np.append(0, np.cumsum(demand)), np.append(0, np.cumsum(demand * lengths))
    upto = lambda n: int(np.searchsorted(lengths, n, side="right"))
    half, best = upto(capacity / 2), 0
    for a in rows:
        large, small = upto(capacity - a), int(np.searchsorted(lengths, a, side="left"))
        roomy = max(half, large)
        room = (count[roomy] - count[half]) * capacity - (total[roomy] - total[half])
        more = -(-(total[half] - total[small] - room) // capacity)
        best = max(best, int(count[-1] - count[half] + max(0, more)))
    return best


def _rounded(fractions: dict[bytes, float], left: np.ndarray, last: bool) -> list[tuple[np.ndarray, int]]:
    """Whole copies of a fractional solution's configurations, as far as the stock goes.

    All are rounded down; the last time, those of greatest remainder are then rounded up
    until there are as many copies as the solution's total, so that a small histogram's
    fractions below one count too.
    """
    stock, taken = left.copy(), []
    order = sorted(fractions.items(), key=lambda f: (-(f[1] % 1.0), f[0]))
    more = int(sum(fractions.values())) - sum(int(x) for x in fractions.values()) if last else 0
    for up in (False, True):
        for raw, x in order:
            counts = np.frombuffer(raw, np.int64)
            held = counts > 0
            wish = min(1, more) if up else int(x)
            copies = min(wish, int((stock[held] // counts[held]).min()))
            if copies > 0:
                taken.append((counts, copies))
                stock -= copies * counts
                more -= copies * up
    return taken


@dataclass
class Plan:
    """Configurations with whole numbers of copies that use up the histogram, and a lower bound."""

    lengths: np.ndarray
    configurations: list[tuple[np.ndarray, int]]
    bound: int
    #: Sequences that the program gave; the rest were filled greedily.
    programmed: int = 0

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.configurations)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, solves: int = 2) -> Plan:
    """Pack a histogram {length: count}; the bound is the best of the program's dual, of total length and of counting.

    Of each solution the configurations that leave at most a 512th of a sequence empty are rounded.
    """
    lengths = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[int(n)] for n in lengths], np.int64)
    found: list[tuple[np.ndarray, int]] = []
    bound = 0
    if not len(lengths):
        return Plan(lengths, found, bound)
    bound = max(-int(-(left * lengths).sum() // capacity), counting_bound(lengths, left, capacity))
    for k in range(solves):
        some = left > 0
        if not some.any():
            break
        fractions, low = multiplicative_weights(lengths[some], left[some].astype(float), capacity)
        bound = max(bound, int(np.ceil(low - 1e-6))) if k == 0 else bound
        # the last rounds' configurations waste room for want of short lengths; what they hold is left to the next step
        full = {c: x for c, x in fractions.items() if capacity - int((np.frombuffer(c, np.int64) * lengths[some]).sum()) <= capacity // 512}
        for counts, copies in _rounded(full, left[some], last=k + 1 == solves):
            whole = np.zeros(len(lengths), np.int64)
            whole[some] = counts
            found.append((whole, copies))
            left = left - copies * whole
    programmed = sum(n for _, n in found)
    while left.any():
        counts = _fill(lengths, left, capacity)
        copies = int((left[counts > 0] // counts[counts > 0]).min())
        found.append((counts, copies))
        left = left - copies * counts
    return Plan(lengths, found, bound, programmed)


def slots(p: Plan) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset) of each place that the plan's copies offer."""
    rows, used, sequence = [], np.zeros(len(p.lengths), np.int64), 0
    for counts, copies in p.configurations:
        offset = 0
        for k in np.flatnonzero(counts)[::-1]:
            for _ in range(int(counts[k])):
                rows.append((int(p.lengths[k]), int(used[k]), copies, sequence, offset))
                used[k] += copies
                offset += int(p.lengths[k])
        sequence += copies
    return rows


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    A null or empty text is a lone end id. Rows with a null id and repeated rows are packed
    like any others, each in its own place. An empty table gives no rows; other columns
    aren't read. The driver sees the histogram alone, at most ``capacity`` numbers.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = slots(plan(histogram, capacity))
    schema = "slot_length long, first_rank long, n_ranks long, first_sequence long, offset long"
    table = spark.createDataFrame(places, schema)
    ranked = salted_rank(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], ["doc_id", "piece"], "rank", salts_for(sum(histogram.values())))
    here = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n_ranks"))
    # the plan has at most a few thousand configurations, whatever the corpus; a larger one goes through a shuffle
    table = F.broadcast(table) if len(places) <= 500_000 else table
    sequence = F.col("first_sequence") + F.col("rank") - F.col("first_rank")
    return ranked.join(table, here).select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
