"""Quality rules: a decision list learned by sequential covering from labelled statistics.

Each text becomes a few counts. On a bounded sample of labelled rows, rules that reject are
learned one at a time: a conjunction of thresholds grows on two thirds of the rows by
information gain, is pruned on the other third, and what it covers is taken away before
the next. The list comes out as one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded, slices
from pyspark.sql import types as T

SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bang", "n_lines")
WINDOW = 5


def _repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    starts = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words) + 1, np.int64)
    inside[: len(windows)] += starts
    inside[window : window + len(windows)] -= starts
    return int((np.cumsum(inside)[: len(words)] > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts of one text in the order of ``_FIELDS``; all zero for null (one line for an empty one)."""
    if text is None:
        return (0,) * len(_FIELDS)
    raw = text.encode()
    words = raw.split()
    worded = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\v\f\r")),
        sum(map(text.count, SYMBOLS)),
        len(worded) - len(set(worded)),
        _repeated_words(words),
        len(raw) - len(raw.translate(None, _UPPER)),
        text.count("!"),
        text.count("\n") + 1,
    )


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as they are and the counts of each whole text as columns ``__stat_*``."""
    names = [f"__stat_{f}" for f in _FIELDS]
    fields = [*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, at)):
            stats = np.array([text_stats(t) for t in b.column(at).to_pylist()], np.int64).reshape(-1, len(_FIELDS))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(stats[:, i]) for i in range(len(_FIELDS)))], names=[*b.schema.names, *names])

    return docs.mapInArrow(run, T.StructType(fields))


def _stat(name: str) -> Column:
    return F.col(f"__stat_{name}")


def base_failed() -> Column:
    """Too few words, or over a fifth of them in repeated windows."""
    return (_stat("n_words") < 10) | (100 * _stat("n_repeat_words") > 20 * _stat("n_words"))


def features() -> dict[str, Column]:
    """What the rules compare; shares, so that they mean the same for short and long texts."""
    chars, words, lines = (F.greatest(_stat(c), F.lit(1)) for c in ("word_chars", "n_words", "n_lines"))
    return {
        "n_words": _stat("n_words").cast("double"),
        "mean_word": _stat("word_chars") / words,
        "symbol_share": _stat("n_symbols") / chars,
        "dup_line_share": _stat("n_dup_lines") / lines,
        "repeat_share": _stat("n_repeat_words") / words,
        "upper_share": _stat("n_upper") / chars,
        "bang_share": _stat("n_bang") / chars,
        "words_per_line": _stat("n_words") / lines,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        x = of[self.feature]
        return x >= F.lit(self.threshold) if self.at_least else x <= F.lit(self.threshold)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    covered = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        covered &= c.holds(x)
    return covered


def _candidates(x: np.ndarray, n: int) -> np.ndarray:
    """Midpoints between neighbouring values, thinned evenly to ``n``."""
    values = np.unique(x)
    mid = (values[1:] + values[:-1]) / 2
    return mid if len(mid) <= n else mid[np.linspace(0, len(mid) - 1, n).astype(int)]


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int, n_thresholds: int) -> Rule:
    """Add the condition of greatest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < most and inside.any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            v, is_bad = values[inside], bad[inside]
            cuts = _candidates(v, n_thresholds)
            order = np.argsort(v, kind="stable")
            below = np.searchsorted(v[order], cuts, side="right")
            bad_below = np.concatenate([[0], np.cumsum(is_bad[order])])[below]
            for at_least, p, n in ((False, bad_below, below - bad_below), (True, p0 - bad_below, n0 - (below - bad_below))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                if len(g) and g.max() > gain:
                    gain, best = g.max(), Condition(name, at_least, float(cuts[g.argmax()]))
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest leading part of the rule that does best on rows it wasn't grown on."""

    def worth(r: Rule) -> float:
        c = _covers(r, x)
        return (2 * bad[c].sum() - c.sum()) / c.sum() if c.any() else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, precision: float = 0.9, least: int = 5, most_rules: int = 12, most_conditions: int = 4, n_thresholds: int = 256) -> list[Rule]:
    """An ordered list of rejecting rules.

    ``fold`` (0, 1 or 2 a row) sets the rows to grow on (0, 1) and to prune on (2). Learning
    stops at a rule that is right in under ``precision`` of all rows it covers or of the
    pruning rows, or covers fewer than ``least``; no bad rows give no rules.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules and bad[left].any():
        grow, check = left & (fold < 2), left & (fold == 2)
        pick = lambda m: {k: v[m] for k, v in x.items()}
        rule = _prune(_grow(pick(grow), bad[grow], most_conditions, n_thresholds), pick(check), bad[check])
        if not rule:
            break
        covered = _covers(rule, x) & left
        held_out = covered & check
        if covered.sum() < least or bad[covered].mean() < precision or (held_out.any() and bad[held_out].mean() < precision):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = 20_000) -> list[Rule]:
    """Learn from the documents of at most ``max_labelled`` labelled ids, those of least hash, that pass the base rules.

    A label with a null id or quality is ignored; an id labelled twice counts as its lower
    quality, and of rows that share a labelled id one is learned from, so that the sample is
    bounded. Without usable labels there are no rules. The bounded id list is broadcast.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("__label_id")).agg(F.min("quality").alias("__quality"))
    chosen = known.orderBy(F.xxhash64("__label_id"), "__label_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    rows = with_stats(texts.join(F.broadcast(chosen), F.col("__id") == F.col("__label_id")))
    of = features()
    row = F.struct(F.col("__quality"), *[c.alias(f"f_{n}") for n, c in of.items()])
    sample = rows.where(~base_failed()).groupBy("__id").agg(F.min(row).alias("row")).select("__id", "row.*").toPandas()
    sample = sample.sort_values(list(sample.columns), ignore_index=True)
    x = {n: sample[f"f_{n}"].to_numpy(float) for n in of}
    fold = sample["__id"].to_numpy(np.int64) * 2654435761 % (1 << 32) * 3 >> 32
    return learn(x, (sample["__quality"] == 0).to_numpy(bool), fold)


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: the 1-based number of the first rule that holds, 0 if none does."""
    of = features()
    number = F.lit(0)
    for k in range(len(rules), 0, -1):
        holds = F.lit(True)
        for c in rules[k - 1]:
            holds = holds & c.column(of)
        number = F.when(holds, k).otherwise(number)
    return number


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = 20_000) -> DataFrame:
    """Counts and verdict of every row: doc_id, counts, base_failed, rule, kept.

    A null or empty text has no words and fails the base rules. Repeated rows and null ids
    are judged like any others; an empty table gives no rows. Other columns aren't read.
    """
    rule = verdict(fit(docs, labels, id_col, text_col, max_labelled))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    judged = with_stats(picked).select("doc_id", *[_stat(f).alias(f) for f in _FIELDS], base_failed().alias("base_failed"), rule.alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@shielded
def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that judge() keeps, all columns as they were; nothing is shuffled."""
    rule = verdict(fit(docs, labels, id_col, text_col, max_labelled))
    return with_stats(docs, text_col).where(~base_failed() & (rule == 0)).select(*docs.columns)
