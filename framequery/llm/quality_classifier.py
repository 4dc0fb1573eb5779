"""Quality classifier by co-training a text view and a page-metadata view.

The text view sees hashed words; the metadata view sees language, source and the page's
form (lengths, lines, shares of kinds of characters) in quantile bins. Both are logistic
regressions. From a bounded sample of labelled documents they start apart; each round every
unlabelled document of the corpus is scored, and the documents that one view is surest of
become pseudo-labelled examples of the other, as far as it is sure by a calibration on the
held-out labels. At the end each view is calibrated on labelled
documents that were held out, the calibrated log-odds are combined, the lower one counting
extra where that helps (a view may be blind to what the other sees), and all documents scored.
Toxic words are few and drown in a long text's unit-length row, so documents are also dropped
for the mere presence of words that mark toxic ones, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Labelled documents in the fit, pseudo-labels that a view gives a class and round, and rounds.
MAX_LABELLED = 8000
EXCHANGE = 300
ROUNDS = 3
#: Calibrated probability from which a view is sure enough to teach the other.
CONFIDENT = 0.95
WORD_BUCKETS = 1 << 16
BINS = 16
NAME_BUCKETS = 128
#: Share of good held-out documents that the threshold may cost.
LOSS = 0.01
#: The same for toxic words; a word marks by a lower bound of its log-odds, the strongest few count.
TOXIC_LOSS = 0.005
TOXIC_BOUND = 3.0
TOXIC_WORDS = 3
_MOST_KEPT = 500_000
_DROPPED = b".,;:"
_FORM = ("log_chars", "log_lines", "line_length", "word_length", "upper", "symbols", "marks", "digits", "bars", "other", "new_words", "new_pairs", "log_words")
_SCHEMA = "doc_id long, words binary, counts binary, form array<float>, lang int, source int"


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = bucket = xxhash.xxh64_intdigest(word) % WORD_BUCKETS
        return bucket


_buckets = _Buckets()


def word_counts(text: str) -> tuple[bytes, bytes]:
    """Buckets (uint16) of a text's words, and their counts up to 255 (uint8), as bytes."""
    if len(_buckets) > _MOST_KEPT:
        _buckets.clear()
    words = text.encode().lower().translate(None, _DROPPED).split()
    used, n = np.unique(np.fromiter(map(_buckets.__getitem__, words), np.uint16, len(words)), return_counts=True)
    return used.astype("<u2").tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes()


def page_form(text: str, n_chars: int | None) -> list[float]:
    """The numbers of the metadata view, in the order of ``_FORM``; they see whether words recur, not which."""
    raw, n = text.encode(), max(1, len(text))
    share = lambda signs: len(raw) - len(raw.translate(None, signs))
    lines, words = text.count("\n") + 1, max(1, text.count(" ") + text.count("\n") + 1)
    own = raw.split()
    pairs = max(1, len(own) - 1)
    return [
        float(np.log1p(max(0, len(text) if n_chars is None else n_chars))), float(np.log1p(lines)), n / lines, n / words,
        share(bytes(range(65, 91))) / n, share(b"#*$%&<>") / n, share(b"!?") / n, share(b"0123456789") / n, text.count("|") / n, (len(raw) - len(text)) / n,
        len(set(own)) / max(1, len(own)), len(set(zip(own, own[1:], strict=False))) / pairs, float(np.log1p(len(own))),
    ]


def view_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both views of every row, from whole texts: see ``_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            words = [word_counts(t) for t in texts]
            forms = [page_form(t, n) for t, n in zip(texts, b.column(2).to_pylist(), strict=True)]
            names = [pa.array([xxhash.xxh64_intdigest(f"{kind}={x}".encode()) % NAME_BUCKETS for x in b.column(c).to_pylist()], pa.int32()) for c, kind in ((3, "lang"), (4, "source"))]
            columns = [b.column(0), pa.array([w for w, _ in words], pa.binary()), pa.array([c for _, c in words], pa.binary()), pa.array(forms, pa.list_(pa.float32())), *names]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "words", "counts", "form", "lang", "source"])

    have = lambda c, kind: F.col(c).cast(kind) if c in docs.columns else F.lit(None).cast(kind)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), have("n_chars", "long").alias("n"), have("lang", "string").alias("lang"), have("source", "string").alias("source"))
    return picked.mapInArrow(run, _SCHEMA)


@dataclass(frozen=True)
class Sparse:
    """Rows of (column, value) pairs, one after another."""

    column: np.ndarray
    value: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.append(0.0, np.cumsum(w[self.column] * self.value))[np.append(0, self.ends)]
        return np.diff(sums)

    def scatter(self, row_values: np.ndarray, n_columns: int) -> np.ndarray:
        sizes = np.diff(np.append(0, self.ends))
        return np.bincount(self.column, np.repeat(row_values, sizes) * self.value, n_columns)


def text_rows(words: list[bytes], counts: list[bytes], idf: np.ndarray) -> Sparse:
    """Unit-length rows of log counts weighed by rarity."""
    sizes = np.fromiter(map(len, counts), np.int64, len(counts))
    column = np.frombuffer(b"".join(words), "<u2").astype(np.int64)
    value = np.log1p(np.frombuffer(b"".join(counts), np.uint8).astype(float)) * idf[column]
    ends = np.cumsum(sizes)
    squares = np.diff(np.append(0.0, np.cumsum(value * value))[np.append(0, ends)])
    return Sparse(column, value / np.repeat(np.sqrt(np.maximum(squares, 1e-12)), sizes), ends)


def page_rows(form: np.ndarray, lang: np.ndarray, source: np.ndarray, edges: np.ndarray) -> Sparse:
    """Rows with a one for each number's bin and for each name."""
    bins = [np.searchsorted(edges[k], form[:, k]) + k * (BINS + 1) for k in range(len(_FORM))]
    column = np.stack([*bins, lang + len(_FORM) * (BINS + 1), source + len(_FORM) * (BINS + 1) + NAME_BUCKETS], axis=1)
    n = column.shape[1]
    return Sparse(column.ravel(), np.full(column.size, n**-0.5), np.arange(1, len(column) + 1) * n)


PAGE_COLUMNS = len(_FORM) * (BINS + 1) + 2 * NAME_BUCKETS


@dataclass(frozen=True)
class Logistic:
    w: np.ndarray
    b: float

    def odds(self, x: Sparse) -> np.ndarray:
        return x.dot(self.w) + self.b


def train(x: Sparse, y: np.ndarray, n_columns: int, steps: int = 150, rate: float = 0.3, ridge: float = 2e-6) -> Logistic:
    """Logistic regression by full-batch steps of adaptive size, classes weighed evenly."""
    good = max(1, int(y.sum()))
    weight = np.where(y, 0.5 / good, 0.5 / max(1, len(y) - good))
    w, b = np.zeros(n_columns), 0.0
    m, v = np.zeros(n_columns + 1), np.zeros(n_columns + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30)))
        miss = (p - y) * weight
        g = np.append(x.scatter(miss, n_columns) + ridge * w, miss.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Logistic(w, float(b))


def platt(odds: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset that turn a view's odds into calibrated log-odds, by damped Newton steps.

    A view whose odds don't rise with goodness gets slope 0 and says the prior.
    """
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    centre, width = float(odds.mean()), float(odds.std()) or 1.0
    x = (odds - centre) / width

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((np.logaddexp(0, z) - target * z).sum()) + 0.05 * a * a

    a, b = 0.0, float(np.log(target.mean() / (1 - target.mean())))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a * x + b)))
        d, h = p - target, p * (1 - p) + 1e-9
        step = np.linalg.solve([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum()]], [(d * x).sum() + 0.1 * a, d.sum()])
        size = 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * float(step[0]), b - size * float(step[1])
    if a <= 0:
        return 0.0, float(np.log(target.mean() / (1 - target.mean())))
    return a / width, b - a * centre / width


@dataclass(frozen=True)
class CoTrained:
    """Both views' models with what turns a row into a score."""

    idf: np.ndarray
    edges: np.ndarray
    text: Logistic
    page: Logistic
    text_scale: tuple[float, float] = (1.0, 0.0)
    page_scale: tuple[float, float] = (1.0, 0.0)
    mix: tuple[float, float, float, float] = (1.0, 1.0, 0.0, 0.0)
    threshold: float = 0.5
    toxic: np.ndarray | None = None
    toxic_threshold: float = 0.0

    def odds(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Each view's odds for a batch whose columns follow ``_SCHEMA``."""
        return self.text.odds(text_rows(b.column(1).to_pylist(), b.column(2).to_pylist(), self.idf)), self.page.odds(page_rows(*_page_columns(b), self.edges))

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the text view, the page view and both together."""
        a = self.text_scale[0] * text + self.text_scale[1]
        b = self.page_scale[0] * page + self.page_scale[1]
        chance = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return chance(a), chance(b), chance(_both(a, b) @ np.array(self.mix))


    def kept(self, b: pa.RecordBatch, score: np.ndarray) -> np.ndarray:
        """Whether each row's score and its words' marks of toxicity let it stay."""
        good = score >= self.threshold
        return good if self.toxic is None else good & (toxicity(b.column(1).to_pylist(), self.toxic) <= self.toxic_threshold)


def toxic_weights(words: list[bytes], toxic: np.ndarray) -> np.ndarray | None:
    """How surely each word bucket's presence marks toxic documents (nought: it doesn't); None without both classes."""
    if toxic.all() or not toxic.any():
        return None
    n = [np.bincount(np.frombuffer(b"".join(w for w, t in zip(words, toxic, strict=True) if t == k), "<u2"), minlength=WORD_BUCKETS) + 0.5 for k in (True, False)]
    lift = np.log(n[0] / (toxic.sum() + 1)) - np.log(n[1] / ((~toxic).sum() + 1))
    return np.maximum(lift - TOXIC_BOUND * np.sqrt(1 / n[0] + 1 / n[1]), 0.0)


def toxicity(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Sum of the TOXIC_WORDS greatest weights among each row's words."""
    out = np.zeros(len(words))
    for k, w in enumerate(words):
        v = weights[np.frombuffer(w, "<u2")]
        v = v[v > 0]
        out[k] = np.sort(v)[-TOXIC_WORDS:].sum()
    return out


def cut_off(good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold that catches most bad scores at a loss of LOSS of the good ones, no higher above one half than that takes."""
    if not len(good):
        return 0.5
    most = float(np.quantile(good, LOSS))
    caught = bad[bad < most]
    return max(min(0.5, most), float(np.nextafter(caught.max(), 1)) if len(caught) else 0.0)


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the combination weighs: each view's log-odds, the lower of them, and one."""
    return np.stack([a, b, np.minimum(a, b), np.ones(len(a))], axis=1)


def combination(a: np.ndarray, b: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 0.5) -> tuple[float, float, float, float]:
    """Weights of ``_both`` by ridged logistic regression, drawn towards the plain sum of log-odds.

    Negative weights of a view or of the lower one become nought.
    """
    x, start = np.clip(_both(a, b), -12, 12), np.array([0.5, 0.5, 0.0, 0.0])
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(4)
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * (w - start))
        w = w - step / max(1.0, float(np.abs(step).max()))
        w[:3] = np.maximum(w[:3], 0.0)
    return tuple(map(float, w))


def _page_columns(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    form = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_FORM))
    return form, b.column(4).to_numpy(), b.column(5).to_numpy()


def rarity(features: DataFrame) -> np.ndarray:
    """Inverse document frequency of each word bucket, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(WORD_BUCKETS, np.int64), 0
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2"), minlength=WORD_BUCKETS)
            rows += b.num_rows
        if rows:
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, used)), pa.array(np.append(rows, n[used]))], names=["bucket", "n"])

    counted = features.select("words").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = {r["bucket"]: r["n"] for r in counted}
    total = n.get(-1, 0)
    return np.array([np.log((1 + total) / (1 + n.get(k, 0))) + 0.1 for k in range(WORD_BUCKETS)])


def _one_each(features: DataFrame, *more: str) -> DataFrame:
    """One row an id (the least, where an id has several), for the driver's bounded samples."""
    row = F.struct("words", "counts", "form", "lang", "source", *more)
    return features.groupBy("doc_id").agg(F.min(row).alias("__row")).select("doc_id", "__row.*")


def _floors(scales: tuple[tuple[float, float], tuple[float, float]], confident: float = CONFIDENT) -> dict[tuple[str, bool], float]:
    """How far a view's odds must lie on a class's side for that probability; a view that tells nothing never gets there."""
    z = float(np.log(confident / (1 - confident)))
    return {(view, good): (z + (-c if good else c)) / k if k > 0 else np.inf for view, (k, c) in zip(("text", "page"), scales, strict=True) for good in (True, False)}


def surest(features: DataFrame, model: CoTrained, taken: frozenset[int], k: int, floors: dict[tuple[str, bool], float] | None = None, salts: int = 64) -> dict[tuple[str, bool], pa.Table]:
    """For each view and class the ``k`` documents it is surest of, of all that have neither label nor pseudo-label.

    ``taken`` holds the pseudo-labelled ids, a bounded number, and ``floors`` the least odds
    that count, see _floors(). Each task gives the ids of its
    own ``k`` of each kind, which are ranked within salted parts before they meet; the
    features of the at most four times ``k`` that are left are then read again. Rows with a
    null id aren't asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            b = b.filter(pa.array([i not in taken for i in b.column(0).to_pylist()], pa.bool_()))
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            for view, z in zip(("text", "page"), model.odds(b), strict=True):
                for good in (True, False):
                    before = held.get((view, good), (np.zeros(0), np.zeros(0, np.int64)))
                    now = z if good else -z
                    enough = now >= floors[view, good] if floors else np.ones(len(now), bool)
                    sure, own = np.append(before[0], now[enough]), np.append(before[1], ids[enough])
                    best = np.lexsort((own, -sure))
                    best = best[np.sort(np.unique(own[best], return_index=True)[1])][:k]
                    held[view, good] = sure[best], own[best]
        for (view, good), (sure, own) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([view] * len(own), pa.string()), pa.array([good] * len(own), pa.bool_()), pa.array(own), pa.array(sure)], names=["view", "good", "doc_id", "sure"])

    left = features.where("doc_id is not null AND good is null").select("doc_id", "words", "counts", "form", "lang", "source")
    found = left.mapInArrow(run, "view string, good boolean, doc_id long, sure double").groupBy("view", "good", "doc_id").agg(F.max("sure").alias("sure"))
    order = [F.desc("sure"), F.col("doc_id")]
    part = Window.partitionBy("view", "good", F.pmod(F.xxhash64("doc_id"), F.lit(salts))).orderBy(*order)
    best = found.withColumn("place", F.row_number().over(part)).where(F.col("place") <= k)
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("view", "good").orderBy(*order))).where(F.col("place") <= k)
    chosen = best.select("view", "good", "doc_id").toPandas()
    ids = features.sparkSession.createDataFrame(chosen[["doc_id"]].drop_duplicates(), "doc_id long") if len(chosen) else left.select("doc_id").limit(0)
    table = _one_each(left.join(F.broadcast(ids), "doc_id", "left_semi")).toArrow().sort_by("doc_id")
    at = table.column("doc_id").to_numpy()
    kinds = {(v, g): set(chosen[(chosen["view"] == v) & (chosen["good"] == g)]["doc_id"]) for v in ("text", "page") for g in (True, False)}
    return {kind: table.filter(pa.array([i in own for i in at.tolist()], pa.bool_())) for kind, own in kinds.items()}


def _rows_of(table: pa.Table) -> pa.RecordBatch:
    batches = table.combine_chunks().to_batches()
    return batches[0] if batches else pa.RecordBatch.from_pylist([], schema=table.schema)


def _stack(parts: list[Sparse]) -> Sparse:
    ends, at = [], 0
    for p in parts:
        ends.append(p.ends + at)
        at += len(p.column)
    return Sparse(np.concatenate([p.column for p in parts]), np.concatenate([p.value for p in parts]), np.concatenate(ends))


def co_train(features: DataFrame, max_labelled: int = MAX_LABELLED, exchange: int = EXCHANGE, rounds: int = ROUNDS) -> CoTrained | float:
    """The trained views, or the share of good labels where only one class (or none: 0.5) is labelled.

    ``features`` are those of labelled_features(). At most ``max_labelled`` labelled documents, those of least hashed id, take part; a fifth
    is held out for calibration and the threshold. Everything else is over all documents.
    """
    labelled = features.where("doc_id is not null AND good is not null")
    chosen = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    table = _one_each(labelled.join(F.broadcast(chosen), "doc_id"), "good", "toxic").toArrow().sort_by("doc_id")
    y = np.array(table.column("good").to_pylist(), bool)
    if not len(y) or y.all() or not y.any():
        return float(y.mean()) if len(y) else 0.5
    batch = _rows_of(table)
    form = _page_columns(batch)[0]
    edges = np.stack([np.quantile(form[:, k], np.linspace(0, 1, BINS + 1)[1:-1]) for k in range(len(_FORM))])
    idf = rarity(features)
    text_x = lambda b: text_rows(b.column(1).to_pylist(), b.column(2).to_pylist(), idf)
    page_x = lambda b: page_rows(*_page_columns(b), edges)

    held = np.array([xxhash.xxh64_intdigest(str(i).encode(), 5) % 5 == 0 for i in table.column("doc_id").to_pylist()])
    held = held if y[~held].any() and not y[~held].all() else np.zeros(len(y), bool)
    seen = _rows_of(table.filter(pa.array(~held)))
    text_set, text_y = [text_x(seen)], [y[~held]]
    page_set, page_y = [page_x(seen)], [y[~held]]

    def trained() -> CoTrained:
        return CoTrained(idf, edges, train(_stack(text_set), np.concatenate(text_y), WORD_BUCKETS), train(_stack(page_set), np.concatenate(page_y), PAGE_COLUMNS))

    judge = _rows_of(table.filter(pa.array(held))) if held.any() else seen
    truth = y[held] if held.any() else y[~held]
    model = trained()
    taken: set[int] = set()
    for _ in range(rounds):
        floors = _floors(tuple(platt(z, truth) for z in model.odds(judge)))
        for (view, good), picked in surest(features, model, frozenset(taken), exchange, floors).items():
            b = _rows_of(picked)
            if not b.num_rows:
                continue
            taken.update(picked.column("doc_id").to_pylist())
            # what one view is sure of teaches the other
            if view == "text":
                page_set.append(page_x(b))
                page_y.append(np.full(b.num_rows, good))
            else:
                text_set.append(text_x(b))
                text_y.append(np.full(b.num_rows, good))
        model = trained()

    z_text, z_page = model.odds(judge)
    scales = platt(z_text, truth), platt(z_page, truth)
    mix = combination(*(k * z + c for z, (k, c) in zip((z_text, z_page), scales, strict=True)), truth)
    model = CoTrained(idf, edges, model.text, model.page, *scales, mix)
    score = model.scores(z_text, z_page)[2]
    toxic = toxic_weights(seen.column(1).to_pylist(), np.array(seen.column(7).to_pylist(), bool))
    marks = toxicity(judge.column(1).to_pylist(), toxic)[truth] if toxic is not None else np.zeros(0)
    bearable = float(np.quantile(marks, 1 - TOXIC_LOSS, method="higher")) if len(marks) else 0.0
    return CoTrained(idf, edges, model.text, model.page, *scales, mix, cut_off(score[truth], score[~truth]), toxic, bearable)


def good_label(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): good is of quality and not toxic; null where quality is. A null toxic counts as not toxic."""
    toxic: Column = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return labels.select("doc_id", F.when(F.col("quality").isNotNull(), (F.col("quality") == 1) & (toxic == 0)).alias("good"), (toxic != 0).alias("toxic"))


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both views of every row with its label (null: none), written once; the rounds then shuffle nothing.

    The join is a sort-merge join at every size, as labels may be as many as documents. Rows
    with a null id meet no label and are dealt by their words, not to one task.
    """
    known = good_label(labels).where("doc_id is not null and good is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("good").alias("good"), F.max("toxic").alias("toxic"))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("words"), F.lit(4096)) + 1).otherwise(0).alias("salt")
    features = view_features(docs, id_col, text_col).select("*", salt)
    met = features.join(known.withColumn("salt", F.lit(0).cast("long")).hint("merge"), ["doc_id", "salt"], "left")
    return materialize(met.drop("salt"), "views")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text_score, page_score, score, kept) of every row of ``docs``.

    Scores are probabilities of being good. A null text is empty; missing or null metadata
    are values like others. Repeated rows and null ids are scored like any others, and an
    empty table gives no rows. Where the labels have one class or none, every score is the
    share of good labels (0.5 without labels) and every row is kept.
    """
    features = labelled_features(docs, labels, id_col, text_col)
    model = co_train(features, max_labelled)
    if not isinstance(model, CoTrained):
        same = F.lit(model)
        return features.select("doc_id", same.alias("text_score"), same.alias("page_score"), same.alias("score"), F.lit(True).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                scores = model.scores(*model.odds(b))
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, scores), pa.array(model.kept(b, scores[2]))], names=["doc_id", "text_score", "page_score", "score", "kept"])

    return features.mapInArrow(run, "doc_id long, text_score double, page_score double, score double, kept boolean")
