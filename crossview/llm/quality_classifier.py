"""Quality classifier by positive-unlabelled learning.

One scan, without a shuffle, turns every whole text into a few dense features
(shares of symbols, capitals, stray marks, repeats and so on). The features are
written to the shared folder; the rest works on them, always on all rows:
nothing is sampled.

1. Features become indicators of their range between quantiles of the unlabelled
   rows, which a histogram of all their values gives (to 1 part in 256).
2. A classifier of trusted positives against unlabelled text is fitted.
3. The class prior, the share of good documents in unlabelled text, is
   estimated from that classifier's scores: where only good documents score, the
   unlabelled share above a score over the positive share above it is the prior;
   the cut is the one whose ratio has the least upper confidence bound.
4. A classifier is fitted that minimises the non-negative unbiased risk
   ``prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])``
   with the logistic loss. Its score is the probability of a good document.

Both fits are convex: the risk is the larger of its values with and without its
second part, so it is the saddle point of ``A + k N`` for k from 0 to 1, where A
is the first part and N the second one without the maximum. Newton steps find
the minimum for k = 1; if N is negative there, the k is searched at which N is zero.
Each step is one pass over the feature table: tasks send sums of gradients and
curvatures over their rows, a few hundred kB whatever their number of rows.

Defined results: a null text counts as empty and has features like any other;
repeated rows score alike, and count as often as they occur; an id labelled more
than once takes its largest label; without positives or unlabelled rows all rows
score 0.5; an empty table gives no rows; other columns never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality_rules as rules
from . import textbytes as tb
from .common import drop_path, fold, fresh_path, stash, table, text_verdict

BINS, HISTOGRAM = 12, 1000
#: The ridge penalty is at least RIDGE, and RIDGE_ROWS over the number of positives, where these are few.
RIDGE, RIDGE_ROWS = 1e-3, 6
#: Newton steps end once a step promises less than TOLERANCE; the search for k ends once N is within SLACK of zero.
MAX_STEPS, TOLERANCE, MAX_HALVINGS, SLACK = 40, 1e-9, 30, 1e-3
#: Sums of so many groups of tasks are added up on the driver.
GROUPS = 16
THRESHOLD = 0.3
#: Of crc32(doc_id) mod 5, the fold whose labels are not learnt from.
FOLDS, HELD_OUT = 5, 0

FEATURES = (*rules.RULES, "repeats", "word_length", "log_words", "digits", "marks", "wide", "distinct", "line_words", "long_words")
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = ~tb.ALNUM & tb.SPACED
_WIDE = np.arange(256) >= 128


def features(t: tb.Texts) -> np.ndarray:
    """A row of float32 features for every text of a block."""
    m, w = rules.measure(t), tb.words(t, tb.SPACED)
    n, size = np.maximum(m["n_words"], 1), np.maximum(np.diff(t.offs), 1)
    h, doc = tb.word_hashes(t, w), w.doc
    key = np.sort(rules._keys(doc, h) >> tb.U64(20) | (doc.astype(tb.U64) << tb.U64(44)))
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
    distinct = np.bincount((key[first] >> tb.U64(44)).astype(np.int64), minlength=t.n)[: t.n]
    share = lambda lut: rules._per_text(lut[t.data], t.offs) / size
    lines = rules._per_text(t.data == 10, t.offs) + 1
    long = np.bincount(doc[(w.end - w.start) > 24], minlength=t.n) / n
    columns = [m[r] for r in rules.RULES] + [m["n_repeat_words"] / n, m["word_chars"] / n, np.log1p(m["n_words"]), share(_DIGIT), share(_MARK), share(_WIDE), distinct / n, np.log1p(n / lines), long]
    return np.stack(columns, 1).astype(np.float32)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = [features(t) for t in tb.blocks(b.column(1))]
        x = np.concatenate(parts) if parts else np.empty((0, len(FEATURES)), np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "x"])


def featurised(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_featurise, docs.select("doc_id").schema.add("x", T.ArrayType(T.FloatType())))


#: A feature's level: the upper bits of its 32-bit value, which order values as they are, as none is negative.
_LEVEL_BITS = 15


def levels(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0).astype(np.float32).view(np.uint32) >> np.uint32(_LEVEL_BITS)


def _quantiles(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Values just above the levels at which the given shares of all values are reached."""
    total = np.cumsum(counts)
    if not total[-1]:
        return np.empty(0, np.float32)
    at = np.searchsorted(total, np.maximum(shares * total[-1], 1))
    return ((at + 1).astype(np.uint32) << np.uint32(_LEVEL_BITS)).view(np.float32)


@dataclass
class Basis:
    """Indicators of the range between two quantiles that each feature falls in, and one that is always there."""

    edges: list[np.ndarray]

    @classmethod
    def of(cls, counts: np.ndarray) -> Basis:
        """From a histogram of levels for each feature."""
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        # Features that are mostly zero also get the quantiles of their other values.
        return cls([np.unique(np.r_[_quantiles(c, shares), _quantiles(np.r_[0, c[1:]], shares)]) for c in counts])

    def cells(self, x: np.ndarray) -> np.ndarray:
        """For each row the indices of its indicators."""
        start, out = 0, []
        for c, e in zip(x.T, self.edges, strict=True):
            out.append(start + np.searchsorted(e, c, "right"))
            start += len(e) + 1
        return np.stack([*out, np.full(len(x), start)], 1)

    @property
    def size(self) -> int:
        return sum(len(e) + 1 for e in self.edges) + 1


@dataclass
class Linear:
    basis: Basis
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.weights[self.basis.cells(x)].sum(1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Sums:
    """What a pass over all rows gives, for positives and for unlabelled rows: sums of the softplus of the margins, of
    margins, of their gradients; and one matrix of curvatures (its upper half), positives and unlabelled rows weighted."""

    loss: np.ndarray
    margin: np.ndarray
    slope: np.ndarray
    count: np.ndarray
    curve: np.ndarray

    @classmethod
    def none(cls, size: int) -> Sums:
        return cls(np.zeros(2), np.zeros(2), np.zeros((2, size)), np.zeros((2, size)), np.zeros(size * (size + 1) // 2))

    def add(self, cells: np.ndarray, w: np.ndarray, kind: int, weight: float) -> None:
        if not len(cells):
            return
        size, z = len(w), w[cells].sum(1)
        p = _sigmoid(z)
        self.loss[kind] += np.logaddexp(0, z).sum()
        self.margin[kind] += z.sum()
        self.slope[kind] += np.bincount(cells.ravel(), np.repeat(p, cells.shape[1]), size)
        self.count[kind] += np.bincount(cells.ravel(), minlength=size)
        if weight:
            v, n = weight * p * (1 - p), cells.shape[1]
            for i in range(n):  # cells are in ascending order
                for j in range(i, n):
                    a, b = cells[:, i], cells[:, j]
                    self.curve += np.bincount(a * (2 * size - a + 1) // 2 + b - a, v, len(self.curve))

    def raw(self) -> bytes:
        return np.concatenate([self.loss, self.margin, self.slope.ravel(), self.count.ravel(), self.curve]).tobytes()

    @classmethod
    def of(cls, raw: list[bytes], size: int) -> Sums:
        v = np.sum([np.frombuffer(x) for x in raw], axis=0) if raw else cls.none(size).flat()
        return cls(v[:2], v[2:4], v[4 : 4 + 2 * size].reshape(2, size), v[4 + 2 * size : 4 + 4 * size].reshape(2, size), v[4 + 4 * size :])

    def flat(self) -> np.ndarray:
        return np.frombuffer(self.raw())

    def matrix(self) -> np.ndarray:
        size = self.slope.shape[1]
        out = np.zeros((size, size))
        out[np.triu_indices(size)] = self.curve
        return out + np.triu(out, 1).T


@dataclass
class Problem:
    """Means over ``n`` positives and unlabelled rows: ``a`` times the softplus of margins, less ``b`` times the margins, and a ridge."""

    a: tuple[float, float]
    b: tuple[float, float]
    n: tuple[int, int]
    ridge: float

    def scaled(self, x: tuple[float, float]) -> np.ndarray:
        return np.array(x) / np.maximum(self.n, 1)

    def value(self, s: Sums, w: np.ndarray) -> float:
        return float(self.scaled(self.a) @ s.loss - self.scaled(self.b) @ s.margin + self.ridge / 2 * (w[:-1] @ w[:-1]))

    def minimum(self, passes, w: np.ndarray) -> tuple[np.ndarray, Sums]:
        """Newton steps from ``w``; ``passes`` (weights, weights of the curvatures) gives the sums over all rows."""
        penalty = np.r_[np.full(len(w) - 1, self.ridge), 1e-9]
        s = passes(w, self.scaled(self.a))
        best = self.value(s, w)
        for _ in range(MAX_STEPS):
            g = self.scaled(self.a) @ s.slope - self.scaled(self.b) @ s.count + penalty * w
            step = np.linalg.solve(s.matrix() + np.diag(penalty), g)
            if g @ step < TOLERANCE:
                break
            size = 1.0
            while True:
                new = w - size * step
                t = passes(new, self.scaled(self.a))
                value = self.value(t, new)
                if value < best or size < 1e-3:
                    break
                size /= 4
            if value >= best:
                break
            w, s, best = new, t, value
        return w, s


def fit_known(passes, size: int, n: tuple[int, int], ridge: float) -> np.ndarray:
    """Positives against unlabelled, both classes with the same weight."""
    return Problem((1.0, 1.0), (1.0, 0.0), n, ridge).minimum(passes, np.zeros(size))[0]


def fit_nnpu(passes, size: int, n: tuple[int, int], prior: float, ridge: float) -> np.ndarray:
    """Minimise the non-negative unbiased risk with the logistic loss."""

    def solve(k: float, w: np.ndarray) -> tuple[np.ndarray, float]:
        w, s = Problem((prior * (1 - k), k), (prior, 0.0), n, ridge).minimum(passes, w)
        mean = s.loss / np.maximum(n, 1)
        return w, float(mean[1] - prior * mean[0])

    w, negative = solve(1.0, np.zeros(size))
    low = high = 1.0
    while negative < 0 and low > 1e-9:  # downwards to a k at which N is positive; weights shrink with k
        low, high, at_high = low / 4, low, negative
        w, negative = solve(low, w / 4)
    at_low = negative
    for _ in range(MAX_HALVINGS if high > low else 0):  # a secant between the ends, the end that stays counting half
        if abs(negative) <= SLACK:
            break
        k = low + (high - low) * at_low / (at_low - at_high)
        w, negative = solve(k, w)
        if negative > 0:
            low, at_low, at_high = k, negative, at_high / 2
        else:
            high, at_high, at_low = k, negative, at_low / 2
    return w


def class_prior(pos: np.ndarray, unl: np.ndarray, failure: float = 0.1) -> float:
    """The share of positives among unlabelled rows, from histograms of their scores (lowest cell first)."""
    n_pos, n_unl = pos.sum(), unl.sum()
    if not n_pos or not n_unl:
        return 0.5
    qp, qu = np.cumsum(pos[::-1]) / n_pos, np.cumsum(unl[::-1]) / n_unl
    error = np.sqrt(np.log(4 / failure) / (2 * n_pos)) + np.sqrt(np.log(4 / failure) / (2 * n_unl))
    usable = qp > 1e-9
    bound = np.where(usable, (qu + 1.01 * error) / np.maximum(qp, 1e-9), np.inf)
    best = int(np.argmin(bound))
    return float(min(max(qu[best] / qp[best], 0.01), 0.99))


def _histogram(model: Linear):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, HISTOGRAM), np.int64)
        for b in batches:
            x, known = _matrix(b.column(0)), np.asarray(b.column(1)).astype(bool)
            cell = np.minimum((model.score(x) * HISTOGRAM).astype(int), HISTOGRAM - 1)
            counts[1] += np.bincount(cell[known], minlength=HISTOGRAM)
            counts[0] += np.bincount(cell[~known], minlength=HISTOGRAM)
        kind, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int64()), pa.array(cell, pa.int64()), pa.array(counts[kind, cell])], ["known", "cell", "n"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float32).reshape(len(column), len(FEATURES))


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(FEATURES), 1 << (32 - _LEVEL_BITS - 1)), np.int64)
    for b in batches:
        for c, v in zip(counts, levels(_matrix(b.column(0))).T, strict=True):
            c += np.bincount(v, minlength=len(c))
    feature, level = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(level), pa.array(counts[feature, level])], ["feature", "level", "n"])


def _pass(basis: Basis, w: np.ndarray, curves: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sums.none(len(w))
        for b in batches:
            cells = basis.cells(_matrix(b.column(0)))
            for kind in (0, 1):
                use = np.asarray(b.column(1 + kind)).astype(bool)
                total.add(cells[use], w, kind, curves[kind])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()), pa.array([total.raw()], pa.binary())], ["part", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = None
    for x in table.column("sums"):
        v = np.frombuffer(x.as_py())
        total = v.copy() if total is None else total + v
    return pa.Table.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def fit(x: DataFrame, labels: DataFrame, keep) -> Linear | None:
    """The non-negative risk classifier, from a feature table and the labelled rows that ``keep`` selects."""
    spark = x.sparkSession
    good = labels.where(keep & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id", F.lit(True).alias("known"))
    path = fresh_path(spark, "quality-rows")
    rows = stash(x.join(good, "doc_id", "left").select("x", F.coalesce("known", F.lit(False)).alias("known"), keep.alias("unlabelled")), "quality-rows", path)
    try:
        counted = rows.where("unlabelled").select("x").mapInArrow(_levels, "feature long, level long, n long").groupBy("feature", "level").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros((len(FEATURES), 1 << (32 - _LEVEL_BITS - 1)), np.int64)
        counts[counted.feature.to_numpy(int), counted.level.to_numpy(int)] = counted.n.to_numpy(int)
        n = (rows.where("known").count(), int(counts[0].sum()))
        if not all(n):
            return None
        basis, ridge = Basis.of(counts), max(RIDGE, RIDGE_ROWS / n[0])

        def passes(w: np.ndarray, curves: np.ndarray) -> Sums:
            parts = rows.mapInArrow(_pass(basis, w, curves), "part int, sums binary").groupBy("part").applyInArrow(_added, "sums binary").collect()
            return Sums.of([bytes(r.sums) for r in parts], len(w))

        known = Linear(basis, fit_known(passes, basis.size, n, ridge))
        # All rows count here: positives against everything that is not a trusted positive, put together again below.
        cells = rows.select("x", "known").mapInArrow(_histogram(known), "known long, cell long, n long").groupBy("known", "cell").agg(F.sum("n").alias("n")).collect()
        tally = np.zeros((2, HISTOGRAM))
        for r in cells:
            tally[r.known][r.cell] += r.n
        return Linear(basis, fit_nnpu(passes, basis.size, n, class_prior(tally[1], tally.sum(0)), ridge))
    finally:
        drop_path(spark, path)


def _score(model: Linear | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(_matrix(b.column(1))) if model else np.full(len(b), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, keep=None) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    keep = fold("doc_id", FOLDS) != HELD_OUT if keep is None else keep
    x = stash(featurised(docs), "quality")
    return x.mapInArrow(_score(fit(x, labels, keep)), x.select("doc_id").schema.add("score", "double"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, unchanged; features are computed again where rows are kept."""
    path = fresh_path(docs.sparkSession, "quality")
    model = fit(stash(featurised(docs), "quality", path), labels, fold("doc_id", FOLDS) != HELD_OUT)
    drop_path(docs.sparkSession, path)

    def good(text: pa.Array) -> pa.Array:
        parts = [features(t) for t in tb.blocks(text)]
        s = model.score(np.concatenate(parts)) if model and parts else np.full(len(text), 0.5)
        return pa.array(s >= threshold)

    return docs.where(text_verdict(docs, good))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
