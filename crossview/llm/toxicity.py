"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its characters (code points, A-Z
lower-cased, white space as blanks, a blank before and after the text), so that
an n-gram may show where a word begins or ends. For each n-gram the log ratio of
its smoothed document counts in toxic and clean training texts is taken;
n-grams whose ratio differs from zero by less than ``min_z`` standard errors are
left out, all others are features. A logistic regression is trained on the
presence of these, scaled by their ratios.

The classifier is fitted on a bounded sample: at most ``per_class`` labelled ids
of each class, the first in a fixed pseudo-random order of the id. Their texts
are turned into n-grams by tasks, which send counts by range of hashes; the
counts are exact. The driver gets the telling n-grams and, for each sampled id,
which of them it has; never a text. The intercept is then moved to the share of
toxic texts among all labelled training rows. Scoring is one scan of whole texts
without a shuffle.

Defined results: a null or empty text scores by the intercept alone; repeated
rows score alike; an id labelled more than once takes its largest label, an id
with several texts trains with the smallest one; without labels of both classes
all texts score the share of toxic labels (as good as 0 without any, so that
nothing is dropped); an empty table gives no rows; other columns never enter a
score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import drop_path, fold, fresh_path, labelled_sample, stash, table, text_verdict

SIZES = (3, 4, 5, 6, 7, 8)
PER_CLASS = 2000
MIN_Z, SMOOTH, RIDGE = 3.0, 1.0, 2e-3
THRESHOLD = 0.3
#: Of crc32(doc_id) mod 4, the fold whose labels are not learnt from.
FOLDS, HELD_OUT = 4, 2
#: Tasks that turn sampled texts into n-grams, and ranges of hashes that are counted together.
SAMPLE_TASKS, PARTS = 6, 16

_BLANK = tb.LOWER.copy()
_BLANK[9:14] = 32


class Characters:
    """The characters of a block's texts, each text between two blanks, ready for hashes of n-grams."""

    def __init__(self, t: tb.Texts):
        t = padded(t)
        starts = np.flatnonzero((t.data & 0xC0) != 0x80)
        self.offs = np.searchsorted(starts, t.offs)
        if len(starts) == len(t.data):
            values = tb.byte_values(t.data)
        else:  # a hash for each character's bytes; that of a single byte is its value
            acc, ends = tb.prefix(t.data), np.r_[starts[1:], len(t.data)]
            values = (acc[ends] - acc[starts]) * tb.powers("down", len(acc))[starts]
        self.n, self.acc = len(starts), tb.prefix_of(values)

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all n-grams, at the characters where they begin."""
        n = self.n - size + 1
        if n <= 0:
            return np.empty(0, tb.U64)
        h = self.acc[size:] - self.acc[:-size]
        h *= tb.powers("down", n)
        h += tb.U64(size)
        h ^= h >> tb.U64(32)
        h *= tb.U64(0xD6E8FEB86659FD93)
        return h

    def owners(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The text of each n-gram, and whether it ends in that text."""
        doc = np.searchsorted(self.offs, at, "right") - 1
        return doc, at + size <= self.offs[doc + 1]


@dataclass
class Model:
    sizes: tuple[int, ...]
    intercept: float
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, tb.U64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    @cached_property
    def known(self) -> tb.HashSet:
        return tb.HashSet(self.keys)

    def found(self, t: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a block's text and a feature that it has, each once, in order."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        c, pairs = Characters(t), []
        for s in self.sizes:
            at, which = self.known.find(c.grams(s))
            doc, inside = c.owners(at, s)
            pairs.append(doc[inside] * len(self.keys) + which[inside])
        pairs = tb.distinct(np.concatenate(pairs))
        return pairs // len(self.keys), pairs % len(self.keys)

    def scores(self, column: pa.Array) -> np.ndarray:
        out = [np.empty(0)]
        for t in tb.blocks(column):
            doc, which = self.found(t)
            total = self.intercept + np.bincount(doc, self.weights[which], t.n)
            out.append(1 / (1 + np.exp(-np.clip(total, -40, 40))))
        return np.concatenate(out)


def padded(t: tb.Texts) -> tb.Texts:
    """The block's texts, each between two blanks."""
    offs = t.offs + 2 * np.arange(t.n + 1)
    data = np.full(offs[-1], 32, np.uint8)
    lengths = np.diff(t.offs)
    data[np.arange(len(t.data)) + np.repeat(2 * np.arange(t.n) + 1, lengths)] = _BLANK[t.data]
    return tb.Texts(data, offs, t.first)


def _z(one: np.ndarray, zero: np.ndarray, n1: int, n0: int, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratios and how many standard errors they differ from zero."""
    ratio = np.log((one + smooth) / (n1 + 2 * smooth)) - np.log((zero + smooth) / (n0 + 2 * smooth))
    error = np.sqrt(1 / (one + smooth) + 1 / (zero + smooth) - 1 / (n1 + 2 * smooth) - 1 / (n0 + 2 * smooth))
    return ratio, ratio / np.maximum(error, 1e-9)


def _count(sizes: tuple[int, ...]):
    """From (label, text) a row for each range of hashes: the different n-grams, and how many texts of each label have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = np.asarray(b.column(0)).astype(np.int64)
            for t in tb.blocks(b.column(1)):
                c = Characters(t)
                for s in sizes:
                    h = c.grams(s)
                    doc, inside = c.owners(np.arange(len(h)), s)
                    order = np.lexsort((h[inside], doc[inside]))
                    h, doc = h[inside][order], doc[inside][order]
                    once = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
                    keys, where = np.unique(h[once], return_inverse=True)
                    y = labels[t.first + doc[once]]
                    one = np.bincount(where, y, len(keys)).astype(np.uint32)
                    zero = np.bincount(where, 1 - y, len(keys)).astype(np.uint32)
                    part = (keys >> tb.U64(60)).astype(np.int64) * PARTS // 16
                    cut = np.searchsorted(part, np.arange(PARTS + 1))
                    rows = [(p, tb.keys_out(keys[a:e]), tb.planes(one[a:e]), tb.planes(zero[a:e])) for p, (a, e) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < e]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["part", "keys", "one", "zero"])

    return run


def _telling(n1: int, n0: int, min_z: float, smooth: float):
    """Of one range of hashes the n-grams whose ratio differs enough from zero: (key, ratio)."""

    def run(counted: pa.Table) -> pa.Table:
        add = lambda c: np.concatenate([tb.unplanes(x.as_py(), np.uint32) for x in counted.column(c)])
        keys, where = np.unique(np.concatenate([tb.keys_in(x.as_py()) for x in counted.column("keys")]), return_inverse=True)
        one, zero = np.bincount(where, add("one"), len(keys)), np.bincount(where, add("zero"), len(keys))
        ratio, z = _z(one, zero, n1, n0, smooth)
        use = np.abs(z) >= min_z
        return pa.Table.from_arrays([pa.array(keys[use].view(np.int64)), pa.array(ratio[use])], ["key", "ratio"])

    return run


def _present(keys: np.ndarray, sizes: tuple[int, ...]):
    """From (doc_id, label, text) each row's id and label, and the features that it has as 32-bit numbers."""
    model = Model(sizes, 0.0, keys, np.zeros(len(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tb.blocks(b.column(2)):
                doc, which = model.found(t)
                ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=t.n))]
                raw = which.astype(np.int32).tobytes()
                has = pa.array([raw[4 * a : 4 * e] for a, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, t.n), b.column(1).slice(t.first, t.n), has], ["doc_id", "label", "has"])

    return run


@dataclass
class Rows:
    """A sparse matrix by rows: row i has the columns ``column[start[i]:start[i + 1]]``, scaled by ``scale``."""

    column: np.ndarray
    start: np.ndarray
    scale: np.ndarray

    def __post_init__(self) -> None:
        own = np.repeat(np.arange(len(self.start) - 1, dtype=np.int32), np.diff(self.start))
        order = np.argsort(self.column, kind="stable")
        self._by_column, self._ends = own[order], np.searchsorted(self.column[order], np.arange(len(self.scale) + 1))

    @staticmethod
    def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x) + 1)
        np.cumsum(x, out=total[1:])
        return total[ends[1:]] - total[ends[:-1]]

    def times(self, w: np.ndarray) -> np.ndarray:
        return self._sums((w * self.scale)[self.column], self.start)

    def transposed(self, g: np.ndarray) -> np.ndarray:
        return self.scale * self._sums(g[self._by_column], self._ends)


def logistic(x: Rows, y: np.ndarray, ridge: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by accelerated gradient steps, from zero."""
    n = len(y)
    b = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w = np.zeros(len(x.scale))
    if not len(w):
        return w, b
    v = np.random.default_rng(5).normal(size=len(w))
    for _ in range(12):  # the largest eigenvalue bounds the step
        v = x.transposed(x.times(v))
        v /= np.linalg.norm(v) or 1.0
    rate = 1 / (0.25 * (float(np.sum(x.times(v) ** 2)) / n * 1.05 + 1) + ridge)
    pw, pb = w.copy(), b
    for k in range(steps):
        m = k / (k + 3)
        lw, lb = w + m * (w - pw), b + m * (b - pb)
        g = 1 / (1 + np.exp(-np.clip(x.times(lw) + lb, -40, 40))) - y
        pw, pb = w, b
        w, b = lw - rate * (x.transposed(g) / n + ridge * lw), lb - rate * float(g.mean())
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label: str, keep, per_class: int = PER_CLASS, sizes: tuple[int, ...] = SIZES, min_z: float = MIN_Z, smooth: float = SMOOTH, ridge: float = RIDGE) -> Model:
    """Train on the labelled rows that ``keep`` selects."""
    spark = docs.sparkSession
    share = labels.where(keep & F.col(label).isNotNull()).agg(F.avg(label)).first()[0] or 0.0
    prior = min(max(share, 1e-4), 1 - 1e-4)
    sample = labelled_sample(labels, label, keep, per_class)
    path = fresh_path(spark, "sample")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = stash(texts.repartition(SAMPLE_TASKS, "doc_id"), "sample", path)
    seen = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = seen.get(1, 0), seen.get(0, 0)
    alone = Model(sizes, float(np.log(prior / (1 - prior))))
    if not n1 or not n0:
        drop_path(spark, path)
        return alone
    counted = texts.select("label", "text").mapInArrow(_count(sizes), "part long, keys binary, one binary, zero binary")
    telling = counted.groupBy("part").applyInArrow(_telling(n1, n0, min_z, smooth), "key long, ratio double").toPandas()
    keys = telling.key.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, ratio = keys[order], telling.ratio.to_numpy()[order]
    rows = texts.select("doc_id", "label", "text").mapInArrow(_present(keys, sizes), "doc_id long, label int, has binary").collect()
    drop_path(spark, path)
    rows.sort(key=lambda r: r.doc_id)
    x = Rows(np.frombuffer(b"".join(r.has for r in rows), np.int32), np.r_[0, np.cumsum([len(r.has) // 4 for r in rows])], ratio)
    weights, intercept = logistic(x, np.array([r.label for r in rows], np.float64), ridge)
    intercept += np.log(prior / (1 - prior)) - np.log(n1 / n0)
    return Model(sizes, float(intercept), keys, weights * ratio)


def _score(model: Model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [i for i in range(b.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(model.scores(b.column(text_at)))], [*(b.schema.names[i] for i in keep), "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    return docs.select("doc_id", "text").mapInArrow(_score(model, 1), docs.select("doc_id").schema.add("score", "double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, unchanged."""
    model = fit(docs, labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT)

    def clean(text: pa.Array) -> pa.Array:
        return pa.array(model.scores(text) < threshold)

    return docs.where(text_verdict(docs, clean))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT)
    return score(docs, model).select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
