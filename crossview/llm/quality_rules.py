"""Quality rules whose cutoffs carry a guarantee on false rejections.

One scan, without a shuffle, turns every whole text into its counts and six
rule values. A rule rejects a document whose value lies above the rule's
cutoff. Cutoffs are chosen for each stratum (language) by labelled holdouts:
for a rule and a stratum the cutoffs of a fixed grid are tested from the laxest
to the strictest, each by the exact binomial tail: a cutoff is certified if so
few good documents lie above it that a true rate over ``alpha / rules`` would
show so few with a probability of at most ``delta / (rules * strata)`` only.
Testing stops at the first cutoff that fails (a fixed sequence needs no further
correction), and rules and strata share ``delta`` (Bonferroni). So with
probability ``1 - delta`` over the holdouts, in every stratum at most ``alpha``
of the good documents are rejected by the rules. Among certified cutoffs the
one is used that rejects most bad documents less ``good_weight`` times the
good ones; ties go to the laxest. A stratum with too few holdouts certifies
nothing and rejects nothing.

The labels count through histograms over the grid, taken from all labelled
documents. Each stratum's histograms (612 numbers at most) are judged by a task;
the table of cutoffs, which has only strata with hundreds of holdouts, is
broadcast up to ``MAX_STRATA`` rows and joined by shuffle beyond.

Defined results: a null text counts as empty; a document without words has
zero in every rule value; a null stratum is a stratum of its own; an id
labelled more than once takes its smallest label; repeated rows are judged one
by one; without labels nothing is rejected but by the base rule; an empty table
gives no rows; other columns of the documents are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .common import fresh_path, stash, table

ALPHA, DELTA, GOOD_WEIGHT = 0.06, 0.05, 10.0
#: Rows of the table of cutoffs that are broadcast.
MAX_STRATA = 100_000
#: Rule values run from 0 to 1; a cutoff is GRID[k], the laxest rejects nothing.
GRID = [round(1 - k / 50, 2) for k in range(51)]
RULES = ("symbols", "capitals", "bare_words", "stutter", "shouting", "repeated_lines")

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WINDOW = 8
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _keys(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One key for a hash within a text."""
    return tb.mix(h + doc.astype(tb.U64) * tb.U64(0xA0761D6478BD642F))


def _repeated(doc: np.ndarray, h: np.ndarray, later: bool) -> np.ndarray:
    """Positions whose hash occurs twice or more in their text; ``later``: all but the first of each."""
    if not len(h):
        return np.empty(0, np.int64)
    order = np.argsort(key := _keys(doc, h), kind="stable")
    same = key[order][1:] == key[order][:-1]
    mask = np.r_[False, same]
    if not later:
        mask[:-1] |= same
    return np.sort(order[mask])


def measure(t: tb.Texts) -> dict[str, np.ndarray]:
    """Counts and rule values of every text of a block."""
    w = tb.words(t, tb.SPACED)
    acc = tb.prefix(t.data)
    h, doc, n = tb.span_hash(acc, w.start, w.end), w.doc, w.counts
    inside, lead = tb.SPACED[t.data], (t.data & 0xC0) != 0x80
    lines = np.unique(np.r_[t.offs[:-1], np.flatnonzero(t.data == 10) + 1])
    starts = lines[lines < len(t.data)] if len(t.data) else lines[:0]
    ends = np.r_[starts[1:], len(t.data)] if len(starts) else starts
    bare = t.data[ends - 1] == 10 if len(starts) else np.empty(0, bool)
    own = np.searchsorted(t.offs, starts, "right") - 1
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends, own = starts[has_word], (ends - bare)[has_word], own[has_word]
    dup = _repeated(own, tb.span_hash(acc, starts, ends), later=True)
    wh, at = tb.windows(h, w, _WINDOW)
    twice = at[_repeated(doc[at], wh, later=False)]
    edge = np.zeros(len(h) + 1, np.int32)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + _WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    upper = (t.data >= 65) & (t.data <= 90)
    letters = _per_text(upper | ((t.data >= 97) & (t.data <= 122)), t.offs)
    alnum = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(tb.ALNUM[t.data], out=alnum[1:])
    bare_word = alnum[w.end] == alnum[w.start]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    count = lambda mask: np.bincount(doc[mask], minlength=t.n)
    rate = lambda x, y: np.clip(x / np.maximum(y, 1), 0, 1)
    out = {
        "n_words": n,
        "word_chars": _per_text(inside & lead, t.offs),
        "n_symbols": _per_text(_SYMBOLS[t.data], t.offs),
        "n_dup_lines": np.bincount(own[dup], minlength=t.n),
        "n_repeat_words": count(covered),
    }
    return out | {
        "symbols": rate(out["n_symbols"], 3 * n),
        "capitals": rate(_per_text(upper, t.offs), letters),
        "bare_words": rate(count(bare_word), n),
        "stutter": rate(count(again), n),
        "shouting": rate(_per_text(t.data == 33, t.offs), 2 * n),
        "repeated_lines": rate(out["n_dup_lines"], np.bincount(own, minlength=t.n)),
    }


def _scan(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [measure(t) for t in tb.blocks(b.column(text_at))]
            join = lambda k: np.concatenate([p[k] for p in parts]) if parts else np.empty(0)
            values = [pa.array(join(k).astype(np.int64)) for k in _BASE] + [pa.array(join(k).astype(np.float64)) for k in RULES]
            keep = [i for i in range(b.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *values], [*(b.schema.names[i] for i in keep), *_BASE, *RULES])

    return run


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and lang of ``docs`` with their counts and rule values."""
    docs = docs.select("doc_id", "lang", "text")
    fields = [*docs.schema.fields[:2], *(T.StructField(c, T.LongType()) for c in _BASE), *(T.StructField(c, T.DoubleType()) for c in RULES)]
    return docs.mapInArrow(_scan(2), T.StructType(fields))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X, summed exactly."""
    if k >= n:
        return 1.0
    base = math.lgamma(n + 1) + n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)
    return min(1.0, math.fsum(math.exp(base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * odds) for i in range(k + 1)))


def certified(above: list[int], n: int, alpha: float, level: float) -> int:
    """How many cutoffs, from the laxest on, are certified; ``above``: good documents above each."""
    for i, k in enumerate(above):
        if n == 0 or (k / n > alpha) or binomial_tail(k, n, alpha) > level:
            return i
    return len(above)


def chosen_cutoffs(counts: dict[tuple[str, int], list[int]], strata: int, alpha: float, delta: float, good_weight: float) -> list[dict]:
    """A stratum's cutoff for each rule; ``counts`` by rule and label: documents in each cell of the grid."""
    out = []
    for rule in RULES:
        good, bad = (counts.get((rule, k), [0] * len(GRID)) for k in (1, 0))
        # A value in cell c (just at or below c / 50) lies above GRID[i] = 1 - i / 50 if c > 50 - i.
        over = lambda cells: [sum(cells[len(GRID) - i :]) for i in range(len(GRID))]
        n, a, b = sum(good), over(good), over(bad)
        ok = certified(a, n, alpha / len(RULES), delta / (len(RULES) * strata))
        best = max(range(ok), key=lambda i: (b[i] - good_weight * a[i], -i), default=0)
        out.append({"rule": rule, "cutoff": GRID[best] if ok else 1.0, "holdouts": n, "good_above": a[best] if ok else 0, "bad_above": b[best] if ok else 0, "certified": ok})
    return out


_CUTOFFS = "lang string, rule string, cutoff double, holdouts long, good_above long, bad_above long, certified int"


def cutoffs(values: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, good_weight: float = GOOD_WEIGHT) -> DataFrame:
    """A row for each stratum and rule: the cutoff used, the holdouts, and what lies above it."""
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.ceil(F.col(r) * (len(GRID) - 1)).cast("int").alias("cell")) for r in RULES])).alias("c")
    label = (F.col("quality") == 1).cast("int").alias("label")
    rows = values.join(own, "doc_id").select("lang", label, cells).groupBy("lang", "label", "c.rule", "c.cell").agg(F.count("*").alias("n"))
    path = fresh_path(values.sparkSession, "histograms")
    rows = stash(rows, "histograms", path)
    strata = rows.select("lang").distinct().count()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        counts: dict[tuple[str, int], list[int]] = {}
        for r in pdf.itertuples():
            counts.setdefault((r.rule, r.label), [0] * len(GRID))[r.cell] += r.n
        out = pd.DataFrame(chosen_cutoffs(counts, strata, alpha, delta, good_weight))
        out.insert(0, "lang", pdf.lang.iloc[0])
        return out

    return rows.groupBy("lang").applyInPandas(run, _CUTOFFS)


def judged(values: DataFrame, chosen: DataFrame) -> DataFrame:
    """``values`` with base_failed, rejected_by (the rules whose cutoff a document exceeds) and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    steps = len(GRID) - 1
    limits = chosen.where("cutoff < 1").groupBy(F.col("lang").alias("_lang")).agg(*[F.max(F.when(F.col("rule") == r, F.round(F.col("cutoff") * steps))).alias(f"_{r}") for r in RULES])
    path = fresh_path(values.sparkSession, "cutoffs")
    limits = stash(limits, "cutoffs", path)
    if limits.count() <= MAX_STRATA:
        limits = F.broadcast(limits)
    hits = [F.when(F.ceil(F.col(r) * steps) > F.col(f"_{r}"), F.lit(r)) for r in RULES]
    return (
        values.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .withColumn("base_failed", failed)
        .withColumn("rejected_by", F.array_compact(F.array(*hits)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .select(*values.columns, "base_failed", "rejected_by", "kept")
    )


def filter_quality(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every document's counts, rule values and verdict."""
    values = stash(measured(docs), "rules")
    return judged(values, cutoffs(values, labels, alpha, delta))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *_BASE, "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))
