"""Joins, windows and set operations that Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def as_of(left: DataFrame, right: DataFrame, keys: list[str], order: str, values: list[str], forward: bool = False) -> DataFrame:
    """For each left row the values of the last right row of its key at or before it (``forward``: the next at or after).

    By union and a running last value: one shuffle by key, no join. Value columns
    must not be columns of the left side. Without keys all rows would meet in
    one task, so at least one is required.
    """
    if not keys or set(values) & set(left.columns):
        raise ValueError("as_of needs a key, and value columns that the left side lacks")
    found = F.struct(*values).alias("_found")
    nothing = F.lit(None).cast(right.select(found).schema["_found"].dataType).alias("_found")
    a = left.select("*", nothing, F.lit(0 if forward else 1).alias("_side"), F.lit(True).alias("_left"))
    b = right.select(*keys, order, found, F.lit(1 if forward else 0).alias("_side"), F.lit(False).alias("_left"))
    by = Window.partitionBy(*keys).orderBy(order, "_side")
    frame = by.rowsBetween(Window.currentRow, Window.unboundedFollowing) if forward else by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pick = (F.first if forward else F.last)("_found", True).over(frame)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_found", pick).where("_left")
    return both.select(*left.columns, *[F.col("_found")[v].alias(v) for v in values])


def next_fill(rows: DataFrame, keys: list[str], order: str, value: str, out: str, bin_of: Column | None = None) -> DataFrame:
    """The next known value at or after each row, as a running last value from the end on.

    With ``bin_of`` (which never falls along the order, nulls first) a key's rows are dealt out by bin; a row that closes
    each bin holds the first known value of the later ones.
    """
    back = lambda *by: Window.partitionBy(*by).orderBy(F.desc("_close"), F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumns({"_value": F.col(value), "_close": F.lit(False)})
    if bin_of is None:
        return own.withColumn(out, F.last("_value", True).over(back(*keys))).drop("_value", "_close")
    own = own.withColumn("_bin", bin_of)
    first = own.groupBy(*keys, "_bin").agg(F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_first"))
    later = F.last("_first", True).over(Window.partitionBy(*keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1))
    closing = first.select(*keys, "_bin", later.alias("_value"), F.lit(True).alias("_close")).where("_value is not null")
    filled = own.unionByName(closing, allowMissingColumns=True).withColumn(out, F.last("_value", True).over(back(*keys, "_bin")))
    return filled.where("not _close").drop("_value", "_close", "_bin")


def stabbing(intervals: DataFrame, key: str, ident: str, start: str, end: str, bin_seconds: int | None = None, points: DataFrame | None = None, joined: str | None = None) -> DataFrame:
    """The sets of intervals of a key that hold at some interval's start or end: (key, at, members sorted).

    With ``bin_seconds`` (for timestamps) a key's intervals are put together by time bin, an interval in every bin that it
    touches, and a bin's points are passed there one by one. So what is shuffled and held grows with the intervals and not
    with the members listed, and a row is no longer than a set may be. ``points`` (key, at) are other points to look at;
    without them a bin reads its points off its intervals. An ident, a text if ``joined`` is given, names one interval; then
    the members are one text with that between them, made where they are looked up, after their number: (key, at, n, members).
    """
    if not bin_seconds:
        if points is None:
            points = intervals.select(key, F.explode(F.array(start, end)).alias("at"))
        found = points.distinct().join(intervals, key).where((F.col("at") >= F.col(start)) & (F.col("at") <= F.col(end))).groupBy(key, "at").agg(F.array_sort(F.collect_set(ident)).alias("members"))
        return found if joined is None else found.select(key, "at", F.size("members").alias("n"), F.array_join("members", joined).alias("members"))
    width = bin_seconds * 1_000_000
    own, s, e = _timed(intervals, key, ident, start, end), F.col("_s"), F.col("_e")
    if points is None:
        # Intervals that never hold still have their ends looked at.
        bins = F.when(s <= e, _bins(width)).otherwise(F.array(_bin(s, width), _bin(e, width)))
        return _listed(own.withColumn("_bin", F.explode(bins)).where("_bin is not null"), intervals, key, ident, intervals.schema[start].dataType, joined, _at_ends(width))
    own = own.where("_s <= _e").withColumns({"_bin": F.explode(_bins(width)), "_point": F.lit(False)})
    at = F.unix_micros(F.col("at").cast("timestamp"))
    looked = points.distinct().select(F.col(key).alias("_key"), at.alias("_s"), at.alias("_e")).where("_key is not null and _s is not null").withColumns({"_bin": _bin(s, width), "_point": F.lit(True)})
    return _listed(own.unionByName(looked, allowMissingColumns=True), intervals, key, ident, points.schema["at"].dataType, joined, _given)


def _timed(intervals: DataFrame, key: str, ident: str, start: str, end: str) -> DataFrame:
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return intervals.select(F.col(key).alias("_key"), F.col(ident).alias("_ident"), micros(start).alias("_s"), micros(end).alias("_e")).where("_key is not null")


def _bin(at: Column, width: int) -> Column:
    """The start of a time's bin, in integers, so that Spark and Arrow agree at its borders."""
    return at - F.pmod(at, F.lit(width))


def _bins(width: int) -> Column:
    s, e = _bin(F.col("_s"), width), _bin(F.col("_e"), width)
    return F.sequence(s, F.greatest(s, e), F.lit(width))


def _listed(rows: DataFrame, intervals: DataFrame, key: str, ident: str, at: DataType, joined: str | None, points_of: Callable) -> DataFrame:
    """``rows`` by key and bin, through :func:`_sets` at what ``points_of`` makes of a table: (its intervals, points)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches))
        yield from _sets(whole["_key"][0], *points_of(whole), joined)

    kinds = {f.name: f.dataType.simpleString() for f in intervals.select(key, ident).schema.fields}
    members = f"members array<{kinds[ident]}>" if joined is None else "n int, members string"
    found = rows.groupBy("_key", "_bin").applyInArrow(sets, f"_key {kinds[key]}, _at long, {members}")
    return found.select(F.col("_key").alias(key), F.timestamp_micros("_at").cast(at).alias("at"), *found.columns[2:])


#: Members in a batch of rows that :func:`stabbing` returns; a longer set is a batch of its own.
MEMBERS = 262_144


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The points of one key and bin with the sorted idents of the intervals that hold there."""
    whole = pa.Table.from_batches(list(batches))
    yield from _sets(whole["_key"][0], *_given(whole))


def _given(whole: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The points of one key and bin that are rows beside its intervals."""
    is_point = whole["_point"].to_numpy()
    return whole.filter(pa.array(~is_point)), whole["_s"].to_numpy()[is_point]


def _at_ends(width: int) -> Callable:
    """The starts and ends that lie in one key's bin."""

    def points_of(whole: pa.Table) -> tuple[pa.Table, np.ndarray]:
        opened, at = whole["_bin"][0].as_py(), np.concatenate([whole[c].drop_null().to_numpy() for c in ("_s", "_e")])
        return whole.filter(pc.less_equal(whole["_s"], whole["_e"])), at[(at >= opened) & (at < opened + width)]

    return points_of


def _at_peaks(whole: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The starts in one key's bin that an end follows before another start.

    A row without an end has the key's first start after the bin. Of what ends at or after a start but does not hold there,
    the start comes first, so the bin's own intervals are enough.
    """
    own, later = whole.filter(whole["_e"].is_valid()), whole.filter(whole["_e"].is_null())["_s"].to_numpy()
    s, e = np.unique(own["_s"].to_numpy()), np.unique(own["_e"].to_numpy())
    s = s[s >= whole["_bin"][0].as_py()]
    next_start = np.append(s[1:], later if len(later) else np.iinfo(np.int64).max)[: len(s)]
    return own, s[e[np.searchsorted(e, s)] < next_start]


def _sets(key: pa.Scalar, own: pa.Table, points: np.ndarray, joined: str | None = None) -> Iterator[pa.RecordBatch]:
    """The points in order, each with the sorted idents that hold there, a few rows at a time.

    From one point to the next only what starts or ends between them changes.
    """
    own = own.filter(own["_ident"].is_valid())
    if not len(own):
        return
    own = own.sort_by("_ident").combine_chunks()
    idents, s, e = own["_ident"].combine_chunks(), own["_s"].to_numpy(), own["_e"].to_numpy()
    points, by_start, by_end = np.unique(points), np.argsort(s, kind="stable"), np.argsort(e, kind="stable")
    started, ended = np.searchsorted(s[by_start], points, "right"), np.searchsorted(e[by_end], points, "left")
    holds, ready, held = np.zeros(len(own), bool), [], 0

    def batch(ready: list) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(k) for _, k in ready])]).astype(np.int32)
        members = pa.ListArray.from_arrays(pa.array(offsets), idents.take(pa.array(np.concatenate([k for _, k in ready]))))
        columns = [pa.array([key.as_py()] * len(ready), key.type), pa.array([t for t, _ in ready], pa.int64())]
        if joined is None:
            return pa.RecordBatch.from_arrays([*columns, members], ["_key", "_at", "members"])
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(offsets)), pc.binary_join(members, joined)], ["_key", "_at", "n", "members"])

    i = j = 0
    for t, to, gone in zip(points.tolist(), started.tolist(), ended.tolist(), strict=True):
        holds[by_start[i:to]] = True
        holds[by_end[j:gone]] = False
        i, j, k = to, gone, np.flatnonzero(holds)
        if not len(k):
            continue
        if ready and held + len(k) > MEMBERS:
            yield batch(ready)
            ready, held = [], 0
        ready.append((t, k))
        held += len(k)
    if ready:
        yield batch(ready)


def maximal_stabbing(intervals: DataFrame, key: str, ident: str, start: str, end: str, bin_seconds: int | None = None, joined: str | None = None) -> DataFrame:
    """The sets of :func:`stabbing` that are not part of another one, each once: (key, at, members sorted), or as it joins them.

    They hold at the starts that an end follows before another start: until that end no interval is lost
    and at the next start one is gone. So sets are never compared. With ``bin_seconds`` each bin finds its own such starts,
    and only the first start of each bin is passed on, to the bin before.
    """
    holding = intervals.where(F.col(start) <= F.col(end))
    if bin_seconds:
        width = bin_seconds * 1_000_000
        own = _timed(holding, key, ident, start, end)
        first = own.groupBy("_key", _bin(F.col("_s"), width).alias("_bin")).agg(F.min("_s").alias("_first"))
        later = first.select("_key", "_bin", F.lead("_first").over(Window.partitionBy("_key").orderBy("_bin")).alias("_s")).where("_s is not null")
        rows = own.withColumn("_bin", F.explode(_bins(width))).unionByName(later, allowMissingColumns=True)
        return _listed(rows, intervals, key, ident, intervals.schema[start].dataType, joined, _at_peaks)
    ends = holding.select(key, F.col(start).alias("at"), F.lit(0).alias("_end")).unionByName(holding.select(key, F.col(end).alias("at"), F.lit(1).alias("_end")))
    next_end = F.lead("_end").over(Window.partitionBy(key).orderBy("at", "_end"))
    peaks = ends.withColumn("_next", next_end).where("_end = 0 and _next = 1").select(key, "at")
    return stabbing(intervals, key, ident, start, end, points=peaks, joined=joined)


def largest_stabbing(intervals: DataFrame, key: str, start: str, end: str, bin_seconds: int) -> DataFrame:
    """The most intervals of a key that hold at one time: (key, k), as the largest set of :func:`stabbing` is.

    A running count of starts less earlier ends; no set is made. A key's times are dealt out by bin, each
    opened by what the earlier bins leave.
    """
    own = intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    ends = own.select(key, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("s"), F.lit(0).alias("e")), F.struct(F.col(end).alias("at"), F.lit(0).alias("s"), F.lit(1).alias("e")))).alias("_t"))
    times = ends.groupBy(key, F.col("_t.at").alias("_at")).agg(F.sum("_t.s").alias("_starts"), F.sum("_t.e").alias("_ends"))
    times = times.withColumns({"_bin": F.floor(F.unix_seconds(F.col("_at").cast("timestamp")) / bin_seconds), "_change": F.col("_starts") - F.col("_ends")})
    left = F.sum("_change").over(Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    opening = times.groupBy(key, "_bin").agg(F.sum("_change").alias("_change")).select(key, "_bin", left.alias("_change"), F.lit(0).alias("_ends"))
    by = Window.partitionBy(key, "_bin").orderBy(F.col("_at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holding = times.unionByName(opening, allowMissingColumns=True).select(key, (F.sum("_change").over(by) + F.col("_ends")).alias("_k"))
    return holding.groupBy(key).agg(F.max("_k").cast("int").alias("k"))


def maximal_sets(sets: DataFrame, key: str, members: str) -> DataFrame:
    """Distinct sets of a key that are not part of another one.

    A larger set that holds a set holds that set's first member too, so sets meet only by member.
    """
    s = sets.select(key, members).distinct().withColumn("_n", F.size(members))
    big = s.select(F.col(key).alias("_k"), F.col(members).alias("_m"), F.col("_n").alias("_big"), F.explode(members).alias("_one"))
    inside = (F.col(key) == F.col("_k")) & (F.col(members)[0] == F.col("_one")) & (F.col("_big") > F.col("_n")) & (F.size(F.array_except(members, "_m")) == 0)
    return s.join(big, inside, "left_anti").drop("_n")


def covering_pairs(groups: DataFrame, intervals: DataFrame, place: str, sensor: str, start: str, end: str, group_start: str, group_end: str, bin_seconds: int) -> DataFrame:
    """Intervals of other sensors of a place that contain a group's window; time bins are the equi key beside the place.

    An interval is put in every bin that it touches, a group in the bin of its start, so each pair meets once.
    """
    bin_of = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bin_seconds)
    g = groups.withColumn("_bin", bin_of(group_start))
    i = intervals.withColumn("_bin", F.explode(F.sequence(bin_of(start), bin_of(end))))
    i = i.withColumnsRenamed({c: f"other_{c}" for c in i.columns if c not in ("_bin", place)})
    inside = (F.col(f"other_{sensor}") != F.col(sensor)) & (F.col(f"other_{start}") <= F.col(group_start)) & (F.col(f"other_{end}") >= F.col(group_end))
    return g.join(i, [place, "_bin"]).where(inside).drop("_bin")


def covering_counts(intervals: DataFrame, ident: str, place: str, sensor: str, start: str, end: str, bin_seconds: int) -> DataFrame:
    """How many of :func:`covering_pairs` each interval has against the same table, without those that have none: (ident, covering).

    No pair is made. Of the intervals that cover one, some start in its start's time bin (counted by place and that
    bin), others start in an earlier bin and end in its end's bin (by place and that bin), and the rest start in an
    earlier bin and end in a later one (a sum over bins, by place).
    """
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    named = intervals.select(F.col(ident).alias("_ident"), F.col(place).alias("_place"), F.col(sensor).alias("_sensor"), at(start).alias("_s"), at(end).alias("_e"))
    rows = named.dropna(subset=["_place", "_sensor", "_s", "_e"]).withColumns({"_i": F.floor(F.col("_s") / (bin_seconds * 1_000_000)), "_j": F.floor(F.col("_e") / (bin_seconds * 1_000_000))})
    part = lambda kind, bin_, x, below: F.struct(F.lit(kind).alias("kind"), bin_.alias("bin"), x.alias("x"), below.alias("below"))
    i, j, s = F.col("_i"), F.col("_j"), F.col("_s")
    near = rows.select("_ident", "_place", "_sensor", "_e", F.explode(F.array(part("start", i, s, s), part("end", j, i, i - 1))).alias("_part")).select("_ident", "_place", "_sensor", "_e", "_part.*")

    def count(pdf: pd.DataFrame, x: str, y: str, below: np.ndarray, above: np.ndarray, weight: np.ndarray) -> np.ndarray:
        of = lambda k: dominating(pdf[x].to_numpy()[k], pdf[y].to_numpy()[k], weight[k], below[k], above[k])
        n = of(np.arange(len(pdf)))
        for own in pdf.groupby("_sensor").indices.values():
            n[own] -= of(own)
        return n

    def by_bin(pdf: pd.DataFrame) -> pd.DataFrame:
        n = count(pdf, "x", "_e", pdf["below"].to_numpy(), pdf["_e"].to_numpy(), np.ones(len(pdf), np.int64))
        return pd.DataFrame({"_ident": pdf["_ident"], "covering": n})[n > 0]

    def over_bins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        n = count(pdf, "_i", "_j", pdf["_i"].to_numpy() - 1, pdf["_j"].to_numpy() + 1, pdf["_w"].to_numpy())
        return pdf[["_place", "_sensor", "_i", "_j"]].assign(covering=n)[n > 0]

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    found = near.groupBy("_place", "kind", "bin").applyInPandas(by_bin, f"_ident {kind['_ident']}, covering long")
    cells = rows.groupBy("_place", "_sensor", "_i", "_j").agg(F.count("*").alias("_w")).groupBy("_place").applyInPandas(over_bins, f"_place {kind['_place']}, _sensor {kind['_sensor']}, _i long, _j long, covering long")
    far = rows.join(cells, ["_place", "_sensor", "_i", "_j"]).select("_ident", "covering")
    return found.unionByName(far).groupBy(F.col("_ident").alias(ident)).agg(F.sum("covering").alias("covering"))


def dominating(x: np.ndarray, y: np.ndarray, weight: np.ndarray, below: np.ndarray, above: np.ndarray) -> np.ndarray:
    """For each k the weight of all points with x <= below[k] and y >= above[k].

    Points and bounds are put in order of x; at each level of a merge sort the bounds of a right half take the points of its left
    half that come before them in order of y.
    """
    n = len(x)
    bound = np.repeat([0, 1], n)
    by_x = np.lexsort((bound, np.concatenate([x, below])))
    at = np.empty(2 * n, np.int64)
    at[by_x] = np.arange(2 * n)
    w = np.concatenate([weight, np.zeros(n, np.int64)])
    order = np.lexsort((bound, -np.concatenate([y, above])))
    total = np.zeros(2 * n, np.int64)
    for level in reversed(range((2 * n - 1).bit_length())):
        half = at[order] >> level & 1
        before = np.concatenate([[0], np.cumsum(np.where(half == 0, w[order], 0))])
        block = at[order] >> (level + 1)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        opened = np.repeat(before[first], np.diff(np.append(first, 2 * n)))
        right = half == 1
        total[order[right]] += (before[:-1] - opened)[right]
        order = order[np.argsort(at[order] >> level, kind="stable")]
    return total[n:]


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def positional_zip(left: DataFrame, right: DataFrame, left_on: str, right_on: str, left_out: str, right_out: str) -> DataFrame:
    """Pair two small dimension tables by rank; ids without digits are left out on the right."""
    a = left.select(F.col(left_on).alias(left_out)).distinct().withColumn("position", F.row_number().over(Window.orderBy(left_out)))
    b = right.select(F.col(right_on).alias(right_out)).distinct().where(F.col(right_out).cast("string").rlike(r"\d"))
    return a.join(b.withColumn("position", F.row_number().over(Window.orderBy(right_out))), "position")


def overlap_counts(a: DataFrame, b: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """How many keys each left set shares with each right set."""
    return a.select(key, left).distinct().join(b.select(key, right).distinct(), key).groupBy(left, right).agg(F.count("*").alias("shared"))


def first_and_last(rows: DataFrame, keys: list[str], order: list[str], kept: int) -> DataFrame:
    """Of each key the first half (rounded down) and the last half (rounded up) of ``kept`` rows, in order."""
    by = Window.partitionBy(*keys)
    d = rows.withColumns({"_rn": F.row_number().over(by.orderBy(*order)), "_n": F.count("*").over(by)})
    return d.where((F.col("_rn") <= kept // 2) | (F.col("_rn") > F.col("_n") - (kept - kept // 2))).drop("_rn", "_n")


def frame_offsets(rows: DataFrame, sequence: str, frame: str) -> DataFrame:
    """For each sequence the sum of the earlier sequences' last frames (a row for each sequence)."""
    last = rows.groupBy(sequence).agg(F.max(frame).alias("last_frame"))
    by = Window.orderBy(sequence).rowsBetween(Window.unboundedPreceding, -1)
    return last.withColumn("offset", F.coalesce(F.sum("last_frame").over(by), F.lit(0)))


def mode_vote(votes: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key, the smallest of several."""
    n = votes.groupBy(key, value).agg(F.count("*").alias("votes"))
    return latest(n, [key], [F.col("votes").desc(), F.col(value)])
