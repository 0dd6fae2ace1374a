"""Tracking state over micro-batches.

State lives in tables that a batch reads and writes (``foreachBatch``), or in
Spark's state store where a key's state is small and independent of the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relations import latest


def last_writer(notifications: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest notification of each key. Deletions stay as tombstones, which hold off older upserts."""
    return latest(notifications, [key], [F.col(c).desc() for c in order])


def sensor_registry(state: DataFrame, notifications: DataFrame) -> DataFrame:
    """State and notifications (sensor_id, ts, event, sensor) merged: newest wins, deletes are kept as tombstones.

    Notifications before the last ``upsert-all`` are left out; sensors that an
    ``upsert-all`` does not name stay.
    """
    last = notifications.where("event = 'upsert-all'").agg(F.max("ts").alias("_last"))
    news = notifications.crossJoin(F.broadcast(last)).where("_last is null or ts >= _last").drop("_last")
    both = state.select("sensor_id", "ts", "event", "sensor", F.lit(0).alias("_new")).unionByName(news.select("sensor_id", "ts", "event", "sensor", F.lit(1).alias("_new")))
    # At the same time the state stays.
    return latest(both, ["sensor_id"], [F.col("ts").desc(), F.col("_new")]).drop("_new")


def live_sensors(registry: DataFrame) -> DataFrame:
    return registry.where("event <> 'delete'")


# Behaviors.
SEGMENT = "id string, segment long, ts timestamp, frame_id long, left_x double, top_y double, right_x double, bottom_y double, confidence double, x double, y double, embedding array<double>"


def merge_points(state: DataFrame, batch: DataFrame, gap_seconds: float) -> DataFrame:
    """Append a batch's points (id, ts, ...) to the live segments.

    A segment of the batch joins its id's latest live segment if it begins less
    than the gap after that one's end, else it becomes a new one; late rows join
    the latest as well. Points keep their own rows, so the arrays of a behavior are
    always sorted when they are made.
    """
    from ..operators.tracks import split_by_gap

    ends = state.groupBy("id").agg(F.max_by("segment", "ts").alias("_seg"), F.max("ts").alias("_end"), F.max("segment").alias("_max"))
    b = split_by_gap(batch, gap_seconds, ["id"], tie="frame_id").withColumnRenamed("segment", "_part")
    starts = b.groupBy("id", "_part").agg(F.min("ts").alias("_start"), F.max("ts").alias("_stop")).join(ends, "id", "left")
    joins = F.coalesce(F.unix_micros("_start") < F.unix_micros("_end") + F.lit(int(gap_seconds * 1e6)), F.lit(False))
    named = starts.withColumn("segment", F.when(joins, F.col("_seg")).otherwise(F.coalesce("_max", F.lit(-1)) + 1 + F.col("_part"))).select("id", "_part", "segment")
    return state.unionByName(b.join(named, ["id", "_part"]).drop("_part").select(*state.columns))


def evict(state: DataFrame, retention_sec: float, as_of: Any | None = None) -> tuple[DataFrame, DataFrame]:
    """Live points and the (id, segment) that ended longer ago than the retention, as of a time or the newest end."""
    ends = state.groupBy("id", "segment").agg(F.max("ts").alias("_end"))
    now = ends.agg(F.max("_end").alias("_now")) if as_of is None else ends.sparkSession.range(1).select(F.lit(as_of).cast("timestamp").alias("_now"))
    ended = ends.crossJoin(F.broadcast(now)).where(F.unix_micros("_now") > F.unix_micros("_end") + F.lit(int(retention_sec * 1e6))).select("id", "segment")
    return state.join(ended, ["id", "segment"], "left_anti"), ended


# Continuity of global ids.
def continue_ids(clusters: list[dict[str, Any]], held: dict[str, dict[int, pd.Timestamp]], next_id: int) -> tuple[list[dict[str, Any]], int]:
    """Global ids for a batch's clusters (members: behavior keys), the largest cluster first.

    A cluster takes an id that its members held before and no other cluster of the batch has taken, of
    several the one that began first; otherwise a new one. ``held``: by key the ids with their start.
    """
    used: set[int] = set()
    out = []
    for c in sorted(clusters, key=lambda c: (-len(c["members"]), c["cluster"])):
        known = {g: t for k in c["members"] for g, t in held.get(k, {}).items() if g not in used}
        if known:
            gid = min(known, key=lambda g: (known[g], g))
        else:
            gid, next_id = next_id, next_id + 1
        used.add(gid)
        out.append(c | {"global_id": gid})
    return out, next_id


def prune_objects(objects: DataFrame, live: DataFrame) -> DataFrame:
    """Global objects (with an array of member keys) that still have a live member."""
    keys = objects.select("global_id", F.explode("members").alias("key")).join(live.select("key"), "key", "left_semi").select("global_id").distinct()
    return objects.join(keys, "global_id", "left_semi")


# Frame buffers.
def buffered_batches(timestamps_ms: list[int], size_ms: int, reset_ms: int) -> Iterator[tuple[str, list[int]]]:
    """Flush a buffer when it spans ``size_ms``; drop it when the next frame begins more than ``reset_ms`` after it."""
    buffer: list[int] = []
    for t in timestamps_ms:
        if buffer and t > max(buffer) + reset_ms:
            yield "dropped", buffer
            buffer = []
        buffer.append(t)
        if max(buffer) - min(buffer) >= size_ms:
            yield "flushed", buffer
            buffer = []
    if buffer:
        yield "held", buffer


class TrackletCounter:
    """Per behavior id: running segments, for ``transformWithStateInPandas`` (state: segment, start, end, n)."""

    SCHEMA = "id string, segment long, start_us long, end_us long, n long"

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def fold(self, state: tuple[int, int, int, int] | None, times: list[int]) -> tuple[tuple[int, int, int, int], list[tuple[int, int, int, int]]]:
        """The new state, and the segments that ended. A gap must be passed strictly; late rows join the latest segment."""
        closed = []
        for t in sorted(times):
            if state is None:
                state = (0, t, t, 1)
            elif t - state[2] > self.gap_us:
                closed.append(state)
                state = (state[0] + 1, t, t, 1)
            else:
                state = (state[0], state[1], max(state[2], t), state[3] + 1)
        return state, closed

    def apply(self, key, pdfs, state):
        """For ``applyInPandasWithState`` in update mode: the current segment of each id that had rows, and those that ended."""
        times = [int(t.value // 1000) for pdf in pdfs for t in pdf["ts"]]
        now, closed = self.fold(tuple(state.get) if state.exists else None, times)
        state.update(now)
        rows = [*closed, now]
        yield pd.DataFrame({"id": [key[0]] * len(rows), "segment": [r[0] for r in rows], "start_us": [r[1] for r in rows], "end_us": [r[2] for r in rows], "n": [r[3] for r in rows]})


def stream_tracklets(points: DataFrame, gap_seconds: float) -> DataFrame:
    """Segments of each behavior id over a stream of points (id, ts)."""
    counter = TrackletCounter(int(gap_seconds * 1e6))
    return points.select("id", "ts").groupBy("id").applyInPandasWithState(counter.apply, TrackletCounter.SCHEMA, "segment long, start_us long, end_us long, n long", "update", "NoTimeout")


def windowed_counts(points: DataFrame, width: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Rows of each sensor and window, with a watermark for late rows."""
    return points.withWatermark("ts", late).groupBy("sensor_id", F.window("ts", width).alias("w")).agg(F.count("*").alias("n"))
