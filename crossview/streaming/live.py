"""Live locations: points of a place in, a row of locations for each batch of frames out.

One tracker for each place holds its live behaviors and its ids. The same tracker
runs over a stream, where it is the place's value in the state store, and over a
whole log, where a task streams through the points of its places in order of
time. Its memory is what the settings let live, not the log.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AppConfig, clock
from ..operators.clustering import Behavior
from . import online as O

#: What a tracker needs of a detection, and what it gives.
POINTS = ["place", "sensor_id", "object_id", "object_type", "ts", "frame_id", "confidence", "area", "aspect", "frame_width", "frame_height", "x", "y", "weight", "embedding"]
ROW = "place string, timestamp timestamp, frameId string, objectCounts array<struct<type:string,count:int>>, locationsOfObjects array<struct<id:string,type:string,locations:array<array<double>>,matchedBehaviorKeys:array<string>>>"


def live_points(flagged: DataFrame) -> DataFrame:
    """Points of detections with flags: a place on the ground and its weight if it is valid, the vector if that is."""
    placed = F.col("location_valid") & F.col("location").isNotNull()
    known = F.col("frame_width").isNotNull() & F.col("frame_height").isNotNull()
    weight = F.when(known, F.col("area") / (F.col("frame_width") * F.col("frame_height"))).otherwise(F.lit(1.0)) / F.col("aspect")
    return flagged.where("in_roi").select(
        *POINTS[:11], F.when(placed, F.col("location.x")).alias("x"), F.when(placed, F.col("location.y")).alias("y"), F.when(placed, weight).alias("weight"), F.when(F.col("embedding_valid"), F.col("embedding")).alias("embedding")
    )


@dataclass
class Track:
    """A live behavior's steps."""

    key: str
    sensor: str
    object_id: str
    object_type: str
    steps: list[tuple] = field(default_factory=list)
    """(time, frame, confidence, area, aspect, whole frame or None, x or None, y, weight) in order of time."""
    total: np.ndarray | None = None

    @property
    def end(self) -> int:
        return self.steps[-1][0]


class PlaceTracker:
    """A place's live behaviors, its buffer of frames and its ids."""

    def __init__(self, config: AppConfig):
        self.config, self.state = config, O.PlaceState()
        self.tracks: dict[tuple[str, str], list[Track]] = {}
        self.buffer: list[tuple] = []
        #: Whether the last batch clustered anew, which takes long; the next rows to come may then be more than can be kept up with.
        self.fresh = False

    def feed(self, rows: list[tuple], shed: bool = False) -> Iterator[dict]:
        """Rows (in the order of :data:`POINTS` but for the place, times in microseconds), sorted by time, and the locations that they lead to.

        Frames gather until they span a batch; a gap longer than the reset drops what has gathered. With ``shed``, if the
        batch before clustered anew, only the first and the last of the batches that have come since are worked on.
        """
        s = self.config.streaming
        batches: list[list[tuple]] = []
        for r in rows:
            if self.buffer and r[3] > self.buffer[-1][3] + s.mtmcPlusFrameBufferResetSec * 1e6:
                self.buffer = []
            if self.buffer and r[3] != self.buffer[-1][3] and self.buffer[-1][3] - self.buffer[0][3] >= s.mtmcPlusFrameBatchSizeMs * 1000:
                batches.append(self.buffer)
                self.buffer = []
            self.buffer.append(r)
        kept = s.mtmcPlusBehaviorBatchesConsumed
        if shed and self.fresh and len(batches) > kept:
            batches = batches[: kept // 2] + batches[len(batches) - (kept - kept // 2) :]
        for own in batches:
            yield from self._work(own)

    def flush(self) -> Iterator[dict]:
        rows, self.buffer = self.buffer, []
        if rows:
            yield from self._work(rows)

    def _work(self, rows: list[tuple]) -> Iterator[dict]:
        for r in rows:
            self._append(r)
        self._evict(max(r[3] for r in rows))
        live = self.live()
        if live:
            self.fresh = O.needs_init(self.state, live, self.config)
            if out := O.step(self.state, live, self.config):
                yield out

    def _append(self, r: tuple) -> None:
        sensor, object_id, kind, at, frame, confidence, area, aspect, width, height, x, y, weight, vector = r
        own = self.tracks.setdefault((sensor, object_id), [])
        if not own or at - own[-1].end > self.config.preprocessing.behaviorSplitThreshSec * 1e6:
            start = pd.Timestamp(at, unit="us").strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
            own.append(Track(f"{sensor} #-# {object_id} #-# {start}", sensor, object_id, kind))
        t = own[-1]
        if t.object_type != kind:
            raise ValueError(f"{t.key} has objects of two types: {t.object_type} and {kind}")
        t.steps.append((at, frame, confidence, area, aspect, width * height if width and height else None, x, y, weight))
        if len(t.steps) > 1 and t.steps[-2][0] > at:
            t.steps.sort(key=lambda s: s[0])
        if vector is not None:
            t.total = np.asarray(vector, float) if t.total is None else t.total + np.asarray(vector, float)

    def _evict(self, now: int) -> None:
        at = clock(self.config)
        now = now if at is None else int(at.timestamp() * 1e6)
        oldest = now - self.config.preprocessing.behaviorRetentionInStateSec * 1e6
        for k in list(self.tracks):
            self.tracks[k] = [t for t in self.tracks[k] if t.end >= oldest]
            if not self.tracks[k]:
                del self.tracks[k]

    def live(self) -> list[Behavior]:
        """The live behaviors that pass the filters, cut at the newest step less the delay."""
        p = self.config.preprocessing
        tracks = [t for own in self.tracks.values() for t in own]
        limit = max((t.end for t in tracks), default=0) - self.config.streaming.mtmcPlusTimestampDelayMs * 1000
        out = []
        for t in tracks:
            steps = [s for s in t.steps if s[0] <= limit]
            if self.config.quirks == "faithful" and t.end >= limit:  # only the last step goes, or all of a track that ends at the limit
                steps = t.steps[:-1] if t.end > limit else []
            if not steps or t.total is None or not np.linalg.norm(t.total):
                continue
            if len(steps) > p.behaviorNumLocationsMax:
                steps = steps[:: 2 ** int(np.ceil(np.log2(len(steps) / p.behaviorNumLocationsMax)))]
            sure = [s[2] for s in steps if s[2] is not None and s[2] >= 0]
            whole = max((s[5] for s in steps if s[5]), default=None)
            if not sure or np.mean(sure) < p.behaviorConfidenceThresh or np.mean([s[4] for s in steps]) >= p.behaviorBboxAspectRatioThresh:
                continue
            if whole and np.mean([s[3] for s in steps]) <= whole * p.behaviorBboxAreaThresh:
                continue
            long = steps[-1][0] - steps[0][0] >= p.behaviorLengthThreshSec * 1e6
            finished = p.shortBehaviorFinishThreshSec is not None and limit >= steps[-1][0] + p.shortBehaviorFinishThreshSec * 1e6
            if not long and not finished:
                continue
            at = [s for s in steps if s[6] is not None]
            out.append(
                Behavior(
                    t.key, t.sensor, t.object_id, steps[0][0], steps[-1][0], t.total / np.linalg.norm(t.total), np.array([s[0] for s in at], np.int64), np.array([[s[6], s[7]] for s in at], float).reshape(-1, 2),
                    np.array([s[8] for s in at], float), t.object_type, int(steps[-1][1] or 0),
                )
            )
        return out


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf.sort_values(["ts", "frame_id", "sensor_id", "object_id"], kind="stable")
    none = lambda v: None if v is None or (isinstance(v, float) and np.isnan(v)) or v is pd.NA else v
    at = pdf.ts.astype("datetime64[us]").astype("int64")
    return [
        (r.sensor_id, str(r.object_id), r.object_type, int(t), none(r.frame_id), none(r.confidence), r.area, r.aspect, none(r.frame_width), none(r.frame_height), none(r.x), none(r.y), none(r.weight), none(r.embedding))
        for r, t in zip(pdf.itertuples(), at, strict=True)
    ]


def _made(place: str, rows: Iterator[dict], send_empty: bool) -> Iterator[pd.DataFrame]:
    """A frame of the rows, if there are any."""
    rows = [r for r in rows if send_empty or r["objects"]]
    if not rows:
        return
    yield pd.DataFrame(
        {
            "place": [place] * len(rows),
            "timestamp": pd.to_datetime([r["timestamp_us"] for r in rows], unit="us"),
            "frameId": [str(r["frame_id"]) for r in rows],
            "objectCounts": [[{"type": t, "count": n} for t, n in r["counts"].items()] for r in rows],
            "locationsOfObjects": [[{"id": str(g), "type": o["type"], "locations": [list(o["at"])], "matchedBehaviorKeys": o["keys"]} for g, o in r["objects"].items()] for r in rows],
        }
    )


def stream_locations(points: DataFrame, config: AppConfig) -> DataFrame:
    """Rows of locations from a stream of points; each place's tracker is its value in the state store."""
    empty = config.streaming.sendEmptyMtmcPlusMessages

    def apply(key, pdfs, state):
        tracker = pickle.loads(state.get[0]) if state.exists else PlaceTracker(config)
        found = list(tracker.feed(_rows(pd.concat(list(pdfs), ignore_index=True)), shed=True))
        state.update((pickle.dumps(tracker),))
        yield from _made(key[0], found, empty)

    return points.select(*POINTS).groupBy("place").applyInPandasWithState(apply, ROW, "tracker binary", "append", "NoTimeout")


def replay_locations(points: DataFrame, config: AppConfig) -> DataFrame:
    """Rows of locations of a whole log. A task streams through its places; what is left in a buffer at the end counts as a batch."""
    empty = config.streaming.sendEmptyMtmcPlusMessages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, tracker = None, None
        for pdf in batches:
            for name, own in pdf.groupby("place", sort=False):
                if tracker is None or name != place:
                    if tracker is not None:
                        yield from _made(place, tracker.flush(), empty)
                    place, tracker = name, PlaceTracker(config)
                yield from _made(place, tracker.feed(_rows(own)), empty)
        if tracker is not None:
            yield from _made(place, tracker.flush(), empty)

    rows = points.select(*POINTS).repartition("place").sortWithinPartitions("place", "ts", "frame_id", "sensor_id", "object_id")
    return rows.mapInPandas(run, ROW)


def location_rows(points: DataFrame, matched: DataFrame, window_sec: float) -> DataFrame:
    """The newest row of each place as a table: (place, timestamp_us, frame_id, global_id, object_type, x, y, members).

    ``matched``: sensor_id, object_id, global_id, start, end. A point counts if it lies in the window before its place's
    newest end, and within the time of its matched behavior; points are weighted as :func:`live_points` does.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    newest = points.groupBy("place").agg(F.max(micros("ts")).alias("timestamp_us"), F.max("frame_id").alias("frame_id"))
    d = points.drop("frame_id").where("weight is not null").join(newest, "place").where(micros("ts") > F.col("timestamp_us") - int(window_sec * 1e6))
    d = d.join(matched, ["sensor_id", "object_id"]).where((micros("ts") >= micros("start")) & (micros("ts") <= micros("end")))
    mean = lambda c: (F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c)
    return d.groupBy("place", "timestamp_us", "frame_id", "global_id", "object_type").agg(mean("x"), mean("y"), F.countDistinct("sensor_id", "object_id").alias("members"))


def object_counts(rows: DataFrame) -> DataFrame:
    """How many confirmed ids of each type a place has."""
    return rows.where("global_id >= 0").groupBy("place", "object_type").agg(F.count("*").alias("n"))


def assigned_ratio(points: DataFrame, matched: DataFrame) -> DataFrame:
    """The share of each place's (sensor, object) that belong to a confirmed id."""
    own = points.select("place", "sensor_id", "object_id").distinct()
    held = matched.where("global_id >= 0").select("sensor_id", "object_id", F.lit(1).alias("_held")).distinct()
    return own.join(held, ["sensor_id", "object_id"], "left").groupBy("place").agg((F.count("_held") / F.count("*")).alias("ratio"))
