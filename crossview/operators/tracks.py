"""Detections to tracklets, as DataFrame operations over a row for each detection.

Order of the steps: validity flags, gap split, region trim, embedding sum, keys,
downsampling, filters, normalisation. All windows are by tracklet, so one
shuffle by (sensor, object) serves the split, the trim and the sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AppConfig, PreprocessingConfig
from ..functions import columns as C

TRACK = ["sensor_id", "object_id"]


def split_by_gap(points: DataFrame, gap_seconds: float, keys: list[str] = TRACK, ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Number the segments of each key: a new one begins where more than the gap has passed (strictly)."""
    order = [ts] if tie is None else [ts, tie]
    by = Window.partitionBy(*keys).orderBy(*order)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    new = F.coalesce(micros - F.lag(micros).over(by) > F.lit(int(gap_seconds * 1_000_000)), F.lit(False))
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.withColumn("_new", new.cast("int")).withColumn("segment", F.sum("_new").over(running).cast("long")).drop("_new")


#: Detections that a task of :func:`spans` looks through together.
MERGED = 524_288


def spans(points: DataFrame, gap_seconds: float, keys: list[str] = TRACK, ts: str = "ts") -> DataFrame:
    """Start and end of the segments of :func:`split_by_gap`: (keys, segment, s, e); those without any time are left out.

    Detections of a key that no more than the gap parts are of one segment whatever lies between them, so each task merges
    its own before the shuffle, and runs are shuffled instead of detections.
    """
    gap = int(gap_seconds * 1_000_000)
    timed = points.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_s")).where("_s is not null")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in timed.select(*keys).schema.fields]
    runs = timed.mapInArrow(_runs(keys, gap), ", ".join([*kinds, "_s long", "_e long"]))
    by = Window.partitionBy(*keys).orderBy("_s", "_e")
    new = F.col("_s") - F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1)) > gap
    numbered = runs.withColumn("_new", F.coalesce(new, F.lit(False)).cast("int")).withColumn("segment", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
    at = lambda micros: F.timestamp_micros(micros).cast(points.schema[ts].dataType)
    return numbered.groupBy(*keys, "segment").agg(at(F.min("_s")).alias("s"), at(F.max("_e")).alias("e"))


def _runs(keys: list[str], gap: int) -> Callable:
    """Rows (keys, _s) to runs (keys, _s, _e), in which each time is at most the gap after the one before."""

    def merged(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        codes = [t[k].combine_chunks().dictionary_encode("encode").indices.to_numpy() for k in keys]
        order = np.lexsort((t["_s"].to_numpy(), *codes))
        s = t["_s"].to_numpy()[order]
        first = np.append(True, np.diff(s) > gap)
        for c in codes:
            first[1:] |= np.diff(c[order]) != 0
        at = np.flatnonzero(first)
        own = t.select(keys).take(pa.array(order[at])).combine_chunks()
        return pa.RecordBatch.from_arrays([*[c.combine_chunks() for c in own.columns], pa.array(s[at]), pa.array(s[np.append(at[1:], len(s)) - 1])], [*keys, "_s", "_e"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, held = [], 0
        for b in batches:
            if b.num_rows:
                ready.append(b)
                held += b.num_rows
            if held >= MERGED:
                yield merged(ready)
                ready, held = [], 0
        if ready:
            yield merged(ready)

    return runs


def downsample(points: DataFrame, keys: list[str], maximum: int, order: list[str]) -> DataFrame:
    """Keep every 2^k-th row of a key, with the least k that leaves at most ``maximum``."""
    by = Window.partitionBy(*keys)
    n, rn = F.count("*").over(by), F.row_number().over(by.orderBy(*order)) - 1
    stride = F.pow(F.lit(2), F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("_n").cast("double") / F.lit(float(maximum)))).cast("double"))).cast("long")
    return points.withColumns({"_n": n, "_rn": rn}).where(F.col("_rn") % stride == 0).drop("_n", "_rn")


def with_flags(detections: DataFrame, sensors: DataFrame, config: AppConfig) -> DataFrame:
    """Detections (sensor_id, object_id, object_type, ts, frame_id, box, confidence, info, embedding) with the sensor's
    place, the foot point's ground location, and the location, embedding and region flags.

    The sensor table has a row for each camera; it is broadcast by Spark when it is small.
    """
    p = config.preprocessing
    own = sensors.select("sensor_id", F.col("place").alias("_place"), "frame_width", "frame_height", "homography", "rois", F.lit(True).alias("_known"))
    d = detections.join(own, "sensor_id", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    box = ("left_x", "top_y", "right_x", "bottom_y")
    d = d.withColumns({"area": C.bbox_area(*box), "aspect": C.bbox_aspect_ratio(*box)})
    x, y = C.foot_point("left_x", "right_x", "bottom_y", F.col("info")["footLocation"])
    size = ("frame_width", "frame_height", "_known")
    d = d.withColumns(
        {
            "location": F.when(F.col("homography").isNotNull(), C.foot_location(x, y, F.col("homography"))),
            "location_valid": C.location_valid("confidence", "area", "aspect", "bottom_y", *size, p),
            "embedding_valid": C.embedding_valid("embedding", "confidence", "area", "aspect", "bottom_y", *size, C.visibility(F.col("info")), p),
            "place": F.coalesce("_place", F.lit("")),
        }
    )
    return d.withColumn("in_roi", C.in_regions(F.col("location"), F.col("rois"), p.filterByRegionsOfInterest)).drop("_place", "_known", "rois", "homography")


def recent(detections: DataFrame, minutes: float | None, as_of: Column) -> DataFrame:
    """Drop frames older than ``minutes`` (whole seconds) before ``as_of``."""
    if minutes is None:
        return detections
    return detections.where(F.unix_micros(as_of) <= F.unix_micros(F.col("ts").cast("timestamp")) + F.lit(int(minutes * 60) * 1_000_000))


def track_points(flagged: DataFrame, config: AppConfig) -> DataFrame:
    """Segmented rows inside the regions, thinned to the most that a tracklet keeps."""
    p = config.preprocessing
    points = split_by_gap(flagged, p.behaviorSplitThreshSec, tie="frame_id")
    points = points.where("in_roi")
    return downsample(points, [*TRACK, "segment"], p.behaviorNumLocationsMax, ["ts", "frame_id"])


def vector_sum(rows: DataFrame, keys: list[str], vector: str, out: str) -> DataFrame:
    """Element-wise sums of a key's vectors; each element is added up before the shuffle."""
    parts = rows.where(F.col(vector).isNotNull()).select(*keys, F.posexplode(vector).alias("_i", "_x"))
    sums = parts.groupBy(*keys, "_i").agg(F.sum(F.col("_x").cast("double")).alias("_s"))
    return sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_s"))), lambda e: e["_s"]).alias(out))


def behaviors(points: DataFrame) -> DataFrame:
    """A row for each segment, with its parallel arrays in time order and the sum of its valid embeddings."""
    keys = [*TRACK, "segment"]
    step = F.struct("ts", "frame_id", "left_x", "top_y", "right_x", "bottom_y", "confidence", "location", "location_valid", "area", "aspect")
    rows = points.groupBy(*keys).agg(
        F.min("ts").alias("start"),
        F.max("ts").alias("end"),
        F.min("frame_id").alias("start_frame"),
        F.max("frame_id").alias("end_frame"),
        F.first("object_type", True).alias("object_type"),
        F.countDistinct("object_type").alias("_types"),
        F.first("place").alias("place"),
        F.max("frame_width").alias("frame_width"),
        F.max("frame_height").alias("frame_height"),
        F.avg(F.when(F.col("confidence") >= 0, F.col("confidence"))).alias("mean_confidence"),
        F.avg("area").alias("mean_area"),
        F.avg("aspect").alias("mean_aspect"),
        F.array_sort(F.collect_list(step)).alias("steps"),
    )
    rows = rows.withColumn("object_type", F.when(F.col("_types") <= 1, F.col("object_type")).otherwise(F.raise_error(F.lit("a tracklet has objects of two types")))).drop("_types")
    sums = vector_sum(points.where("embedding_valid"), keys, "embedding", "embedding")
    out = rows.join(sums, keys, "left")
    located = F.filter(F.col("steps"), lambda s: s["location_valid"] & s["location"].isNotNull())
    return out.withColumns(
        {
            "id": C.behavior_id("sensor_id", "object_id"),
            "key": C.behavior_key("sensor_id", "object_id", "start"),
            "locations": F.transform(located, lambda s: F.array(s["location"]["x"], s["location"]["y"])),
            "location_times": F.transform(located, lambda s: s["ts"]),
        }
    )


def rejection(config: PreprocessingConfig, as_of: Column) -> Column:
    """The first filter that a behavior fails, null if it passes all: confidence, box, length, embedding."""
    confident = F.coalesce(F.col("mean_confidence") >= config.behaviorConfidenceThresh, F.lit(False))
    known = F.col("frame_width").isNotNull() & F.col("frame_height").isNotNull()
    big = ~known | (F.col("mean_area") > F.col("frame_width") * F.col("frame_height") * F.lit(config.behaviorBboxAreaThresh))
    shaped = (F.col("mean_aspect") < config.behaviorBboxAspectRatioThresh) & big
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    long = micros("end") - micros("start") >= F.lit(int(config.behaviorLengthThreshSec * 1e6))
    if config.shortBehaviorFinishThreshSec is not None:
        long = long | (F.unix_micros(as_of) >= micros("end") + F.lit(int(config.shortBehaviorFinishThreshSec * 1e6)))
    return F.when(~confident, "confidence").when(~shaped, "bbox").when(~long, "length").when(F.col("embedding").isNull(), "embedding")


def filtered(rows: DataFrame, config: AppConfig, as_of: Column | None = None) -> DataFrame:
    """Behaviors that pass all filters, with unit embeddings; a sum without length is an error."""
    as_of = F.current_timestamp() if as_of is None else as_of
    kept = rows.where(rejection(config.preprocessing, as_of).isNull())
    unit = C.normalized(F.col("embedding"))
    return kept.withColumn("embedding", F.when(unit.isNotNull(), unit).otherwise(F.raise_error(F.lit("an embedding has no length"))))


def hold_back(points: DataFrame, keys: list[str], delay_ms: int, ts: str = "ts", faithful: bool = False) -> DataFrame:
    """Cut every key at the newest end less the delay.

    Fixed: all rows after that go. Faithful: only the last row of a key that has late rows goes,
    and a key of late rows only, or that ends just at the limit, goes as a whole.
    """
    newest = points.agg(F.max(ts).alias("_newest"))
    d = points.crossJoin(F.broadcast(newest))  # a single row
    limit = F.unix_micros(F.col("_newest").cast("timestamp")) - F.lit(delay_ms * 1000)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    if not faithful:
        return d.where(micros <= limit).drop("_newest")
    by = Window.partitionBy(*keys)
    d = d.withColumns({"_end": F.max(micros).over(by), "_n": F.count("*").over(by), "_rn": F.row_number().over(by.orderBy(ts)), "_limit": limit})
    late = F.col("_end") > F.col("_limit")
    keep = F.when(F.col("_end") == F.col("_limit"), F.lit(False)).when(late, (F.col("_rn") < F.col("_n")) & (F.col("_n") > 1)).otherwise(F.lit(True))
    return d.where(keep).drop("_newest", "_end", "_n", "_rn", "_limit")


def stitch(rows: DataFrame, gap_seconds: float) -> DataFrame:
    """Number runs of behaviors of one id whose gaps are at most ``gap_seconds``, in time order."""
    by = Window.partitionBy("id").orderBy("start", "key")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    ended = F.max(micros("end")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(micros("start") - ended > F.lit(int(gap_seconds * 1e6)), F.lit(False))
    return rows.withColumn("_new", new.cast("int")).withColumn("run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")
