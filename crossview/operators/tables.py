"""Tables behind overlays, anomaly mining and log synchronisation, and small folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def in_ranges(rows: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose values lie in all ranges, ends included."""
    for c, (lo, hi) in ranges.items():
        rows = rows.where(F.col(c).between(lo, hi))
    return rows


def rounded_attributes(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(c, 2).alias(c) if t in ("double", "float") else F.col(c) for c, t in rows.dtypes])


def sample(rows: DataFrame, k: int, seed: int) -> DataFrame:
    return rows.orderBy(F.rand(seed)).limit(k)


def frame_runs(rows: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """First and last frame of each run of consecutive frames."""
    island = F.col(frame) - F.row_number().over(Window.partitionBy(*keys).orderBy(frame))
    return rows.select(*keys, frame).distinct().withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame")).drop("_island")


def moving_average(rows: DataFrame, key: str, value: str, order: list[str], rate: float) -> DataFrame:
    """The exponential moving average at the end of each key, from its first value on.

    As a weighted sum: a value counts by its distance from the end, the first one for all that would come before it. So
    no history is held in one row.
    """
    by = Window.partitionBy(key)
    d = rows.select(key, F.col(value).cast("double").alias("_x"), F.row_number().over(by.orderBy(*order)).alias("_rn"), F.count("*").over(by).alias("_n"))
    weight = F.pow(F.lit(1 - rate), (F.col("_n") - F.col("_rn")).cast("double")) * F.when(F.col("_rn") == 1, F.lit(1.0)).otherwise(F.lit(rate))
    return d.groupBy(key).agg(F.sum(F.col("_x") * weight).alias("ema"))


def overlay_points(points: DataFrame, assignments: DataFrame) -> DataFrame:
    """Boxes of detections with their global id; only frames of tracklets that survived."""
    a = assignments.select("sensor_id", "object_id", "segment", "global_id")
    return points.join(a, ["sensor_id", "object_id", "segment"]).select("sensor_id", "frame_id", "ts", "global_id", "left_x", "top_y", "right_x", "bottom_y")


def topview_trajectories(points: DataFrame, assignments: DataFrame, tx: float, ty: float, scale: float, height: int, window: int) -> DataFrame:
    """Map pixels of global ids, and their mean over the last ``window`` points (full windows only, cut to whole pixels)."""
    a = assignments.select("sensor_id", "object_id", "segment", "global_id")
    x, y = C.map_pixel("location.x", "location.y", tx, ty, scale, height)
    p = points.where("location_valid and location is not null").join(a, ["sensor_id", "object_id", "segment"]).select("global_id", "ts", "frame_id", "sensor_id", x.alias("px"), y.alias("py"))
    by = Window.partitionBy("global_id").orderBy("ts", "sensor_id", "frame_id")
    tail = by.rowsBetween(-(window - 1), 0)
    full = F.row_number().over(by) >= window
    return p.withColumns({c: F.when(full, F.avg(v).over(tail).cast("int")) for c, v in (("smooth_x", "px"), ("smooth_y", "py"))})


# The colours (blue, green, red) that numbers stand for, by remainder.
PALETTE = ((239, 120, 223), (0, 185, 118), (50, 50, 240), (213, 145, 113))


def palette_color(index: Column) -> Column:
    """The colour of a number as struct<b,g,r>."""
    colors = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(c, "bgr", strict=True)]) for c in PALETTE])
    return F.get(colors, F.pmod(index, F.lit(len(PALETTE))).cast("int"))


def buffered(rows: DataFrame, keys: list[str], ts: str, span_sec: float) -> DataFrame:
    """For each row how many rows of its key, itself and those at its time included, a buffer of ``span_sec`` then holds, and since when."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    by = Window.partitionBy(*keys).orderBy(micros).rangeBetween(-int(span_sec * 1e6), 0)
    return rows.withColumns({"held": F.count("*").over(by), "since": F.min(ts).over(by)})


def sensor_ranks(rows: DataFrame, sensor: str) -> DataFrame:
    """Every sensor with its number in order of the names, from 1 on (a row for each camera)."""
    return rows.select(sensor).distinct().withColumn("rank", F.row_number().over(Window.orderBy(sensor)))


def first_sensors(rows: DataFrame, sensor: str, n: int) -> DataFrame:
    """Rows of the first ``n`` sensors, which a grid has room for."""
    return rows.join(rows.select(sensor).distinct().orderBy(sensor).limit(n), sensor, "left_semi")


def top_rows(rows: DataFrame, by: str, ties: list[str], n: int = 20) -> DataFrame:
    """The rows with the largest values, ties in the given order."""
    return rows.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def in_output_order(rows: DataFrame, frame: list[str], ident: str) -> DataFrame:
    """Rows with their place in their frame's output, by id."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*frame).orderBy(ident)))


def last_batch_id(objects: DataFrame, batch: str, ident: str) -> DataFrame:
    """The last batch and the largest id in it, as one row."""
    return objects.agg(F.max(F.struct(F.col(batch), F.col(ident))).alias("_m")).select(F.col("_m")[batch].alias(batch), F.col("_m")[ident].alias(ident))


def query_and_gallery(rows: DataFrame, sensor: str, queries: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of the query cameras, and those of all others."""
    asked = F.coalesce(F.col(sensor).isin(queries), F.lit(False))
    return rows.where(asked), rows.where(~asked)


def truth_corners(truth: DataFrame) -> DataFrame:
    """Ground-truth boxes with inclusive corners."""
    return truth.withColumns({"right_x": F.col("X") + F.col("Width") - 1, "bottom_y": F.col("Y") + F.col("Height") - 1})


def checked_truth_locations(truth: DataFrame) -> DataFrame:
    """One ground position for each id and frame; different ones from different cameras are an error."""
    g = truth.groupBy("FrameId", "Id").agg(F.min(F.struct("Xworld", "Yworld")).alias("a"), F.max(F.struct("Xworld", "Yworld")).alias("b"))
    ok = (F.abs(F.col("a.Xworld") - F.col("b.Xworld")) < 1e-6) & (F.abs(F.col("a.Yworld") - F.col("b.Yworld")) < 1e-6)
    return g.select("FrameId", "Id", F.when(ok, F.col("a.Xworld")).otherwise(F.raise_error(F.lit("cameras disagree on a position"))).alias("x"), F.col("a.Yworld").alias("y"))


def synchronised(lines: DataFrame, base_ms: int, fps: float, zone: str = "America/Los_Angeles") -> DataFrame:
    """Lines (log, frame_id, value) with a local time text for their frame; of equal (time, log) the last stays, in order."""
    at = F.date_format(F.from_utc_timestamp(C.log_time("frame_id", base_ms, fps), zone), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    by = Window.partitionBy("at", "log").orderBy(F.col("frame_id").desc())
    return lines.withColumn("at", at).withColumn("_rn", F.row_number().over(by)).where("_rn = 1").drop("_rn").orderBy("at", "log")


def field_of_view_pixels(sensors: DataFrame, tx: float, ty: float, scale: float, height: int) -> DataFrame:
    """Vertices of the sensors' view polygons as map pixels."""
    pairs = F.regexp_extract_all(C.plain_polygon("field_of_view"), F.lit(r"(-?[\d.]+)\s+(-?[\d.]+)"), F.lit(0))
    v = sensors.where("field_of_view is not null").select("sensor_id", F.posexplode(pairs).alias("vertex", "pair"))
    xy = F.split("pair", r"\s+")
    x, y = C.map_pixel(xy[0].cast("double"), xy[1].cast("double"), tx, ty, scale, height)
    return v.select("sensor_id", "vertex", x.alias("px"), y.alias("py"))


def pareto_frontier(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Rows that no row with an x as large or larger beats in y (small tables: one task)."""
    best = F.max(y).over(Window.orderBy(F.col(x).desc(), F.col(y).desc()).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_best", best).where(f"_best is null or {y} > _best").drop("_best")
