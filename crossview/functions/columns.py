"""Scalar functions of the engine as Column expressions: boxes, projections, vectors, keys, regions, similarities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PreprocessingConfig

KEY_SEPARATOR = " #-# "
FOOT_PIXEL_MARGIN = 0.1


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Boxes. Coordinates are inclusive pixels.
def bbox_area(left, top, right, bottom) -> Column:
    return (_c(right) - _c(left) + 1) * (_c(bottom) - _c(top) + 1)


def bbox_aspect_ratio(left, top, right, bottom) -> Column:
    return (_c(right) - _c(left) + 1).cast("double") / (_c(bottom) - _c(top) + 1).cast("double")


def foot_point(left, right, bottom, foot: Column | None = None) -> tuple[Column, Column]:
    """The parsed foot location ("x,y") if there is one, else the middle of the bottom edge."""
    x, y = (_c(left) + _c(right)).cast("double") / F.lit(2.0), _c(bottom).cast("double")
    if foot is None:
        return x, y
    parts = F.split(foot, ",")
    fx, fy = (F.expr("try_cast(null as double)") if p is None else p for p in (parts[0].try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")))
    ok = fx.isNotNull() & fy.isNotNull()
    return F.when(ok, fx).otherwise(x), F.when(ok, fy).otherwise(y)


def visibility(info: Column) -> Column:
    """Null if absent, 1 if it can't be read."""
    raw = info["visibility"]
    return F.when(raw.isNotNull(), F.coalesce(raw.try_cast("double"), F.lit(1.0)))


def quality_rejected(confidence, area, aspect, width, height, confidence_min: float, aspect_max: float, area_min: float) -> Column:
    """True unless confidence, shape and size all pass; unknown frame sizes reject."""
    keep = (_c(confidence) >= confidence_min) & (_c(aspect) < aspect_max) & (_c(area) > _c(width) * _c(height) * F.lit(float(area_min)))
    return ~F.coalesce(keep, F.lit(False))


def touches_bottom(bottom, height, gap: float) -> Column:
    """Whether a box ends in the lowest share of its frame; unknown heights do not."""
    return F.coalesce(_c(bottom).cast("double") > F.lit(1.0 - gap) * _c(height), F.lit(False))


def location_valid(confidence, area, aspect, bottom, width, height, known, config: PreprocessingConfig) -> Column:
    bad = quality_rejected(confidence, area, aspect, width, height, config.locationConfidenceThresh, config.locationBboxAspectRatioThresh, config.locationBboxAreaThresh)
    return _c(known) & ~bad & ~touches_bottom(bottom, height, config.locationBboxBottomGapThresh)


def embedding_valid(embedding, confidence, area, aspect, bottom, width, height, known, visible, config: PreprocessingConfig) -> Column:
    bad = quality_rejected(confidence, area, aspect, width, height, config.embeddingConfidenceThresh, config.embeddingBboxAspectRatioThresh, config.embeddingBboxAreaThresh)
    seen = F.coalesce(_c(visible) > config.embeddingVisibilityThresh, F.lit(True))
    return _c(embedding).isNotNull() & _c(known) & ~bad & ~touches_bottom(bottom, height, config.embeddingBboxBottomGapThresh) & seen


# Projections.
def project(x, y, h: list[float] | Column) -> Column:
    """A pixel through a homography (nine numbers by rows) as struct<x,y>; null where it has no image."""
    m = [h[i] if isinstance(h, Column) else F.lit(float(h[i])) for i in range(9)]
    x, y = _c(x).cast("double"), _c(y).cast("double")
    w = m[6] * x + m[7] * y + m[8]
    return F.when(w != 0, F.struct(((m[0] * x + m[1] * y + m[2]) / w).alias("x"), ((m[3] * x + m[4] * y + m[5]) / w).alias("y")))


def foot_location(x, y, h: list[float] | Column) -> Column:
    """The projected foot point; null at the image's origin, which marks a missing point."""
    return F.when((_c(x) > FOOT_PIXEL_MARGIN) | (_c(y) > FOOT_PIXEL_MARGIN), project(x, y, h))


def map_pixel(x, y, tx: float, ty: float, scale: float, height: int) -> tuple[Column, Column]:
    """Ground position to map pixel, truncated towards zero."""
    return (((_c(x) + F.lit(tx)) * F.lit(scale)).cast("int"), (F.lit(float(height - 1)) - (_c(y) + F.lit(ty)) * F.lit(scale)).cast("int"))


def topview_pixel(x, y, tx: float, ty: float, scale: float, height: int, output_scale: float) -> tuple[Column, Column]:
    px, py = (_c(x) + F.lit(tx)) * F.lit(scale), F.lit(float(height)) - (_c(y) + F.lit(ty)) * F.lit(scale)
    return (px * F.lit(output_scale)).cast("int"), (py * F.lit(output_scale)).cast("int")


def shift_center(x, y, radius: float, degrees: float | Column) -> tuple[Column, Column]:
    """A point at a distance, in a direction clockwise from north (image rows grow downwards)."""
    angle = F.radians(degrees if isinstance(degrees, Column) else F.lit(float(degrees)))
    return _c(x) + F.lit(radius) * F.sin(angle), _c(y) - F.lit(radius) * F.cos(angle)


# Vectors.
def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v) -> Column:
    return F.sqrt(dot(v, v))


def normalized(v) -> Column:
    """The vector over its length; null if it is empty or has none."""
    n = l2_norm(v)
    return F.when((F.size(_c(v)) > 0) & (n > 0), F.transform(_c(v), lambda x: x.cast("double") / n))


def appearance_distance(a, b) -> Column:
    """Half of one minus the cosine, for unit vectors: from 0 to 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(4.0), F.lit(2.0) - F.lit(2.0) * dot(a, b))) / F.lit(4.0)


def directed_distance(ax, ay, bx, by, adx=None, ady=None, bdx=None, bdy=None, magnitude: float = 0.5) -> Column:
    """Euclidean distance, longer by the share of a half turn between two directions of enough length."""
    d = F.sqrt(F.pow(_c(ax) - _c(bx), 2) + F.pow(_c(ay) - _c(by), 2))
    if adx is None:
        return d
    na, nb = F.sqrt(_c(adx) * _c(adx) + _c(ady) * _c(ady)), F.sqrt(_c(bdx) * _c(bdx) + _c(bdy) * _c(bdy))
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (_c(adx) * _c(bdx) + _c(ady) * _c(bdy)) / (na * nb)))
    return F.when((na > magnitude) & (nb > magnitude), d * (F.lit(1.0) + F.acos(cosine) / F.lit(math.pi))).otherwise(d)


def is_close(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(_c(a) - _c(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(_c(b))


# Keys and times.
def iso_millis(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def behavior_id(sensor, obj) -> Column:
    return F.concat_ws(KEY_SEPARATOR, _c(sensor), _c(obj).cast("string"))


def behavior_key(sensor, obj, start) -> Column:
    return F.concat_ws(KEY_SEPARATOR, _c(sensor), _c(obj).cast("string"), iso_millis(start))


def wire_timestamp(seconds, nanos) -> Column:
    """Seconds and nanoseconds to a timestamp, cut to milliseconds."""
    return F.timestamp_millis((_c(seconds) * 1000 + F.floor(_c(nanos) / 1_000_000)).cast("long"))


def log_time(frame_id, base_ms: int, fps: float) -> Column:
    """A time for each frame of a log without times."""
    return F.timestamp_millis((F.lit(base_ms) + F.floor(_c(frame_id) * F.lit(1000) / F.lit(float(fps)))).cast("long"))


def place_string(place: Column) -> Column:
    return F.array_join(F.transform(place, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "/")


def sensor_number(sensor) -> Column:
    """The first digits of a sensor id."""
    return F.regexp_extract(_c(sensor), r"\d+", 0)


def plain_polygon(wkt) -> Column:
    """A WKT polygon without empty ring fragments."""
    return F.replace(F.replace(_c(wkt), F.lit("(),"), F.lit("")), F.lit(",()"), F.lit(""))


# Regions.
def inside_polygon(x, y, polygon: Column) -> Column:
    """Even-odd rule over an array of struct<x,y>; points on an edge may fall on either side."""
    x, y, n = _c(x), _c(y), F.size(polygon)
    pairs = F.zip_with(polygon, F.concat(F.slice(polygon, 2, n), F.slice(polygon, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crossed = F.filter(
        pairs,
        lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]),
    )
    return (F.size(crossed) % 2) == 1


def in_regions(location: Column, rois: Column, enabled: bool) -> Column:
    """Disabled: always. Enabled: a location that lies in some region, or any location where no region is set."""
    if not enabled:
        return F.lit(True)
    none = rois.isNull() | (F.size(rois) == 0)
    return location.isNotNull() & (none | F.exists(rois, lambda p: inside_polygon(location["x"], location["y"], p)))


# Similarities of evaluation.
def box_iou(ax, ay, aw, ah, bx, by, bw, bh, of_first: bool = False) -> Column:
    """Intersection over union (or over the first box) of x, y, width, height boxes; 0 without area."""
    ax, ay, aw, ah, bx, by, bw, bh = (_c(v).cast("double") for v in (ax, ay, aw, ah, bx, by, bw, bh))
    iw = F.greatest(F.least(ax + aw, bx + bw) - F.greatest(ax, bx), F.lit(0.0))
    ih = F.greatest(F.least(ay + ah, by + bh) - F.greatest(ay, by), F.lit(0.0))
    whole = aw * ah if of_first else aw * ah + bw * bh - iw * ih
    return F.when(whole > 0, iw * ih / whole).otherwise(F.lit(0.0))


def euclid_similarity(ax, ay, bx, by, zero: float = 2.0) -> Column:
    d = F.sqrt(F.pow(_c(ax) - _c(bx), 2) + F.pow(_c(ay) - _c(by), 2))
    return F.greatest(F.lit(0.0), F.lit(1.0) - d / F.lit(zero))
