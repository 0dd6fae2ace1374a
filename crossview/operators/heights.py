"""People's heights from boxes and camera poses, and feet that the frame or other things hide, as expressions over a table of cameras."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig
from . import calibration as K

Pose = tuple[np.ndarray, np.ndarray, np.ndarray]


def poses(sensors: list[dict]) -> dict[str, Pose]:
    """Intrinsics, rotation and translation of each camera with enough points and a known frame; others are left out."""
    out = {}
    for s, state in zip(sensors, K.sensor_states(sensors), strict=True):
        if state["frame_width"] is None or state["frame_height"] is None:
            continue
        k = K.assumed_intrinsics(state["frame_width"], state["frame_height"])
        points = lambda name, s=s: np.array([[p["x"], p["y"]] for p in s.get(name) or []], float)
        found = K.pose(points("imageCoordinates"), points("globalCoordinates"), k) if len(points("imageCoordinates")) >= 4 else None
        if found:
            out[s["id"]] = (k, found[0], found[1])
    return out


_CAMERA = "sensor_id string, ray array<double>, origin array<double>, ground array<double>"


def cameras(spark: SparkSession, poses: dict[str, Pose]) -> DataFrame:
    """A row for each camera: pixels to rays, its place, and ground places to pixels (matrices by rows)."""
    rows = []
    for name, (k, r, t) in poses.items():
        ground = k @ np.c_[r[:, 0], r[:, 1], t]
        rows.append((name, (r.T @ np.linalg.inv(k)).ravel().tolist(), (-r.T @ t).tolist(), ground.ravel().tolist()))
    return spark.createDataFrame(rows, _CAMERA)


def _times(m: Column, x: Column, y: Column) -> list[Column]:
    """A matrix of nine numbers times (x, y, 1)."""
    return [m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2] for i in range(3)]


def _reach(ray: list[Column], axis: int, depth: Column) -> list[Column]:
    """The point of a camera's ray whose coordinate ``axis`` is ``depth``; null if the ray never gets there."""
    way = F.when(F.abs(ray[axis]) >= 1e-12, (depth - F.col("origin")[axis]) / ray[axis])
    return [F.col("origin")[i] + ray[i] * way for i in range(3)]


def _middle() -> Column:
    return (F.col("left_x") + F.col("right_x")) / 2


def with_heights(detections: DataFrame, poses: dict[str, Pose]) -> DataFrame:
    """A height for each detection, the foot on the ground and the head above it, as the mean of two anchors; null for
    unknown cameras and boxes without one. The camera table is broadcast by Spark when it is small."""
    d = detections.join(cameras(detections.sparkSession, poses), "sensor_id", "left")
    foot = _reach(_times(F.col("ray"), _middle(), F.col("bottom_y")), 2, F.lit(0.0))
    head = _times(F.col("ray"), _middle(), F.col("top_y"))
    d = d.withColumns({"_x": foot[0], "_y": foot[1]})
    a, b = (_reach(head, i, F.col(c))[2] for i, c in ((0, "_x"), (1, "_y")))
    both = F.when(a.isNull(), b).when(b.isNull(), a).otherwise((a + b) / 2)
    return d.withColumn("height", both).drop("ray", "origin", "ground", "_x", "_y")


def estimate(detections: DataFrame, poses: dict[str, Pose], config: AppConfig) -> DataFrame:
    """(sensor_id, height): the mean of the largest share of each camera's heights in its first frames."""
    c = config.localization
    d = with_heights(detections.where(F.col("frame_id") <= c.peopleHeightNumBatchFrames), poses).where("height is not null")
    if c.overwrittenPeopleHeightMeter is not None:
        return d.select("sensor_id").distinct().withColumn("height", F.lit(float(c.overwrittenPeopleHeightMeter)))
    return K.trimmed_mean(d, "sensor_id", "height", c.peopleHeightEstimationRatio, "frame_id").withColumnRenamed("value", "height")


class RunningHeight:
    """One camera's estimate over a stream: samples gather until there are enough, or time is up, then it stands."""

    def __init__(self, config: AppConfig):
        self.config, self.samples, self.first, self.value = config.localization, [], None, config.localization.overwrittenPeopleHeightMeter

    def add(self, at_sec: float, heights: list[float]) -> float | None:
        if self.value is not None:
            return self.value
        self.first = at_sec if self.first is None else self.first
        self.samples += heights
        if self.samples and (len(self.samples) > self.config.peopleHeightNumSamplesMax or at_sec - self.first > self.config.peopleHeightMaxLengthSec):
            n = max(1, int(len(self.samples) * self.config.peopleHeightEstimationRatio))
            self.value = float(np.mean(sorted(self.samples, reverse=True)[:n]))
            self.samples = []
        return self.value


def rectified(detections: DataFrame, poses: dict[str, Pose], heights: dict[str, float], config: AppConfig) -> DataFrame:
    """Detections with foot_x, foot_y and visibility, the share of a person that is seen; where that is too small the foot is
    where the head and the camera's height say."""
    spark = detections.sparkSession
    known = spark.createDataFrame([(s, float(h)) for s, h in heights.items() if s in poses], "sensor_id string, _height double")
    d = detections.join(cameras(spark, poses).join(known, "sensor_id"), "sensor_id", "left")
    top, bottom = F.col("top_y"), F.col("bottom_y")
    head = _reach(_times(F.col("ray"), _middle(), top), 2, F.col("_height"))
    at = _times(F.col("ground"), head[0], head[1])
    d = d.withColumns({"_fx": F.when(F.abs(at[2]) > 1e-12, at[0] / at[2]), "_fy": F.when(F.abs(at[2]) > 1e-12, at[1] / at[2])})
    usable = F.col("_fy") > top
    seen = F.when(usable, F.least(F.lit(1.0), (bottom - top + 1) / (F.col("_fy") - top + 1))).otherwise(F.lit(1.0))
    d = d.withColumn("visibility", seen)
    hidden = usable & (F.col("visibility") < config.localization.peopleHeightVisibilityThresh)
    d = d.withColumns({"foot_x": F.when(hidden, F.col("_fx")).otherwise(_middle()), "foot_y": F.when(hidden, F.col("_fy")).otherwise(bottom.cast("double"))})
    return d.drop("ray", "origin", "ground", "_height", "_fx", "_fy")
