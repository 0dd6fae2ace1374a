"""Camera calibration: homographies, camera poses, people's heights, and the sensor dimension."""

from __future__ import annotations

import json
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import SENSOR_STATE


def homography(image: np.ndarray, ground: np.ndarray) -> np.ndarray | None:
    """The 3 x 3 matrix from pixels to the ground: normalised linear solution, refined on ground errors.

    None for fewer than four pairs or unequal lengths.
    """
    image, ground = np.asarray(image, float).reshape(-1, 2), np.asarray(ground, float).reshape(-1, 2)
    if len(image) < 4 or len(image) != len(ground):
        return None

    def scale(p: np.ndarray) -> np.ndarray:
        c = p.mean(0)
        s = np.sqrt(2) / max(np.linalg.norm(p - c, axis=1).mean(), 1e-12)
        return np.array([[s, 0, -s * c[0]], [0, s, -s * c[1]], [0, 0, 1]])

    ta, tb = scale(image), scale(ground)
    a, b = (np.c_[p, np.ones(len(p))] @ t.T for p, t in ((image, ta), (ground, tb)))
    zero = np.zeros((len(a), 3))
    rows = np.r_[np.c_[a, zero, -b[:, :1] * a], np.c_[zero, a, -b[:, 1:2] * a]]
    h = np.linalg.inv(tb) @ np.linalg.svd(rows)[2][-1].reshape(3, 3) @ ta
    h /= h[2, 2] if abs(h[2, 2]) > 1e-12 else np.linalg.norm(h)
    return refine(lambda p: (apply(p.reshape(3, 3), image) - ground).ravel(), h.ravel()).reshape(3, 3)


def refine(error, start: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Levenberg-Marquardt with numeric derivatives."""
    p, damp = np.asarray(start, float).copy(), 1e-3
    e = error(p)
    for _ in range(rounds):
        step = np.maximum(np.abs(p), 1e-4) * 1e-6
        j = np.stack([(error(p + step * (np.arange(len(p)) == k)) - e) / step[k] for k in range(len(p))], 1)
        a, g = j.T @ j, j.T @ e
        try:
            move = -np.linalg.solve(a + damp * np.diag(np.diag(a) + 1e-12), g)
        except np.linalg.LinAlgError:
            break
        new = error(p + move)
        if not np.isfinite(new).all() or new @ new >= e @ e:
            damp *= 10
            if damp > 1e8:
                break
            continue
        gain = e @ e - new @ new
        p, e, damp = p + move, new, damp / 10
        if gain < 1e-15 * max(e @ e, 1e-30):
            break
    return p


def apply(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    q = np.c_[np.asarray(points, float).reshape(-1, 2), np.ones(len(np.asarray(points).reshape(-1, 2)))] @ np.asarray(h).T
    return q[:, :2] / q[:, 2:]


def assumed_intrinsics(width: int, height: int) -> np.ndarray:
    """The principal point in the middle, and the frame's height as focal length."""
    return np.array([[height, 0, width // 2], [0, height, height // 2], [0, 0, 1]], float)


def rotation(vector: np.ndarray) -> np.ndarray:
    angle = np.linalg.norm(vector)
    if angle < 1e-12:
        return np.eye(3)
    x, y, z = vector / angle
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k


def rotation_vector(r: np.ndarray) -> np.ndarray:
    angle = np.arccos(np.clip((np.trace(r) - 1) / 2, -1, 1))
    if angle < 1e-9:
        return np.zeros(3)
    if np.pi - angle < 1e-6:
        w, v = np.linalg.eigh((r + r.T) / 2)
        return v[:, np.argmax(w)] * angle
    return angle / (2 * np.sin(angle)) * np.array([r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]])


def euler_degrees(r: np.ndarray) -> np.ndarray:
    """Angles about x, y and z."""
    s = np.hypot(r[0, 0], r[1, 0])
    if s > 1e-6:
        return np.degrees([np.arctan2(r[2, 1], r[2, 2]), np.arctan2(-r[2, 0], s), np.arctan2(r[1, 0], r[0, 0])])
    return np.degrees([np.arctan2(-r[1, 2], r[1, 1]), np.arctan2(-r[2, 0], s), 0.0])


def pose(image: np.ndarray, ground: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Rotation, translation and position of a camera from points on the ground plane (z = 0)."""
    h = homography(ground, image)
    if h is None:
        return None
    m = np.linalg.inv(k) @ h
    m /= np.sqrt(np.linalg.norm(m[:, 0]) * np.linalg.norm(m[:, 1]))
    if m[2, 2] < 0:
        m = -m
    u, _, vt = np.linalg.svd(np.c_[m[:, 0], m[:, 1], np.cross(m[:, 0], m[:, 1])])
    r = u @ np.diag([1, 1, np.linalg.det(u @ vt)]) @ vt
    points = np.c_[np.asarray(ground, float).reshape(-1, 2), np.zeros(len(image))]

    def error(p: np.ndarray) -> np.ndarray:
        q = (points @ rotation(p[:3]).T + p[3:]) @ k.T
        return (q[:, :2] / q[:, 2:] - np.asarray(image, float)).ravel()

    p = refine(error, np.r_[rotation_vector(r), m[:, 2]])
    r = rotation(p[:3])
    return r, p[3:], -r.T @ p[3:]


def back_project(pixel: np.ndarray, k: np.ndarray, r: np.ndarray, t: np.ndarray, axis: int, depth: float) -> np.ndarray | None:
    """The point on a pixel's ray whose coordinate ``axis`` is ``depth``; None if the ray never gets there."""
    ray = r.T @ np.linalg.inv(k) @ np.array([pixel[0], pixel[1], 1.0])
    origin = -r.T @ t
    if abs(ray[axis]) < 1e-12:
        return None
    return origin + ray * (depth - origin[axis]) / ray[axis]


def people_height(box: tuple[float, float, float, float], k: np.ndarray, r: np.ndarray, t: np.ndarray) -> float | None:
    """A person's height from a box: the foot on the ground, the head above it, as the mean of two anchors."""
    x = (box[0] + box[2]) / 2
    foot = back_project((x, box[3]), k, r, t, 2, 0.0)
    if foot is None:
        return None
    heads = [back_project((x, box[1]), k, r, t, axis, foot[axis]) for axis in (0, 1)]
    heads = [h[2] for h in heads if h is not None]
    return float(np.mean(heads)) if heads else None


def expected_foot(box: tuple[float, float, float, float], height: float, k: np.ndarray, r: np.ndarray, t: np.ndarray) -> tuple[float, float] | None:
    """The pixel of the foot below a head at the known height."""
    head = back_project(((box[0] + box[2]) / 2, box[1]), k, r, t, 2, height)
    if head is None:
        return None
    q = k @ (r @ np.array([head[0], head[1], 0.0]) + t)
    return (float(q[0] / q[2]), float(q[1] / q[2])) if abs(q[2]) > 1e-12 else None


def rectified_foot(box: tuple[float, float, float, float], height: float, k: np.ndarray, r: np.ndarray, t: np.ndarray, threshold: float) -> tuple[float, float, float]:
    """The foot pixel and the visible share of a person; where less than the threshold is seen, the foot is the expected one."""
    x, y = (box[0] + box[2]) / 2, box[3]
    want = expected_foot(box, height, k, r, t)
    if want is None or want[1] <= box[1]:
        return x, y, 1.0
    seen = min(1.0, (y - box[1] + 1) / (want[1] - box[1] + 1))
    return (*want, seen) if seen < threshold else (x, y, seen)


def trimmed_mean(rows: DataFrame, key: str, value: str, ratio: float, tie: str) -> DataFrame:
    """The mean of the largest share of each key's values."""
    by = Window.partitionBy(key)
    d = rows.withColumns({"_rn": F.row_number().over(by.orderBy(F.col(value).desc(), tie)), "_n": F.count("*").over(by)})
    return d.where(F.col("_rn") <= F.floor(F.col("_n") * F.lit(ratio))).groupBy(key).agg(F.avg(value).alias("value"))


def sensor_states(sensors: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Calibrated sensors: place, frame, region polygons, and the homography (a supplied one is inverted)."""
    out = []
    for s in sensors:
        attributes = {a["name"]: a["value"] for a in s.get("attributes") or []}

        def number(name: str, kind, attributes=attributes):
            try:
                return kind(float(attributes[name]))
            except (KeyError, ValueError, TypeError):
                return None

        if s.get("homography") is not None:
            h = np.linalg.inv(np.array(s["homography"], float))
        else:
            points = lambda name, s=s: [[p["x"], p["y"]] for p in s.get(name) or []]
            h = homography(points("imageCoordinates"), points("globalCoordinates"))
        out.append(
            {
                "sensor_id": s["id"],
                "place": "/".join(f"{p['name']}={p['value']}" for p in s.get("place") or []),
                "frame_width": number("frameWidth", int),
                "frame_height": number("frameHeight", int),
                "fps": number("fps", float),
                "direction": number("direction", float),
                "field_of_view": attributes.get("fieldOfViewPolygon"),
                "homography": None if h is None else [float(v) for v in h.ravel()],
                "rois": [[{"x": float(c["x"]), "y": float(c["y"])} for c in roi.get("roiCoordinates") or []] for roi in s.get("rois") or []],
            }
        )
    return out


def calibrate(spark: SparkSession, path: str) -> DataFrame:
    """The sensor dimension from a calibration file; a missing file gives an empty one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(hadoop):
        return spark.createDataFrame([], SENSOR_STATE)
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame(sensor_states(json.loads(text)["sensors"]), SENSOR_STATE)


def reprojection_errors(spark: SparkSession, sensors: list[dict[str, Any]]) -> DataFrame:
    """For each calibration point how far its image lies from its ground position."""
    rows = []
    for s, state in zip(sensors, sensor_states(sensors), strict=True):
        if state["homography"] is None:
            continue
        h = np.array(state["homography"]).reshape(3, 3)
        for i, (p, g) in enumerate(zip(s.get("imageCoordinates") or [], s.get("globalCoordinates") or [], strict=False)):
            x, y = apply(h, [[p["x"], p["y"]]])[0]
            rows.append((s["id"], i, float(x), float(y), float(np.hypot(x - g["x"], y - g["y"]))))
    return spark.createDataFrame(rows, "sensor_id string, point int, x double, y double, error double")
