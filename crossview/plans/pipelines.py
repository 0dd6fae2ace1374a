"""Whole paths through the engine: the flagship, a synthetic scene, tracking and locations end to end, and rows-only queries."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AGGLOMERATIVE, AppConfig, ClusteringConfig, PreprocessingConfig, StreamingConfig
from ..functions import columns as C
from ..operators import clustering as G
from ..operators import evaluation as E
from ..operators import heights as HT
from ..operators import relations as R
from ..operators import tracks as K
from ..operators.calibration import sensor_states
from ..schema import SENSOR_STATE
from ..session import fresh_folder
from ..sources import detections as S
from ..streaming import live as V
from . import catalogue as Q
from . import engine as N

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(f):
    QUERIES[f.__name__] = f
    return f


# The flagship: tracklets, their quality, the longest of each sensor.
FLAGSHIP_SQL = f"""with {Q.SEG}, good as (select sensor_id, object_id, segment, count(*) as n, round(avg(conf), 6) as mean_conf, round(sum(value), 2) as total, date_diff('microsecond', min(ts), max(ts)) as span_us
  from seg group by all having avg(case when conf >= 0 then conf end) >= 0.1 and date_diff('microsecond', min(ts), max(ts)) >= 86400::bigint * 1000000)
select sensor_id, object_id, segment, n, mean_conf, total, span_us, rank from (select *, row_number() over (partition by sensor_id order by span_us desc, object_id, segment) as rank from good) where rank <= 20"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    micros = lambda c: F.unix_micros(c)
    g = Q.segmented(spark, sf_dir).groupBy("sensor_id", "object_id", "segment").agg(
        F.count("*").alias("n"), F.avg("conf").alias("m"), F.avg(F.when(F.col("conf") >= 0, F.col("conf"))).alias("c"), F.round(F.sum("value"), 2).alias("total"), (micros(F.max("ts")) - micros(F.min("ts"))).alias("span_us")
    )
    rank = F.row_number().over(Window.partitionBy("sensor_id").orderBy(F.col("span_us").desc(), "object_id", "segment"))
    good = g.where((F.col("c") >= 0.1) & (F.col("span_us") >= 86400 * 1_000_000)).withColumn("rank", rank.cast("long")).where("rank <= 20")
    return good.select("sensor_id", "object_id", "segment", "n", F.round("m", 6).alias("mean_conf"), "total", "span_us", "rank")


QUERIES["q00_flagship"] = flagship
ORACLES["q00_flagship"] = FLAGSHIP_SQL


# A synthetic scene with known identities.
def scene(cameras: int = 2, people: int = 3, seconds: int = 20, fps: int = 5, dims: int = 16, noise: float = 0.05, seed: int = 7) -> tuple[list[str], list[dict], list[dict]]:
    """Log lines, calibration sensors, and the true person of each (sensor, object)."""
    rng = np.random.default_rng(seed)
    faces = rng.normal(size=(people, dims))
    faces /= np.linalg.norm(faces, axis=1, keepdims=True)
    scale = [0.010 + 0.001 * c for c in range(cameras)]
    sensors = [
        {
            "type": "camera", "id": f"Cam{c + 1:02d}",
            "attributes": [{"name": "frameWidth", "value": "1920"}, {"name": "frameHeight", "value": "1080"}, {"name": "fps", "value": str(fps)}],
            "place": [{"name": "building", "value": "A"}, {"name": "room", "value": "1"}],
            "imageCoordinates": [{"x": x, "y": y} for x, y in ((100, 100), (1800, 100), (1800, 1000), (100, 1000))],
            "globalCoordinates": [{"x": x * scale[c], "y": y * scale[c]} for x, y in ((100, 100), (1800, 100), (1800, 1000), (100, 1000))],
            "rois": [],
        }
        for c in range(cameras)
    ]
    lines, truth = [], []
    for c in range(cameras):
        truth += [{"sensor_id": f"Cam{c + 1:02d}", "object_id": str(10 * c + p), "person": p} for p in range(people)]
        for f in range(seconds * fps):
            t = datetime.fromtimestamp(1_700_000_000 + f / fps, timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")
            objects = []
            for p in range(people):
                gx, gy = 3 + 3 * p + math.sin(f / 20 + p), 3 + 1.5 * p + math.cos(f / 25 + p)
                x, y = gx / scale[c], gy / scale[c]
                v = faces[p] + noise * rng.normal(size=dims)
                objects.append(f"{10 * c + p}|{x - 30:.1f}|{y - 180:.1f}|{x + 30:.1f}|{y:.1f}|Person|#|m|30|brown|none|shirt|0.9|embedding|{','.join(f'{a:.5f}' for a in v)}")
            lines.append(json.dumps({"version": "4.0", "id": str(f + 1), "@timestamp": t, "sensorId": f"Cam{c + 1:02d}", "objects": objects}))
    return lines, sensors, truth


SCENE_CONFIG = AppConfig(
    preprocessing=PreprocessingConfig(behaviorLengthThreshSec=1.0),
    clustering=ClusteringConfig(clusteringAlgo=AGGLOMERATIVE, agglomerativeClusteringDistThresh=0.95, numReassignmentIterations=2),
)


def flagged_frames(frames: DataFrame, sensors: DataFrame, config: AppConfig, cameras: list[dict] | None = None) -> DataFrame:
    """Detections of frames with their places and flags.

    With ``timestampThreshMin`` only recent frames. With ``rectifyBboxByCalibration`` and the cameras' calibration feet that
    are hidden are put where the people's height of their camera says.
    """
    rows = S.detections(frames)
    as_of = F.lit(config.as_of).cast("timestamp") if config.as_of else F.current_timestamp()
    rows = K.recent(rows, config.preprocessing.timestampThreshMin, as_of)
    if config.localization.rectifyBboxByCalibration and cameras:
        rows = rectified(rows, cameras, config)
    return K.with_flags(rows, sensors, config)


def rectified(rows: DataFrame, cameras: list[dict], config: AppConfig) -> DataFrame:
    """Detections whose info tells the foot point and visibility that the people's heights give."""
    poses = HT.poses(cameras)
    heights = {r.sensor_id: r.height for r in HT.estimate(rows, poses, config).collect()}  # a row for each camera
    d = HT.rectified(rows, poses, heights, config)
    foot = F.create_map(F.lit("footLocation"), F.concat_ws(",", F.col("foot_x").cast("string"), F.col("foot_y").cast("string")), F.lit("visibility"), F.col("visibility").cast("string"))
    known = F.map_filter(F.coalesce("info", F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("footLocation", "visibility"))
    return d.withColumn("info", F.when(F.col("sensor_id").isin(*heights) if heights else F.lit(False), F.map_concat(known, foot)).otherwise(F.col("info"))).drop("foot_x", "foot_y", "visibility")


def flagged(lines: DataFrame, sensors: DataFrame, config: AppConfig, cameras: list[dict] | None = None) -> DataFrame:
    """Detections of log lines with their places and flags."""
    return flagged_frames(S.frames_from_text(lines, config), sensors, config, cameras)


def tracked(spark: SparkSession, lines: DataFrame, sensors: DataFrame, config: AppConfig, cameras: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """From log lines to track points and behaviors that pass the filters."""
    return tracked_frames(S.frames_from_text(lines, config), sensors, config, cameras)


def tracked_frames(frames: DataFrame, sensors: DataFrame, config: AppConfig, cameras: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    points = K.track_points(flagged_frames(frames, sensors, config, cameras), config)
    as_of = F.lit(config.as_of).cast("timestamp") if config.as_of else F.current_timestamp()
    return points, K.filtered(K.behaviors(points), config, as_of)


def tracking_accuracy(frames: DataFrame, identities: DataFrame, sensors: DataFrame, truth: DataFrame, config: AppConfig) -> DataFrame:
    """Accuracy of global ids against multi-camera ground truth, for each camera and for all as one sequence (MTMC).

    ``identities``: global_id, sensor_id, object_id, start_frame, end_frame. Cameras of the truth are numbers and go by
    rank with the sensors' names. With ``use3dEvaluation`` ground positions are compared, each id once a frame over all
    cameras; with ``useFullBodyGroundTruth`` boxes reach to the foot point.
    """
    d = S.detections(frames)
    matched = identities.withColumn("match_order", F.col("global_id"))
    found = E.mot_prediction(d, matched.select("sensor_id", "object_id", "global_id", "start_frame", "end_frame", "match_order"), ["sensor_id", "object_id", "frame_id"], config.io.useFullBodyGroundTruth)
    names = R.positional_zip(truth, d, "CameraId", "sensor_id", "CameraId", "seq").select("CameraId", "seq")  # a row for each camera
    selected = list(config.io.selectedSensorIds)
    if selected:
        names = names.where(F.col("seq").isin(selected))
    real = truth.join(names, "CameraId").select("seq", F.col("FrameId").cast("long").alias("frame"), F.col("Id").cast("long").alias("id"), F.col("X").alias("x"), F.col("Y").alias("y"), F.col("Width").alias("w"), F.col("Height").alias("h"), "Xworld", "Yworld")
    pr = found.join(names.select(F.col("seq").alias("sensor_id")), "sensor_id")
    if config.io.use3dEvaluation:
        place = sensors.select("sensor_id", "homography")
        x, y = C.foot_point("left_x", "right_x", "bottom_y", F.col("info")["footLocation"] if config.io.useFullBodyGroundTruth else None)
        at = pr.join(place, "sensor_id").where("homography is not null").withColumn("at", C.project(x, y, F.col("homography")))
        one = F.lit("MTMC").alias("seq")
        at = at.select(one, F.col("frame_id").alias("frame"), F.col("global_id").cast("long").alias("id"), F.col("at.x").alias("x"), F.col("at.y").alias("y")).where("frame >= 1")
        mean = lambda side: side.groupBy("seq", "frame", "id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
        return E.evaluate(mean(real.select(one, "frame", "id", F.col("Xworld").alias("x"), F.col("Yworld").alias("y")).where("frame >= 1")), mean(at), "point")
    pr = pr.select(F.col("sensor_id").alias("seq"), F.col("frame_id").alias("frame"), F.col("global_id").cast("long").alias("id"), "x", "y", F.col("width").alias("w"), F.col("height").alias("h"))
    box = ["x", "y", "w", "h"]
    sides = [E.deduplicated(side.withColumn("row", F.struct(*box)), "row").select("seq", "frame", "id", *box) for side in (real, pr)]
    offsets = R.frame_offsets(sides[0].select("seq", "frame").unionByName(sides[1].select("seq", "frame")), "seq", "frame")
    return E.evaluate(*[side.unionByName(E.combined_sequence(side, offsets)) for side in sides])


def mtmc_batch(spark: SparkSession, lines: DataFrame, sensors: DataFrame, config: AppConfig) -> DataFrame:
    """Global identities of a batch's behaviors."""
    _, behaviors = tracked(spark, lines, sensors, config)
    return G.global_objects(behaviors.withColumn("batch", F.lit(config.io.batchId)), config, "batch")


def _scene_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines, sensors, truth = scene()
    return spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame(sensor_states(sensors), SENSOR_STATE), spark.createDataFrame(pd.DataFrame(truth))


def scene_identities(spark: SparkSession) -> DataFrame:
    """Identities of the synthetic scene."""
    lines, sensors, _ = _scene_frames(spark)
    return mtmc_batch(spark, lines, sensors, SCENE_CONFIG)


def scene_accuracy(spark: SparkSession) -> DataFrame:
    """Accuracy of the scene's ground positions against the true persons."""
    lines, sensors, truth = _scene_frames(spark)
    points, behaviors = tracked(spark, lines, sensors, SCENE_CONFIG)
    ids = G.global_objects(behaviors.withColumn("batch", F.lit("0")), SCENE_CONFIG, "batch").select("sensor_id", "object_id", "global_id")
    at = points.where("location is not null").select("sensor_id", "object_id", F.col("frame_id").alias("frame"), F.col("location.x").alias("x"), F.col("location.y").alias("y"))
    place = lambda ident, df: df.groupBy(F.lit("MTMC").alias("seq"), "frame", F.col(ident).cast("long").alias("id")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return E.evaluate(place("person", at.join(truth, ["sensor_id", "object_id"])), place("global_id", at.join(ids, ["sensor_id", "object_id"])), "point")


# The same over all events. A place is where five objects of neighbouring numbers move, as seen by all four cameras, so a
# place stays as large as it is however many events there are.
EVERY = AppConfig(
    preprocessing=PreprocessingConfig(
        locationBboxBottomGapThresh=-1.0, locationConfidenceThresh=0.0, locationBboxAreaThresh=0.0, locationBboxAspectRatioThresh=100.0, embeddingBboxBottomGapThresh=-1.0, embeddingConfidenceThresh=0.0, embeddingBboxAreaThresh=0.0,
        embeddingBboxAspectRatioThresh=100.0, behaviorConfidenceThresh=0.0, behaviorBboxAreaThresh=0.0, behaviorBboxAspectRatioThresh=100.0, behaviorSplitThreshSec=Q.GAP, behaviorRetentionInStateSec=3.0 * Q.DAY,
        mtmcPlusRetentionInStateSec=3.0 * Q.DAY, mtmcPlusInitBufferLenSec=1.0 * Q.DAY,
    ),
    clustering=SCENE_CONFIG.clustering,
    streaming=StreamingConfig(mtmcPlusFrameBatchSizeMs=6 * 3_600_000, mtmcPlusFrameBufferResetSec=10.0 * Q.DAY, mtmcPlusTimestampDelayMs=0, mtmcPlusLocationWindowSec=1.0 * Q.DAY, mtmcPlusSmoothingWindowSec=1.0 * Q.DAY),
)


def placed_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.floor(F.col("object_id").cast("long") / 5).cast("string")
    return N.flagged(spark, sf_dir, EVERY, whole=True).withColumn("place", F.concat(F.lit("g"), group))


@register
def e01_mtmc_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities of all tracklets of the events, a place at a time."""
    behaviors = K.filtered(K.behaviors(K.track_points(placed_detections(spark, sf_dir), EVERY)), EVERY)
    return G.global_objects(behaviors, EVERY, "place")


@register
def e02_mtmc_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of these identities against the objects, over all events, a place as a sequence."""
    points = K.track_points(placed_detections(spark, sf_dir), EVERY)
    ids = G.global_objects(K.filtered(K.behaviors(points), EVERY), EVERY, "place").select("place", "sensor_id", "object_id", "start", "end", F.col("global_id").alias("id"))
    box = [F.col("left_x").alias("x"), F.col("top_y").alias("y"), (F.col("right_x") - F.col("left_x")).alias("w"), (F.col("bottom_y") - F.col("top_y")).alias("h")]
    rows = points.select("place", "sensor_id", "object_id", "ts", F.col("place").alias("seq"), F.col("frame_id").alias("frame"), *box)
    found = rows.join(ids, ["place", "sensor_id", "object_id"]).where("ts between start and end").select("seq", "frame", "id", "x", "y", "w", "h")
    return E.evaluate(rows.select("seq", "frame", F.col("object_id").cast("long").alias("id"), "x", "y", "w", "h"), found)


@register
def e03_rtls_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations over all events, batch of frames by batch, with a tracker for each place."""
    return V.replay_locations(V.live_points(placed_detections(spark, sf_dir)), EVERY)


@register
def e04_appearance_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters of the vectors of each label's half."""
    v = Q.vectors(spark, sf_dir).withColumn("part", F.col("label") % 2)
    return G.cluster_detections(v, "part", "vec_id", 5)


@register
def e05_stream_tracklets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap segments of the events as a stream, by state for each behavior."""
    from ..streaming.state import stream_tracklets

    out = run_stream(spark, sf_dir, lambda p: stream_tracklets(p.select(C.behavior_id("sensor_id", "user_id").alias("id"), "ts"), Q.GAP), ["id", "segment"])
    return out.select("id", "segment", "start_us", "end_us", "n")


ORACLES["e05_stream_tracklets"] = f"with {Q.SEG}\nselect sensor_id || ' #-# ' || object_id as id, segment, epoch_us(s) as start_us, epoch_us(e) as end_us, n from trk"


@register
def e06_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour counts of the events as a stream."""
    from ..streaming.state import windowed_counts

    out = run_stream(spark, sf_dir, lambda p: windowed_counts(p, late="30 days"), ["sensor_id", "w"])
    return out.select("sensor_id", F.unix_micros("w.start").alias("bucket_us"), "n")


ORACLES["e06_stream_windows"] = f"with {Q.DET}\nselect sensor_id, epoch_us(time_bucket(interval 6 hour, ts)) as bucket_us, count(*) as n from det group by all"


def run_stream(spark: SparkSession, sf_dir: str, plan, keys: list[str], mode: str = "update") -> DataFrame:
    """Run a plan over the events as a stream until all is read; of each key the row of the latest batch.

    Every batch is written to the shared folder under its own number, so one that runs twice is there once.
    """
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(path if _is_folder(spark, path) else sf_dir + "/events.parque[t]")
    points = stream.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("sensor_id", F.concat(F.lit("cam"), (F.col("event_id") % 4).cast("string")))
    made, folder = plan(points), fresh_folder(spark, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    made.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(made.schema.add("batch", "long")).parquet(f"{folder}/rows")
    return R.latest(rows, keys, [F.col("batch").desc()]).drop("batch")


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
