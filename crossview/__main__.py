"""Command line: python -m crossview mtmc-batch|rtls-batch|evaluate --config ... --calibration ... --input ... --output ..."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import AppConfig, load_config
from .operators import clustering as G
from .operators import evaluation as E
from .operators.calibration import calibrate
from .plans.pipelines import flagged_frames, tracked_frames, tracking_accuracy
from .session import ship_package
from .sources import detections as S
from .sources import sinks as W
from .streaming.live import live_points, replay_locations


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="crossview", description=__doc__)
    p.add_argument("command", choices=["mtmc-batch", "rtls-batch", "evaluate"])
    p.add_argument("--config", help="JSON settings")
    p.add_argument("--calibration", help="calibration JSON")
    p.add_argument("--input", help="detection log (default: the settings' path); for evaluate: the MOT rows of the prediction")
    p.add_argument("--ground-truth", help="the MOT rows of the truth; for mtmc-batch multi-camera truth (default: the settings' path), which adds accuracy")
    p.add_argument("--output", required=True, help="folder for the result, as JSON lines")
    a = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship_package(spark)
    config = load_config(json.loads(Path(a.config).read_text())) if a.config else AppConfig()
    if a.command == "evaluate":
        columns = ["FrameId", "Id", "X", "Y", "Width", "Height"]
        rows = lambda path: S.read_mot_rows(spark, path, columns).select(F.lit("all").alias("seq"), F.col("FrameId").cast("long").alias("frame"), F.col("Id").cast("long").alias("id"), F.col("X").alias("x"), F.col("Y").alias("y"), F.col("Width").alias("w"), F.col("Height").alias("h"))
        out = E.summary(E.evaluate(rows(a.ground_truth), rows(a.input)))
    else:
        frames, sensors = S.read_input(spark, config, a.input), calibrate(spark, a.calibration)
        text = "\n".join(r.value for r in spark.read.text(a.calibration, wholetext=True).collect())
        cameras = json.loads(text)["sensors"]
        W.debug_dump(frames, "frames", config)
        if a.command == "mtmc-batch":
            _, behaviors = tracked_frames(frames, sensors, config, cameras)
            W.debug_dump(behaviors, "behaviors", config)
            ids = G.global_objects(behaviors.withColumn("batch", F.lit(config.io.batchId)), config, "batch")
            out = G.mtmc_objects(ids, "batch")
            if a.ground_truth or config.io.groundTruthPath:
                segments = ids.join(behaviors.select("key", "start_frame", "end_frame"), "key")
                truth = S.read_ground_truth(spark, a.ground_truth, config)
                E.summary(tracking_accuracy(frames, segments, sensors, truth, config)).write.mode("overwrite").json(f"{a.output.rstrip('/')}-accuracy")
        else:
            out = replay_locations(live_points(flagged_frames(frames, sensors, config, cameras)), config)
        W.debug_dump(out, a.command, config)
    out.write.mode("overwrite").json(a.output)


if __name__ == "__main__":
    main()
