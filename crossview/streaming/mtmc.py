"""Global identities over a stream of detections: micro-batches on state tables.

Each micro-batch appends its detections to the live segments, evicts old ones,
clusters all live behaviors anew, and gives clusters the ids that their members
held before. State holds boxes, never places: these are made of the sensors as
they are at each batch, so a new calibration moves old points as well. State is a version of two tables in a folder; a batch reads the
version before it and writes its own, so a repeated batch gives the same state.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig, clock
from ..operators import clustering as G
from ..operators import tracks as K
from . import state as S
from .notifications import ControlFeed

_HELD = "key string, global_id long, since timestamp"


@dataclass
class MtmcStream:
    """``sensors``: the sensor dimension; ``folder``: where state and results go (a shared folder on a cluster).

    With ``control`` a batch takes sensors and settings as that feed has them by then.
    """

    spark: SparkSession
    sensors: DataFrame
    config: AppConfig
    folder: str
    control: ControlFeed | None = None

    def _read(self, name: str, version: int, schema: str) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.folder}/{name}/v{version}")

    def _version(self) -> int:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/held")
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = [p.getPath() for p in store.listStatus(path)] if store.exists(path) else []
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return max([int(p.getName()[1:]) for p in done if store.exists(jpath(p, "_SUCCESS"))], default=-1)

    def process(self, detections: DataFrame, batch_id: int) -> None:
        """One micro-batch of detections (as ``sources.detections`` gives them)."""
        before = min(self._version(), batch_id - 1)
        config, sensors = self.config, self.sensors
        if self.control is not None:
            config, sensors = self.control.config(), self.control.sensors() or sensors
        points = detections.withColumn("id", F.concat_ws(" #-# ", "sensor_id", "object_id"))
        schema = points.withColumn("segment", F.lit(0).cast("long")).schema
        old = self.spark.createDataFrame([], schema) if before < 0 else self.spark.read.schema(schema).parquet(f"{self.folder}/points/v{before}")
        merged = S.merge_points(old, points, config.preprocessing.behaviorSplitThreshSec)
        live, _ = S.evict(merged, config.preprocessing.behaviorRetentionInStateSec, clock(config))
        live.write.mode("overwrite").parquet(f"{self.folder}/points/v{batch_id}")
        live = self.spark.read.schema(schema).parquet(f"{self.folder}/points/v{batch_id}")
        placed = K.with_flags(live, sensors, config).where("in_roi")
        thin = K.downsample(placed, ["id", "segment"], config.preprocessing.behaviorNumLocationsMax, ["ts", "frame_id"])
        newest = live.agg(F.max("ts")).first()[0]
        behaviors = K.filtered(K.behaviors(thin), config, F.lit(newest).cast("timestamp"))
        rows = G.global_objects(behaviors.withColumn("batch", F.lit(str(batch_id))), config, "batch").toPandas()
        held = self._read("held", before, _HELD).toPandas()
        by_key: dict[str, dict[int, pd.Timestamp]] = {}
        for r in held.itertuples():
            by_key.setdefault(r.key, {})[int(r.global_id)] = r.since
        clusters = [{"cluster": int(k), "members": sorted(g.key), "start": g.start.min()} for k, g in rows.groupby("global_id")]
        named, _ = S.continue_ids(clusters, by_key, int(held.global_id.max()) + 1 if len(held) else 1)
        since = {int(r.global_id): r.since for r in held.itertuples()}
        now = [(k, c["global_id"], since.get(c["global_id"], c["start"])) for c in named for k in c["members"]]
        keys = {k for k, _, _ in now}
        alive = set(rows.key)
        kept = [(r.key, int(r.global_id), r.since) for r in held.itertuples() if r.key not in keys and r.key in alive]
        out = pd.DataFrame(now + kept, columns=["key", "global_id", "since"])
        objects = pd.DataFrame([(c["global_id"], len(c["members"]), json.dumps(c["members"])) for c in named], columns=["global_id", "n_matched", "members"])
        self.spark.createDataFrame(objects, "global_id long, n_matched long, members string").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{self.folder}/objects/v{batch_id}")
        self.spark.createDataFrame(out, _HELD).write.mode("overwrite").parquet(f"{self.folder}/held/v{batch_id}")  # last: it makes the batch count

    def start(self, stream: DataFrame, checkpoint: str, seconds: float | None = None):
        """Run on a stream of detections: at an interval (0: that of the settings), or over all that is there."""
        seconds = self.config.streaming.kafkaMicroBatchIntervalSec if seconds == 0 else seconds
        w = stream.writeStream.foreachBatch(lambda df, i: self.process(df, i) if not df.isEmpty() else None).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=f"{seconds} seconds") if seconds else w.trigger(availableNow=True)).start()

    def objects(self) -> DataFrame:
        """The newest batch's objects."""
        return self.spark.read.parquet(f"{self.folder}/objects/v{self._version()}")
