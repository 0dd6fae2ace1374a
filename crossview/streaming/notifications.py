"""Control messages: calibration and settings that change while streams run.

Messages are Kafka rows (key, value, headers). Which keys they have is a
parameter, as producers differ. A feed keeps the newest notice of every sensor
and the settings after all notices in a folder, a version for each batch;
streams read the newest version at each batch of theirs.
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig, updated
from ..operators.calibration import sensor_states
from ..schema import SENSOR_STATE
from . import state as S

# Headers and kinds of events.
HEADERS = ("event.type", "timestamp")
EVENTS = {"calibration": ("upsert-all", "upsert", "delete"), "config": ("upsert-all", "upsert")}
_REGISTRY = "sensor_id string, ts timestamp, event string, sensor string"


def parsed(messages: DataFrame, calibration_key: str = "calibration", config_key: str = "analytics-config") -> DataFrame:
    """(kind, event, ts, body) of the messages with a known key; an undefined header or event, or none, is an error."""
    key = F.col("key").cast("string")
    d = messages.select(F.when(key == calibration_key, "calibration").when(key == config_key, "config").alias("kind"), F.col("value").cast("string").alias("body"), "headers").where("kind is not null")
    header = lambda name: F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string")
    event, ts = header(HEADERS[0]), header(HEADERS[1])
    known = F.when(F.col("kind") == "calibration", event.isin(*EVENTS["calibration"])).otherwise(event.isin(*EVENTS["config"]))
    strange = F.exists("headers", lambda h: ~h["key"].isin(*HEADERS))
    fault = F.when(F.coalesce(strange, F.lit(False)), "a header is not defined").when(event.isNull() | ts.isNull(), "event type or timestamp is missing").when(~known, "the event type is not defined")
    checked = F.when(fault.isNull(), event).otherwise(F.raise_error(F.concat(fault, F.lit(": "), F.coalesce(event, F.lit("")))).cast("string"))
    return d.select("kind", checked.alias("event"), F.to_timestamp(ts).alias("ts"), "body")


def sensor_notices(notices: DataFrame) -> DataFrame:
    """(sensor_id, ts, event, sensor as JSON) of the calibration notices."""
    each = notices.where("kind = 'calibration'").select("event", "ts", F.explode(F.from_json("body", "sensors array<string>")["sensors"]).alias("sensor"))
    return each.select(F.get_json_object("sensor", "$.id").alias("sensor_id"), "ts", "event", "sensor")


def config_after(config: AppConfig, notices: DataFrame) -> AppConfig:
    """Settings after all config notices in order of time; empty ones change nothing, ``io`` and ``streaming`` never change."""
    for r in notices.where("kind = 'config'").orderBy("ts").select("body").collect():  # a few settings each
        if r.body and r.body.strip():
            config = updated(config, json.loads(r.body))
    return config


def requests(spark: SparkSession, config: AppConfig, topic: str, config_key: str = "analytics-config") -> DataFrame:
    """Kafka rows that ask for calibration and settings, and that tell the settings in use."""
    own = {k: v for k, v in dataclasses.asdict(config).items() if k in ("preprocessing", "localization", "clustering")}
    rows = [("request-calibration", "", topic), (f"request-{config_key}", "", topic), (f"init-{config_key}", json.dumps(own), topic)]
    return spark.createDataFrame(rows, "key string, value string, topic string")


@dataclass
class ControlFeed:
    """Sensors and settings as they stand; ``folder`` is a shared one."""

    spark: SparkSession
    folder: str
    base: AppConfig

    def _newest(self) -> int:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/config")
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = [p.getPath() for p in store.listStatus(path)] if store.exists(path) else []
        return max([int(p.getName()[1:]) for p in done if store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))], default=-1)

    def _registry(self, version: int) -> DataFrame:
        return self.spark.createDataFrame([], _REGISTRY) if version < 0 else self.spark.read.schema(_REGISTRY).parquet(f"{self.folder}/sensors/v{version}")

    def process(self, messages: DataFrame, batch_id: int, **keys: str) -> None:
        """One batch of control messages. Settings are written last: they make the batch count."""
        before = min(self._newest(), batch_id - 1)
        notices = parsed(messages, **keys)
        merged = S.sensor_registry(self._registry(before), sensor_notices(notices))
        merged.write.mode("overwrite").parquet(f"{self.folder}/sensors/v{batch_id}")
        config = config_after(self.config(before), notices)
        own = {k: v for k, v in dataclasses.asdict(config).items() if k in ("preprocessing", "localization", "clustering")}
        self.spark.createDataFrame([(json.dumps(own),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/config/v{batch_id}")

    def config(self, version: int | None = None) -> AppConfig:
        version = self._newest() if version is None else version
        if version < 0:
            return self.base
        return updated(self.base, json.loads(self.spark.read.text(f"{self.folder}/config/v{version}").first().value))

    def sensors(self) -> DataFrame | None:
        """The live sensors as states; None before the first notice. A row for each camera."""
        version = self._newest()
        if version < 0:
            return None
        rows = [json.loads(r.sensor) for r in S.live_sensors(self._registry(version)).where("sensor is not null").collect()]
        return self.spark.createDataFrame(sensor_states(rows), SENSOR_STATE) if rows else None

    def start(self, stream: DataFrame, checkpoint: str, **keys: str):
        return stream.writeStream.foreachBatch(lambda df, i: self.process(df, i, **keys) if not df.isEmpty() else None).option("checkpointLocation", checkpoint).start()
