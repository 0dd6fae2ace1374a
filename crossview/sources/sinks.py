"""Writers and message shapes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AppConfig


def mtmc_messages(objects: DataFrame, sensors: DataFrame, recorder: str, topic: str = "mtmc") -> DataFrame:
    """Kafka rows of global objects: nulls and keys of members left out, frame ids kept for sensors whose source is ``recorder`` only.

    ``objects``: global_id, object_type, start, end, matched (array of structs with sensor_id, key, start_frame, end_frame);
    ``sensors``: sensor_id, source.
    """
    recorders = sensors.where(F.col("source") == recorder).agg(F.collect_set("sensor_id").alias("_recorders"))
    d = objects.crossJoin(F.broadcast(recorders))
    recorded = lambda m: F.array_contains("_recorders", m["sensor_id"])
    matched = F.transform("matched", lambda m: m.dropFields("key").withField("start_frame", F.when(recorded(m), m["start_frame"])).withField("end_frame", F.when(recorded(m), m["end_frame"])))
    body = F.to_json(F.struct(F.col("global_id").alias("globalId"), F.col("object_type").alias("objectType"), F.col("start").alias("timestamp"), "end", matched.alias("matched")), {"ignoreNullFields": "true"})
    return d.select(F.col("global_id").cast("string").alias("key"), body.alias("value"), F.lit(topic).alias("topic"))


def rtls_messages(rows: DataFrame, debug: bool = False, dynamic: bool = True, send_empty: bool = True, topic: str = "rtls") -> DataFrame:
    """Kafka rows of locations: matched keys left out, ids of shadows too if ids are updated on the way."""
    keep = F.filter("locationsOfObjects", lambda o: o["id"].cast("long") >= 0) if dynamic else F.col("locationsOfObjects")
    d = rows.withColumn("locationsOfObjects", F.transform(keep, lambda o: o.dropFields("matchedBehaviorKeys")))
    if not send_empty:
        d = d.where(F.size("locationsOfObjects") > 0)
    columns = [c for c in d.columns if debug or c != "frameId"]
    return d.select(F.col("place").alias("key"), F.to_json(F.struct(*columns), {"ignoreNullFields": "true"}).alias("value"), F.lit(topic).alias("topic"))


def write_kafka(messages: DataFrame, servers: str, linger_ms: int = 0) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.linger.ms", linger_ms).save()


def write_configured(messages: DataFrame, config: AppConfig) -> None:
    """Messages to the servers that the settings name."""
    write_kafka(messages, config.streaming.kafkaBootstrapServers, config.streaming.kafkaProducerLingerMs)


def debug_dump(rows: DataFrame, name: str, config: AppConfig) -> None:
    """With ``enableDebug`` a table as JSON lines below ``outputDirPath``, in a folder for the batch."""
    if config.io.enableDebug:
        rows.write.mode("overwrite").json(f"{config.io.outputDirPath.rstrip('/')}/{sanitized(name)}/batch={sanitized(config.io.batchId)}")


def sequence_map(sequences: DataFrame) -> DataFrame:
    """Lines of a sequence map: a heading, then each name, in order (``sequences``: seq)."""
    names = sequences.select(F.col("seq").alias("value")).distinct().withColumn("_k", F.lit(1))
    head = sequences.sparkSession.createDataFrame([("name", 0)], "value string, _k int")
    return head.unionByName(names).orderBy("_k", "value").select("value")


def sequence_description(name: str, length: int, fps: int = 30, width: int = 1920, height: int = 1080) -> str:
    """The text of a sequence's description file."""
    return "\n".join(["[Sequence]", f"name={name}", f"seqLength={length}", f"frameRate={fps}", f"imWidth={width}", f"imHeight={height}", ""])


def write_mot_rows(rows: DataFrame, path: str) -> None:
    """Blank-separated rows without a header."""
    rows.write.mode("overwrite").csv(path, sep=" ", header=False)


def split_by_sensor(lines: DataFrame, path: str) -> None:
    """One folder for each sensor; lines without a sensor are left out."""
    named = lines.withColumn("sensorId", F.get_json_object("value", "$.sensorId"))
    named.where("sensorId is not null and sensorId <> ''").write.mode("overwrite").partitionBy("sensorId").text(path)


def without_empty_sensors(lines: DataFrame) -> DataFrame:
    return lines.where(F.coalesce(F.get_json_object("value", "$.sensorId"), F.lit("")) != "")


def sanitized(text: str) -> str:
    """Letters, digits, blanks and ._- only."""
    return re.sub(r"[^\w\s.\-]", "", text)


def valid_path(path: str) -> bool:
    return bool(re.fullmatch(r"[\w\-./ :]+", path)) and ".." not in path.split("/")
