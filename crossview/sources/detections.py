"""Readers of detection logs and their text formats; all but the wire format are Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AppConfig
from ..functions import columns as C
from ..operators.relations import next_fill
from ..schema import FRAME, GROUND_TRUTH, OBJECT

_RAW = T.StructType().add("version", "string").add("id", "string").add("@timestamp", "string").add("sensorId", "string").add("objects", T.ArrayType(T.StringType()))
_BOX_SCHEMA = "struct<leftX:double,topY:double,rightX:double,bottomY:double>"
_WIRE_JSON = f"version string, id string, timestamp string, sensorId string, objects array<struct<id:string,bbox:{_BOX_SCHEMA},type:string,confidence:double,info:map<string,string>,embedding:struct<vector:array<double>>>>"


def _numbers(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: x.try_cast("double"))


def object_tokens(token: Column) -> Column:
    """An object from its pipe-separated text; the blocks after ``embedding`` and ``SV3DT`` are found by these names.

    A token without ``#`` at its place is an error, as nothing after it can be trusted.
    """
    parts = F.split(token, r"\|")
    at = lambda k: F.get(parts, F.lit(k))
    after = lambda name, k=1: F.when(F.array_position(parts, name) > 0, F.get(parts, (F.array_position(parts, name) - 1 + k).cast("int")))
    number = lambda c: c.try_cast("double")
    info = F.map_filter(
        F.create_map(
            *[x for k, name in enumerate(("gender", "age", "hair", "cap", "apparel"), 7) for x in (F.lit(name), at(k))],
            *[x for k, name in enumerate(("visibility", "footLocation", "footLocation3D", "convexHull"), 1) for x in (F.lit(name), after("SV3DT", k))],
        ),
        lambda k, v: v.isNotNull(),
    )
    confidence = F.when(at(12).isin("embedding", "SV3DT"), F.lit(None)).otherwise(number(at(12)))
    made = F.struct(
        at(0).alias("id"),
        F.struct(number(at(1)).alias("leftX"), number(at(2)).alias("topY"), number(at(3)).alias("rightX"), number(at(4)).alias("bottomY")).alias("bbox"),
        at(5).alias("type"),
        F.coalesce(confidence, F.lit(1.0)).alias("confidence"),
        info.alias("info"),
        _numbers(after("embedding")).alias("embedding"),
    )
    return F.when(at(6) == "#", made).otherwise(F.raise_error(F.concat(F.lit("object without '#': "), F.coalesce(token, F.lit("null")))))


def _log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.length(F.trim("value")) > 0)


def _parsed(value: Column, schema: str | T.StructType) -> Column:
    """A line as JSON; a line that is none as it stands is read with ' for "."""
    first = F.from_json(value, schema)
    named = F.coalesce(first["id"], first["sensorId"])
    return F.when(named.isNotNull(), first).otherwise(F.from_json(F.replace(value, F.lit("'"), F.lit('"')), schema))


def frames_from_text(lines: DataFrame, config: AppConfig | None = None) -> DataFrame:
    """Frames of persons from lines whose objects are pipe-separated texts; embeddings get unit length."""
    ids = list((config or AppConfig()).io.selectedSensorIds)
    raw = lines.select(_parsed(F.col("value"), _RAW).alias("r")).where("r is not null")
    if ids:
        raw = raw.where(F.col("r.sensorId").isin(ids))
    person = F.filter(F.col("r.objects"), lambda o: F.get(F.split(o, r"\|"), F.lit(5)) == "Person")
    unit = lambda o: o.withField("embedding", C.normalized(o["embedding"]))
    return raw.select(F.col("r.version").alias("version"), F.col("r.id").alias("id"), F.to_timestamp("r.`@timestamp`").alias("timestamp"), F.col("r.sensorId").alias("sensorId"), F.transform(person, lambda o: unit(object_tokens(o))).alias("objects"))


def read_frames(spark: SparkSession, path: str, config: AppConfig | None = None) -> DataFrame:
    return frames_from_text(_log_lines(spark, path), config)


def frames_from_wire_json(lines: DataFrame, config: AppConfig | None = None) -> DataFrame:
    """Frames from the JSON form of wire messages; lines of the robot feed are left out, embeddings stay as they are."""
    ids = list((config or AppConfig()).io.selectedSensorIds)
    rows = lines.where(F.get_json_object("value", "$.locationsOfObjects").isNull()).select(_parsed(F.col("value"), _WIRE_JSON).alias("r")).where("r is not null")
    if ids:
        rows = rows.where(F.col("r.sensorId").isin(ids))
    plain = F.transform(
        F.col("r.objects"),
        lambda o: F.struct(o["id"].alias("id"), o["bbox"].alias("bbox"), o["type"].alias("type"), o["confidence"].alias("confidence"), o["info"].alias("info"), o["embedding"]["vector"].alias("embedding")),
    )
    return rows.select(F.col("r.version").alias("version"), F.col("r.id").alias("id"), F.to_timestamp("r.timestamp").alias("timestamp"), F.col("r.sensorId").alias("sensorId"), plain.alias("objects"))


def read_wire_json(spark: SparkSession, path: str, config: AppConfig | None = None) -> DataFrame:
    return frames_from_wire_json(_log_lines(spark, path), config)


def read_input(spark: SparkSession, config: AppConfig, path: str | None = None) -> DataFrame:
    """Frames of a log: at ``path``, at ``jsonDataPath``, or of wire messages as JSON at ``protobufDataPath``."""
    if path or config.io.jsonDataPath:
        return read_frames(spark, path or config.io.jsonDataPath, config)
    if config.io.protobufDataPath:
        return read_wire_json(spark, config.io.protobufDataPath, config)
    raise ValueError("neither a path nor jsonDataPath nor protobufDataPath is set")


def read_sequence_map(spark: SparkSession, path: str) -> DataFrame:
    """The names of a sequence map."""
    return _log_lines(spark, path).where(F.trim("value") != "name").select(F.trim("value").alias("seq"))


def read_sequence_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(seq, length) of the sequence descriptions (ini files) below a path."""
    pair = F.split(F.trim("value"), r"\s*=\s*")
    lines = spark.read.text(path, wholetext=False).select(F.col("_metadata.file_path").alias("file"), F.get(pair, F.lit(0)).alias("k"), F.get(pair, F.lit(1)).alias("v"))
    take = lambda k: F.max(F.when(F.lower("k") == k, F.col("v")))
    return lines.groupBy("file").agg(take("name").alias("seq"), take("seqlength").cast("long").alias("length")).select("seq", "length")


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = raw[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(raw: bytes):
    """(number, value) of a message's fields: integers, 4 or 8 raw bytes, or bytes."""
    at = 0
    while at < len(raw):
        tag, at = _varint(raw, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(raw, at)
        elif kind == 2:
            n, at = _varint(raw, at)
            value, at = raw[at : at + n], at + n
        else:
            n = 4 if kind == 5 else 8
            value, at = raw[at : at + n], at + n
        yield tag >> 3, value


def decode_message(raw: bytes) -> dict:
    """A frame from its wire message: times cut to milliseconds, a confidence of 0 read as 1, unit embeddings."""
    import struct

    import numpy as np

    number = lambda v: struct.unpack("<f", v)[0]
    frame = {"version": "", "id": "", "timestamp": None, "sensorId": "", "objects": []}
    for k, v in _fields(raw):
        if k in (1, 2, 4):
            frame[{1: "version", 2: "id", 4: "sensorId"}[k]] = v.decode()
        elif k == 3:
            t = dict(_fields(v))
            frame["timestamp"] = t.get(1, 0) * 1000 + t.get(2, 0) // 1_000_000
        elif k == 5:
            o = {"id": "", "bbox": dict.fromkeys(("leftX", "topY", "rightX", "bottomY"), 0.0), "type": "", "confidence": 1.0, "info": {}, "embedding": None}
            for j, x in _fields(v):
                if j in (1, 3):
                    o["id" if j == 1 else "type"] = x.decode()
                elif j == 2:
                    o["bbox"].update({("leftX", "topY", "rightX", "bottomY")[i - 1]: number(y) for i, y in _fields(x)})
                elif j == 4:
                    o["confidence"] = number(x) or 1.0
                elif j == 5:
                    entry = dict(_fields(x))
                    o["info"][entry.get(1, b"").decode()] = entry.get(2, b"").decode()
                elif j == 6:
                    vector = np.concatenate([np.frombuffer(y, "<f4") for i, y in _fields(x) if i == 1] or [np.empty(0)]).astype(float)
                    n = np.linalg.norm(vector)
                    o["embedding"] = (vector / n).tolist() if n else None
            frame["objects"].append(o)
    return frame


def encode_message(frame: dict) -> bytes:
    """The wire message of a frame (as :func:`decode_message` gives it), for producers and tests."""
    import struct

    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    block = lambda k, raw: varint(k << 3 | 2) + varint(len(raw)) + raw
    text = lambda k, x: block(k, str(x).encode())
    single = lambda k, x: varint(k << 3 | 5) + struct.pack("<f", x)
    whole = lambda k, n: varint(k << 3) + varint(n)
    millis = frame["timestamp"]
    out = text(1, frame["version"]) + text(2, frame["id"]) + block(3, whole(1, millis // 1000) + whole(2, millis % 1000 * 1_000_000)) + text(4, frame["sensorId"])
    for o in frame["objects"]:
        box = b"".join(single(i, o["bbox"][k]) for i, k in enumerate(("leftX", "topY", "rightX", "bottomY"), 1))
        body = text(1, o["id"]) + block(2, box) + text(3, o["type"]) + single(4, o["confidence"])
        body += b"".join(block(5, text(1, k) + text(2, v)) for k, v in o["info"].items())
        if o["embedding"]:
            body += block(6, block(1, struct.pack(f"<{len(o['embedding'])}f", *o["embedding"])))
        out += block(5, body)
    return out


def frames_from_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Frames from binary wire messages, decoded in Arrow batches."""
    schema = T.StructType([*FRAME.fields[:2], T.StructField("millis", T.LongType()), FRAME.fields[3], T.StructField("objects", T.ArrayType(OBJECT))])

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = [decode_message(bytes(v)) for v in b[column] if v is not None]
            yield pd.DataFrame({"version": [r["version"] for r in rows], "id": [r["id"] for r in rows], "millis": [r["timestamp"] for r in rows], "sensorId": [r["sensorId"] for r in rows], "objects": [r["objects"] for r in rows]})

    out = messages.select(column).mapInPandas(run, schema)
    return out.select("version", "id", F.timestamp_millis("millis").alias("timestamp"), "sensorId", "objects")


def detections(frames: DataFrame) -> DataFrame:
    """A row for each object of each frame."""
    o = F.col("o")
    return frames.select("sensorId", "id", "timestamp", F.explode("objects").alias("o")).select(
        F.col("sensorId").alias("sensor_id"), o["id"].alias("object_id"), o["type"].alias("object_type"), F.col("timestamp").alias("ts"), F.col("id").cast("long").alias("frame_id"),
        o["bbox"]["leftX"].alias("left_x"), o["bbox"]["topY"].alias("top_y"), o["bbox"]["rightX"].alias("right_x"), o["bbox"]["bottomY"].alias("bottom_y"),
        o["confidence"].alias("confidence"), o["info"].alias("info"), o["embedding"].alias("embedding"),
    )


def _split_numbers(lines: DataFrame, separators: str, columns: list[str]) -> DataFrame:
    parts = F.split(F.trim("value"), separators)
    return lines.select(*[F.get(parts, F.lit(i)).try_cast("double").alias(c) for i, c in enumerate(columns)])


def ground_truth_rows(lines: DataFrame, config: AppConfig | None = None) -> DataFrame:
    """Multi-camera ground truth, columns parted by blanks, tabs or commas; frames are moved by ``groundTruthFrameIdOffset``."""
    rows = _split_numbers(lines, r"[\s,]+", [f.name for f in GROUND_TRUTH.fields])
    return rows.withColumn("FrameId", F.col("FrameId") + (config.io.groundTruthFrameIdOffset if config else 0))


def read_ground_truth(spark: SparkSession, path: str | None = None, config: AppConfig | None = None) -> DataFrame:
    """The ground truth of a file, by default that of ``groundTruthPath``."""
    return ground_truth_rows(_log_lines(spark, path or config.io.groundTruthPath), config)


def mot_rows(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Per-sequence rows with any of the usual separators; rows with a negative id are left out."""
    rows = _split_numbers(lines, r"[\s,;]+", columns)
    return rows.where(F.col(columns[1]) >= 0) if len(columns) > 1 else rows


def read_mot_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return mot_rows(_log_lines(spark, path), columns)


def rtls_rows(lines: DataFrame) -> DataFrame:
    """Location rows from lines that may be wrapped as b'...'."""
    line = F.regexp_replace("value", r"^b'(.*)'$", "$1")
    return lines.select(line.alias("value")).select(F.get_json_object("value", "$.frameId").cast("long").alias("frame_id"), F.to_timestamp(F.get_json_object("value", "$.timestamp")).alias("ts"), "value")


def read_rtls_log(spark: SparkSession, path: str) -> DataFrame:
    return rtls_rows(_log_lines(spark, path))


def robot_frames(lines: DataFrame, order: str, bin_of: Column | None = None) -> DataFrame:
    """Robot lines of a mixed log, each with the frame id of the next person line; ``lines`` has log, order and value.

    ``bin_of`` deals a log's lines out, as in :func:`~crossview.operators.relations.next_fill`. Each line is parsed before that.
    """
    own = F.get_json_object("value", "$.locationsOfObjects")
    parsed = lines.withColumns({"_robot": own.isNotNull(), "_person": F.when(own.isNull(), F.get_json_object("value", "$.id").cast("long"))})
    return next_fill(parsed, ["log"], order, "_person", "frame_id", bin_of).where("_robot").drop("_robot", "_person")


def crossing_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with a crossing object, and all others."""
    crossed = F.col("value").contains("Crossed")
    return lines.where(crossed), lines.where(~F.coalesce(crossed, F.lit(False)))


def person_first(lines: DataFrame) -> DataFrame:
    """Messages whose first object names a person."""
    return lines.where(F.lower(F.get_json_object("value", "$.objects[0]")).contains("person"))


def crossing_ids(frames_text: DataFrame) -> DataFrame:
    """Distinct ids of crossing objects."""
    o = frames_text.select(F.explode(F.from_json("value", _RAW)["objects"]).alias("o")).where(F.col("o").contains("Crossed"))
    return o.select(F.split("o", r"\|")[0].alias("object_id")).distinct()


def frames_with_ids(frames: DataFrame, ids: DataFrame) -> DataFrame:
    """Frames with some object of the id table."""
    keyed = frames.withColumn("_frame", F.struct("sensorId", "id", "timestamp"))
    hits = keyed.select("_frame", F.explode("objects.id").alias("object_id")).join(ids, "object_id", "left_semi").select("_frame").distinct()
    return keyed.join(hits, "_frame", "left_semi").drop("_frame")


def kafka_options(config: AppConfig, topic: str, notifications: bool = False) -> dict[str, str]:
    """What the streaming settings say to Spark's Kafka reader."""
    s = config.streaming
    wait = s.kafkaNotificationConsumerPollTimeoutMs if notifications else s.kafkaRawConsumerPollTimeoutMs
    return {
        "kafka.bootstrap.servers": s.kafkaBootstrapServers, "subscribe": topic, "startingOffsets": "latest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(s.kafkaConsumerMaxRecordsPerPoll), "kafkaConsumer.pollTimeoutMs": str(wait), "includeHeaders": str(notifications).lower(),
    }


def configured_stream(spark: SparkSession, config: AppConfig, topic: str, notifications: bool = False) -> DataFrame:
    """A topic as the settings describe it; needs Spark's Kafka connector among the jars."""
    return spark.readStream.format("kafka").options(**kafka_options(config, topic, notifications)).load()


def replay_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Logs of a folder as a stream of lines, a few files a batch."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)


def replay_buckets(frames: DataFrame, width_ms: int = 200) -> DataFrame:
    """Number buckets of ``width_ms`` by a log's first frame."""
    first = frames.agg(F.min("timestamp").alias("_first"))
    return frames.crossJoin(F.broadcast(first)).withColumn("bucket", F.floor((F.unix_millis("timestamp") - F.unix_millis("_first")) / width_ms)).drop("_first")
