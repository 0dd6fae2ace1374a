"""Queries that run the engine's sources, tracks, live locations, evaluation and tables over all events, with their SQL twins.

The events stand for detections of four cameras; the log lines, messages and
rows that the readers take are made of them first.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig, IOConfig, PreprocessingConfig
from ..functions import columns as C
from ..operators import evaluation as E
from ..operators import relations as R
from ..operators import tables as TB
from ..operators import tracks as K
from ..schema import SENSOR_STATE
from ..sources import detections as S
from ..sources import sinks as W
from ..streaming import live as V
from ..streaming import state as ST
from .catalogue import BOX, DAY, DET, GAP, HEIGHT, ROI, SEG, WIDTH, H, det, placed, query, segmented, tracklets, us
from .catalogue import _HOM as HOM

#: Lines of a log that are looked through together.
LINES = 65536
text = lambda c: F.col(c).cast("string")
AREA = (2.0, 4.0), (14.0, 5.0), (13.0, 18.0), (3.0, 17.0)


# Sources.
def log_lines(s: SparkSession, d: str) -> DataFrame:
    """A log line for each event; those of views are no persons, those of clicks carry a crossing."""
    token = F.concat_ws(
        "|", text("object_id"), text("lx"), text("ty"), text("rx"), text("bottom"), F.when(F.col("event_type") == "view", "Car").otherwise("Person"), F.lit("#|m|30|brown|none"),
        F.when(F.col("event_type") == "click", "Crossed").otherwise("shirt"), ((F.col("event_id") % 100) / 128).cast("string"), F.lit("embedding|3,4"),
    )
    line = F.struct(F.lit("4.0").alias("version"), text("event_id").alias("id"), C.iso_millis("ts").alias("@timestamp"), F.col("sensor_id").alias("sensorId"), F.array(token).alias("objects"))
    return det(s, d).select("event_id", "sensor_id", "event_type", F.to_json(line).alias("value"))


@query("select sensor_id, cast(object_id as varchar) as object_id, 'Person' as object_type, epoch_us(ts) // 1000 as at_ms, event_id as frame_id, cast(lx as double) as left_x, cast(bottom as double) as bottom_y, (event_id % 100) / 128 as confidence, cast(0.6 as double) as e0 from det where sensor_id in ('cam1', 'cam3') and event_type <> 'view'")
def q61_log_frames(s, d):
    rows = S.detections(S.frames_from_text(log_lines(s, d), AppConfig(io=IOConfig(selectedSensorIds=("cam1", "cam3")))))
    return rows.select("sensor_id", "object_id", "object_type", F.unix_millis("ts").alias("at_ms"), "frame_id", "left_x", "bottom_y", "confidence", F.round(F.col("embedding")[0], 6).alias("e0"))


@query("select sensor_id, cast(object_id as varchar) as object_id, epoch_us(ts) // 1000 as at_ms, event_id as frame_id, cast(lx as double) as left_x, conf as confidence, cast(event_id % 10 as varchar) as visibility, cast(2.0 as double) as e1 from det where event_type <> 'error'")
def q62_wire_json(s, d):
    box = F.struct(*[F.col(a).cast("double").alias(b) for a, b in zip(BOX, ("leftX", "topY", "rightX", "bottomY"), strict=True)])
    thing = F.struct(text("object_id").alias("id"), box.alias("bbox"), F.lit("Person").alias("type"), F.col("conf").alias("confidence"), F.create_map(F.lit("visibility"), (F.col("event_id") % 10).cast("string")).alias("info"), F.struct(F.array(F.lit(1.0), F.lit(2.0)).alias("vector")).alias("embedding"))
    line = F.struct(F.lit("4.0").alias("version"), text("event_id").alias("id"), C.iso_millis("ts").alias("timestamp"), F.col("sensor_id").alias("sensorId"), F.array(thing).alias("objects"))
    robots = F.struct(F.array(F.lit(1)).alias("locationsOfObjects"), text("event_id").alias("id"))
    lines = det(s, d).select(F.when(F.col("event_type") == "error", F.to_json(robots)).otherwise(F.to_json(line)).alias("value"))
    rows = S.detections(S.frames_from_wire_json(lines))
    return rows.select("sensor_id", "object_id", F.unix_millis("ts").alias("at_ms"), "frame_id", "left_x", "confidence", F.col("info")["visibility"].alias("visibility"), F.col("embedding")[1].alias("e1"))


@query("select sensor_id, cast(object_id as varchar) as object_id, epoch_us(ts) // 1000 as at_ms, event_id as frame_id, cast(rx as double) as right_x, case when event_id % 128 = 0 then 1.0::double else (event_id % 128) / 128 end as confidence, event_type as kind, cast(0.6 as double) as e0 from det")
def q63_wire_messages(s, d):
    def encode(batches):
        import pandas as pd

        for b in batches:
            frames = [
                {"version": "4.0", "id": str(r.event_id), "timestamp": int(r.at_ms), "sensorId": r.sensor_id, "objects": [{"id": str(r.object_id), "bbox": {"leftX": r.lx, "topY": r.ty, "rightX": r.rx, "bottomY": r.bottom}, "type": "Person", "confidence": r.event_id % 128 / 128, "info": {"kind": r.event_type}, "embedding": [3.0, 4.0]}]}
                for r in b.itertuples()
            ]
            yield pd.DataFrame({"value": [S.encode_message(f) for f in frames]})

    messages = det(s, d).select("event_id", "sensor_id", "object_id", F.unix_millis("ts").alias("at_ms"), *BOX, "event_type").mapInPandas(encode, "value binary")
    rows = S.detections(S.frames_from_messages(messages))
    return rows.select("sensor_id", "object_id", F.unix_millis("ts").alias("at_ms"), "frame_id", "right_x", "confidence", F.col("info")["kind"].alias("kind"), F.round(F.col("embedding")[0], 6).alias("e0"))


@query("select cast(event_id as double) as FrameId, cast(object_id - 5 as double) as Id, cast(lx as double) as X, cast(h as double) as Height, conf as Conf from det where object_id >= 5")
def q64_mot_rows(s, d):
    part = F.when(F.col("event_id") % 3 == 0, " ").when(F.col("event_id") % 3 == 1, ", ").otherwise(";")
    values = [text("event_id"), (F.col("object_id") - 5).cast("string"), text("lx"), text("ty"), text("w"), text("h"), text("conf")]
    lines = det(s, d).select(F.concat(F.lit(" "), *[x for v in values[:-1] for x in (v, part)], values[-1]).alias("value"))
    return S.mot_rows(lines, ["FrameId", "Id", "X", "Y", "Width", "Height", "Conf"]).select("FrameId", "Id", "X", "Height", "Conf")


@query("select cast(event_id % 4 as double) as CameraId, cast(object_id as double) as Id, cast(event_id + 1 as double) as FrameId, cast(w as double) as Width, cast(lx as double) / 4 as Xworld from det")
def q65_ground_truth(s, d):
    values = [(F.col("event_id") % 4).cast("string"), text("object_id"), text("event_id"), text("lx"), text("ty"), text("w"), text("h"), (F.col("lx") / 4).cast("string"), text("ty")]
    lines = det(s, d).select(F.when(F.col("event_id") % 2 == 0, F.concat_ws("\t", *values)).otherwise(F.concat_ws(",", *values)).alias("value"))
    return S.ground_truth_rows(lines, AppConfig()).select("CameraId", "Id", "FrameId", "Width", "Xworld")


@query("select event_id as frame_id, epoch_us(ts) // 1000 as at_ms from det")
def q66_rtls_log(s, d):
    line = F.to_json(F.struct(F.col("event_id").alias("frameId"), C.iso_millis("ts").alias("timestamp")))
    lines = det(s, d).select(F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("b'"), line, F.lit("'"))).otherwise(line).alias("value"))
    return S.rtls_rows(lines).select("frame_id", F.unix_millis("ts").alias("at_ms"))


@query("""select event_id, coalesce(next_person, -1) as frame_id from (select event_id, event_type, min(case when event_type <> 'click' then event_id end) over (partition by sensor_id order by event_id rows between current row and unbounded following) as next_person from det) where event_type = 'click'""")
def q67_robot_frames(s, d):
    value = F.when(F.col("event_type") == "click", F.to_json(F.struct(F.array(F.lit(1)).alias("locationsOfObjects")))).otherwise(F.to_json(F.struct(text("event_id").alias("id"))))
    lines = det(s, d).select(F.col("sensor_id").alias("log"), "event_id", value.alias("value"))
    return S.robot_frames(lines, "event_id", F.floor(F.col("event_id") / LINES)).select("event_id", F.coalesce("frame_id", F.lit(-1)).alias("frame_id"))


@query("select event_id from det where event_type <> 'view' and object_id in (select object_id from det where event_type = 'click')")
def q68_crossing_frames(s, d):
    lines = log_lines(s, d)
    return S.frames_with_ids(S.frames_from_text(lines), S.crossing_ids(lines)).select(F.col("id").cast("long").alias("event_id"))


@query("select 'crossed' as part, count(*) as n from det where event_type = 'click' union all select 'others', count(*) from det where event_type <> 'click' union all select 'persons', count(*) from det where event_type <> 'view' union all select 'named', count(*) from det where sensor_id <> 'cam2'")
def q69_line_filters(s, d):
    lines = log_lines(s, d)
    crossed, others = S.crossing_lines(lines)
    unnamed = lines.withColumn("value", F.when(F.col("sensor_id") == "cam2", F.regexp_replace("value", '"sensorId":"cam2"', '"sensorId":""')).otherwise(F.col("value")))
    parts = {"crossed": crossed, "others": others, "persons": S.person_first(lines), "named": W.without_empty_sensors(unnamed)}
    counts = [df.agg(F.lit(k).alias("part"), F.count("*").alias("n")) for k, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# Sinks.
@query("select cast(object_id as varchar) as \"key\", cast(object_id as varchar) as global_id, count(*) as members, cast(sum(case when sensor_id in ('cam0', 'cam1') then 1 else 0 end) as bigint) as with_frames, true as without_keys from tracklet group by object_id", SEG)
def q70_mtmc_messages(s, d):
    member = F.struct("sensor_id", F.col("tid").alias("key"), text("f0").alias("start_frame"), text("f1").alias("end_frame"))
    objects = tracklets(s, d).groupBy(F.col("object_id").alias("global_id")).agg(F.min("s").alias("start"), F.max("e").alias("end"), F.lit("Person").alias("object_type"), F.collect_list(member).alias("matched"))
    sources = s.createDataFrame([(f"cam{i}", "recorder" if i < 2 else "live") for i in range(4)], "sensor_id string, source string")
    m = F.from_json("value", "globalId string, matched array<struct<start_frame:string>>")
    rows = W.mtmc_messages(objects, sources, "recorder").select("key", m.alias("m"), (~F.col("value").contains('"key"')).alias("without_keys"))
    return rows.select("key", F.col("m.globalId").alias("global_id"), F.size("m.matched").cast("long").alias("members"), F.size(F.filter("m.matched", lambda x: x["start_frame"].isNotNull())).cast("long").alias("with_frames"), "without_keys")


@query("select place as \"key\", frame, ids, true as without_keys from (select place, event_id // 8 as frame, cast(sum(case when object_id >= 10 then 1 else 0 end) as bigint) as ids from det group by all) where ids > 0")
def q71_rtls_messages(s, d):
    thing = F.struct((F.col("object_id") - 10).cast("string").alias("id"), F.lit("Person").alias("type"), F.array(F.array(F.col("lx").cast("double"), F.col("ty").cast("double"))).alias("locations"), F.array(text("event_id")).alias("matchedBehaviorKeys"))
    rows = det(s, d).groupBy("place", F.floor(F.col("event_id") / 8).cast("string").alias("frameId")).agg(F.max("ts").alias("timestamp"), F.collect_list(thing).alias("locationsOfObjects"))
    m = F.from_json("value", "frameId string, locationsOfObjects array<struct<id:string>>")
    out = W.rtls_messages(rows, debug=True, send_empty=False).select("key", m.alias("m"), (~F.col("value").contains("matchedBehaviorKeys")).alias("without_keys"))
    return out.select("key", F.col("m.frameId").cast("long").alias("frame"), F.size("m.locationsOfObjects").cast("long").alias("ids"), "without_keys")


# Tracks. Camera 2 has no homography, camera 3 no frame size.
def sensors(s: SparkSession, whole: bool = False) -> DataFrame:
    """The four cameras; ``whole``: none lacks anything."""
    roi = [[{"x": x, "y": y} for x, y in AREA]]
    size = lambda k, n: None if k == 3 and not whole else n
    view = lambda k: f"POLYGON (({k} 1, {k + 10} 1, {k + 10} 9))"
    rows = [(f"cam{k}", f"p{k % 2}", size(k, WIDTH), size(k, HEIGHT), 30.0, 0.0, view(k), None if k == 2 and not whole else [float(x) for x in H], roi) for k in range(4)]
    return s.createDataFrame(rows, SENSOR_STATE)


_LOW = PreprocessingConfig(locationConfidenceThresh=0.05, embeddingConfidenceThresh=0.05, behaviorConfidenceThresh=0.05, behaviorSplitThreshSec=GAP)
ANYWHERE = AppConfig(preprocessing=_LOW)
TRACKING = AppConfig(preprocessing=dataclasses.replace(_LOW, filterByRegionsOfInterest=True, behaviorNumLocationsMax=4))


def detections(s: SparkSession, d: str) -> DataFrame:
    """All events as detections; the vector of an event is the one at its number, counted round."""
    vectors = s.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    n = F.broadcast(vectors.agg(F.count("*").alias("_n")))  # a single row
    e = det(s, d).crossJoin(n).withColumn("vec_id", F.col("event_id") % F.col("_n")).join(vectors, "vec_id", "left")
    box = [F.col(a).cast("double").alias(b) for a, b in zip(BOX, ("left_x", "top_y", "right_x", "bottom_y"), strict=True)]
    info = F.lit(None).cast("map<string,string>").alias("info")
    return e.select("event_id", "sensor_id", text("object_id").alias("object_id"), F.lit("Person").alias("object_type"), "ts", "frame_id", *box, F.col("conf").alias("confidence"), info, "embedding")


def flagged(s: SparkSession, d: str, config: AppConfig = TRACKING, whole: bool = False) -> DataFrame:
    return K.with_flags(detections(s, d), sensors(s, whole), config)


def _inside(points: tuple, x: str, y: str) -> str:
    parts = [f"case when (({ay} > {y}) <> ({by} > {y})) and {x} < cast({bx - ax} as double) * ({y} - {ay}) / cast({by - ay} as double) + {ax} then 1 else 0 end" for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True)]
    return "(" + " + ".join(parts) + ") % 2 = 1"


_BIG = f"(w + 1) * (h + 1) > {WIDTH} * {HEIGHT} * cast(0.0008 as double)"
_FLAG = f"""{DET}, {HOM}, flag as (select * exclude (gx, gy), case when sensor_id <> 'cam2' then gx end as gx, case when sensor_id <> 'cam2' then gy end as gy, cast((w + 1) * (h + 1) as double) as area, cast(w + 1 as double) / cast(h + 1 as double) as aspect,
  sensor_id <> 'cam3' and conf >= 0.05 and cast(w + 1 as double) / cast(h + 1 as double) < 0.6 and {_BIG} and not cast(bottom as double) > (1 - cast(0.02 as double)) * {HEIGHT} as valid,
  sensor_id <> 'cam2' and {_inside(AREA, "gx", "gy")} as in_roi from proj)"""


@query("select event_id, place, round(gx, 6) as x, round(gy, 6) as y, valid as location_valid, valid as embedding_valid, in_roi, round(aspect, 6) as aspect from flag", _FLAG)
def q72_detection_flags(s, d):
    return flagged(s, d).select("event_id", "place", F.round("location.x", 6).alias("x"), F.round("location.y", 6).alias("y"), "location_valid", "embedding_valid", "in_roi", F.round("aspect", 6).alias("aspect"))


_BEHAVIOR = f"""{_FLAG}, lag_ as (select *, lag(ts) over (partition by sensor_id, object_id order by ts, frame_id) as prev from flag
), cut as (select *, cast(sum(case when date_diff('microsecond', prev, ts) > {GAP}::bigint * 1000000 then 1 else 0 end) over (partition by sensor_id, object_id order by ts, frame_id rows unbounded preceding) as bigint) as segment from lag_
), ranked as (select *, row_number() over (partition by sensor_id, object_id, segment order by ts, frame_id) - 1 as rn, count(*) over (partition by sensor_id, object_id, segment) as n from cut where in_roi
), thin as (select * from ranked where rn % cast(pow(2, greatest(0, ceil(log2(n / 4.0)))) as bigint) = 0
), behavior as (select sensor_id, cast(object_id as varchar) as object_id, segment, any_value(place) as place, min(ts) as s, max(ts) as e, min(frame_id) as f0, max(frame_id) as f1, count(*) as steps, avg(case when conf >= 0 then conf end) as mean_conf, avg(area) as mean_area, avg(aspect) as mean_aspect,
  cast(sum(case when valid then 1 else 0 end) as bigint) as located, bool_or(valid) as seen from thin group by sensor_id, object_id, segment)"""


def behaviors(s: SparkSession, d: str) -> DataFrame:
    return K.behaviors(K.track_points(flagged(s, d), TRACKING))


@query("select sensor_id, object_id, segment, place, epoch_us(s) as start_us, epoch_us(e) as end_us, f0, f1, steps, round(mean_conf, 6) as mean_conf, round(mean_area, 5) as mean_area, located from behavior", _BEHAVIOR)
def q73_behaviors(s, d):
    return behaviors(s, d).select(
        "sensor_id", "object_id", "segment", "place", us("start").alias("start_us"), us("end").alias("end_us"), F.col("start_frame").alias("f0"), F.col("end_frame").alias("f1"), F.size("steps").cast("long").alias("steps"),
        F.round("mean_confidence", 6).alias("mean_conf"), F.round("mean_area", 5).alias("mean_area"), F.size("locations").cast("long").alias("located"),
    )


@query(f"select sensor_id || ' #-# ' || object_id || ' #-# ' || strftime(date_trunc('millisecond', s), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as \"key\", true as unit from behavior where mean_conf >= 0.05 and mean_aspect < 0.75 and (sensor_id = 'cam3' or mean_area > {WIDTH} * {HEIGHT} * cast(0.0007 as double)) and seen", _BEHAVIOR)
def q74_kept_behaviors(s, d):
    kept = K.filtered(behaviors(s, d), TRACKING)
    return kept.select("key", (F.abs(C.l2_norm("embedding") - 1) < 1e-9).alias("unit"))


# Live locations.
WINDOW = 2 * DAY


def confirmed(s: SparkSession, d: str) -> DataFrame:
    """Tracklets with their object's number less ten as id, so that the first ten are shadows."""
    return tracklets(s, d).select("sensor_id", text("object_id").alias("object_id"), (F.col("object_id") - 10).alias("global_id"), F.col("s").alias("start"), F.col("e").alias("end"))


def places(s: SparkSession, d: str) -> DataFrame:
    points = V.live_points(flagged(s, d, ANYWHERE))
    return V.location_rows(points, confirmed(s, d), WINDOW)


_PLACES = f"""{_FLAG}, newest as (select place, max(epoch_us(ts)) as timestamp_us, max(frame_id) as frame_id from flag group by place
), near as (select f.place, timestamp_us, n.frame_id, object_id - 10 as global_id, sensor_id, gx, gy, (area / cast({WIDTH * HEIGHT} as double)) / aspect as weight from flag f join newest n using (place) where valid and gx is not null and epoch_us(ts) > timestamp_us - {WINDOW}::bigint * 1000000
), rows_ as (select place, timestamp_us, frame_id, global_id, sum(gx * weight) / sum(weight) as x, sum(gy * weight) / sum(weight) as y, count(distinct sensor_id) as members from near group by all)"""


@query("select place, timestamp_us, frame_id, global_id, round(x, 5) as x, round(y, 5) as y, members from rows_", _PLACES)
def q75_location_rows(s, d):
    return places(s, d).select("place", "timestamp_us", "frame_id", "global_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), "members")


@query("select place, 'Person' as object_type, count(*) as n from rows_ where global_id >= 0 group by place", _PLACES)
def q76_object_counts(s, d):
    return V.object_counts(places(s, d))


@query("select place, round(cast(count(distinct case when object_id >= 10 then sensor_id || '-' || object_id end) as double) / count(distinct sensor_id || '-' || object_id), 6) as ratio from det group by place")
def q77_assigned_ratio(s, d):
    return V.assigned_ratio(flagged(s, d), confirmed(s, d)).select("place", F.round("ratio", 6).alias("ratio"))


# Evaluation: the events of a camera as a sequence, one person and at most one prediction in a frame.
MEASURES = ["HOTA", "DetA", "AssA", "LocA", "MOTA", "MOTP", "IDSW", "Frag", "MT", "PT", "ML", "CLR_TP", "CLR_FN", "CLR_FP", "FP_per_frame", "IDTP", "IDF1", "Dets", "GT_Dets", "IDs", "GT_IDs", "Frames"]


def truth_and_prediction(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x, y = C.foot_point("lx", "rx", "bottom")
    e = det(s, d).select("event_id", F.col("sensor_id").alias("seq"), (F.floor(F.col("event_id") / 4) + 1).alias("frame"), "object_id", "event_type", "lx", "ty", "w", "h", C.project(x, y, H).alias("g"))
    truth = e.select("seq", "frame", (F.col("object_id") % 2).alias("id"), F.col("lx").alias("x"), F.col("ty").alias("y"), "w", "h", F.col("g.x").alias("gx"), F.col("g.y").alias("gy"))
    found = e.where("event_type <> 'error'")
    other = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    move = F.col("event_id") * 7 % 50
    return truth, found.select("seq", "frame", ((F.col("object_id") + other) % 2 + 10).alias("id"), (F.col("lx") + move).alias("x"), F.col("ty").alias("y"), "w", "h", (F.col("g.x") + move / 32).alias("gx"), F.col("g.y").alias("gy"))


def measured(gt: DataFrame, pr: DataFrame, kind: str) -> DataFrame:
    m = E.evaluate(gt, pr, kind).where(F.col("metric").isin(MEASURES)).groupBy("seq").pivot("metric", MEASURES).agg(F.first("value"))
    return m.select("seq", *[F.round(c, 6).alias(c.lower()) for c in MEASURES])


def _accuracy(similarity: str) -> str:
    eps = "cast(2.220446049250313e-16 as double)"
    alphas = ", ".join(f"{a}::double" for a in E.ALPHAS)
    total = lambda names: ", ".join(f"sum({x}) as {x}" for x in names)
    return f"""{DET}, {HOM}, r as (select sensor_id as seq, event_id // 4 + 1 as frame, object_id % 2 as g, (object_id + case when event_id % 11 = 0 then 1 else 0 end) % 2 + 10 as p, case when event_type <> 'error' then {similarity} end as sim from (select *, event_id * 7 % 50 as move from proj)
), gc as (select seq, g, count(*)::double as n from r group by all), pc as (select seq, p, count(*)::double as n from r where sim is not null group by all
), sz as (select seq, count(*)::double as gt_dets, count(sim)::double as dets, max(frame)::double as frames, count(distinct g)::double as gt_ids, count(distinct case when sim is not null then p end)::double as ids from r group by seq
), al as (select unnest([{alphas}]) as a), m as (select seq, a, g, p, count(*)::double as m, sum(sim) as loc from r, al where sim > 0 and sim >= a - {eps} group by all
), hs as (select m.seq as seq, a, sum(m) as tp, sum(loc) as loc, sum(m * m / (gc.n + pc.n - m)) as ass from m join gc on m.seq = gc.seq and m.g = gc.g join pc on m.seq = pc.seq and m.p = pc.p group by m.seq, a
), he as (select sz.seq as seq, al.a as a, coalesce(tp, 0) as tp, gt_dets - coalesce(tp, 0) as fn, dets - coalesce(tp, 0) as fp, coalesce(loc, 0) / greatest(cast(1e-10 as double), coalesce(tp, 0)) as loca, coalesce(ass, 0) / greatest(1, coalesce(tp, 0)) as assa from sz cross join al left join hs on hs.seq = sz.seq and hs.a = al.a
), hc as (select 'COMBINED' as seq, a, sum(tp) as tp, sum(fn) as fn, sum(fp) as fp, greatest(cast(1e-10 as double), sum(loca * tp)) / greatest(cast(1e-10 as double), sum(tp)) as loca, sum(assa * tp) / greatest(1, sum(tp)) as assa from he group by a
), hf as (select seq, avg(sqrt(assa * tp / greatest(1, tp + fn + fp))) as hota, avg(tp / greatest(1, tp + fn + fp)) as deta, avg(assa) as assa, avg(loca) as loca from (select seq, a, tp, fn, fp, loca, assa from he union all select seq, a, tp, fn, fp, loca, assa from hc) group by seq
), tn as (select *, row_number() over (partition by seq order by frame) as turn from r where sim is not null
), mt as (select seq, g, p, turn, sim, lag(p) over w as lp, lag(turn) over w as lt from tn where sim >= 0.5 - {eps} window w as (partition by seq, g order by turn)
), tr as (select seq, g, count(*) as hits, sum(sim) as s, sum(case when lp <> p then 1 else 0 end) as sw, sum(case when lt = turn - 1 then 0 else 1 end) as runs from mt group by all
), ct as (select gc.seq as seq, coalesce(sum(hits), 0)::double as clr_tp, coalesce(sum(s), 0)::double as ms, coalesce(sum(sw), 0)::double as idsw, coalesce(sum(runs - 1), 0)::double as frag, sum(case when coalesce(hits, 0) / n > 0.8 then 1 else 0 end)::double as mt, sum(case when coalesce(hits, 0) / n between 0.2 and 0.8 then 1 else 0 end)::double as pt from gc left join tr on tr.seq = gc.seq and tr.g = gc.g group by gc.seq
), idn as (select seq, g, p, count(*) as n from r where sim >= 0.5 group by all), idt as (select seq, greatest(sum(case when p = g + 10 then n else 0 end), sum(case when p <> g + 10 then n else 0 end))::double as idtp from idn group by seq
), one as (select sz.seq as seq, clr_tp, ms, idsw, frag, mt, pt, gt_ids - mt - pt as ml, gt_dets - clr_tp as clr_fn, dets - clr_tp as clr_fp, coalesce(idtp, 0) as idtp, dets, gt_dets, ids, gt_ids, frames from sz join ct using (seq) left join idt using (seq)
), every as (select * from one union all by name select 'COMBINED' as seq, {total(["clr_tp", "ms", "idsw", "frag", "mt", "pt", "ml", "clr_fn", "clr_fp", "idtp", "dets", "gt_dets", "ids", "gt_ids", "frames"])} from one)"""


_RESULT = """select seq, round(hota, 6) as hota, round(deta, 6) as deta, round(assa, 6) as assa, round(loca, 6) as loca, round((clr_tp - clr_fp - idsw) / greatest(1, gt_dets), 6) as mota, round(ms / greatest(1, clr_tp), 6) as motp, idsw, frag, mt, pt, ml, clr_tp, clr_fn, clr_fp,
  round(clr_fp / greatest(1, frames), 6) as fp_per_frame, idtp, round(idtp / greatest(1, 0.5::double * gt_dets + 0.5::double * dets), 6) as idf1, dets, gt_dets, ids, gt_ids, frames from every join hf using (seq)"""
_MOVED = "cast(greatest(w - move, 0) * h as double) / cast(2 * w * h - greatest(w - move, 0) * h as double)"


@query(_RESULT, _accuracy(_MOVED))
def q78_box_accuracy(s, d):
    return measured(*truth_and_prediction(s, d), "box")


@query(_RESULT, _accuracy("greatest(0, 1 - sqrt((gx - (gx + move / 32)) * (gx - (gx + move / 32))) / 2)"))
def q79_point_accuracy(s, d):
    gt, pr = truth_and_prediction(s, d)
    own = lambda x: x.select("seq", "frame", "id", F.col("gx").alias("x"), F.col("gy").alias("y"))
    return measured(own(gt), own(pr), "point")


@query("select event_id, 'MTMC' as seq, frame + \"offset\" as frame, object_id as id from (select event_id, sensor_id, event_id // 4 as frame, object_id from det) join (select sensor_id, coalesce(sum(last) over (order by sensor_id rows between unbounded preceding and 1 preceding), 0)::bigint as \"offset\" from (select sensor_id, max(event_id // 4) as last from det group by sensor_id)) using (sensor_id)")
def q80_combined_sequence(s, d):
    rows = det(s, d).select("event_id", F.col("sensor_id").alias("seq"), F.floor(F.col("event_id") / 4).alias("frame"), F.col("object_id").alias("id"))
    return E.combined_sequence(rows, R.frame_offsets(rows, "seq", "frame"))


@query("select sensor_id as seq, event_id // 8 as frame, object_id % 5 as id, min(event_id) as first_row from det where event_id // 8 >= 1 group by all")
def q81_deduplicated(s, d):
    rows = det(s, d).select(F.col("sensor_id").alias("seq"), F.floor(F.col("event_id") / 8).alias("frame"), (F.col("object_id") % 5).alias("id"), F.col("event_id").alias("row"))
    return E.deduplicated(rows, "row").withColumnRenamed("row", "first_row")


@query("""select seq, frame, count(*) as n from (select distinct sensor_id as seq, event_id as frame, object_id as id from det) t where exists (select 1 from (select sensor_id as seq, cast(event_id - 32 as bigint) as frame from det where event_type = 'view') p where p.seq = t.seq and p.frame = t.frame and p.frame > 0) group by seq, frame""")
def q82_rtls_evaluation_rows(s, d):
    rows = det(s, d).select(F.col("sensor_id").alias("seq"), F.col("frame_id").alias("frame"), F.col("object_id").alias("id"), F.col("lx").alias("x"), F.col("ty").alias("y"), F.col("event_id").alias("row"), "event_type")
    prediction = E.rtls_prediction(rows.where("event_type = 'view'"), 32.0, 1.0, 1.0)
    return E.restricted_truth(rows.select("seq", "frame", "id").distinct(), prediction).groupBy("seq", "frame").agg(F.count("*").alias("n"))


@query("""select "key", global_id from (select object_id || '-' || sensor_id as "key", event_id as global_id, row_number() over (partition by object_id, sensor_id order by case when event_type = 'view' then null else ts end desc nulls last, event_id desc) as rn from det) where rn = 1""")
def q83_resolved_matches(s, d):
    objects = det(s, d).select(F.concat_ws("-", text("object_id"), "sensor_id").alias("key"), F.col("event_id").alias("global_id"), F.when(F.col("event_type") != "view", F.col("ts")).alias("matched_ts"), F.col("event_id").alias("row"))
    return E.resolve_matches(objects).select("key", "global_id")


# Tables.
def assignments(s: SparkSession, d: str) -> DataFrame:
    """Tracklets of a day or more, an object as one identity."""
    t = tracklets(s, d).where(us("e") - us("s") >= DAY * 1_000_000)
    return t.select("sensor_id", text("object_id").alias("object_id"), "segment", F.col("object_id").alias("global_id"))


def numbered(s: SparkSession, d: str) -> DataFrame:
    return K.split_by_gap(flagged(s, d, ANYWHERE), GAP, tie="frame_id")


_LONG = f"""{_FLAG}, lag_ as (select *, lag(ts) over (partition by sensor_id, object_id order by ts, frame_id) as prev from flag
), cut as (select *, cast(sum(case when date_diff('microsecond', prev, ts) > {GAP}::bigint * 1000000 then 1 else 0 end) over (partition by sensor_id, object_id order by ts, frame_id rows unbounded preceding) as bigint) as segment from lag_
), own as (select *, max(ts) over w as e, min(ts) over w as s from cut window w as (partition by sensor_id, object_id, segment)
), long_ as (select * from own where date_diff('microsecond', s, e) >= {DAY}::bigint * 1000000)"""


@query("select sensor_id, frame_id, object_id as global_id, cast(lx as double) as left_x, cast(bottom as double) as bottom_y from long_", _LONG)
def e08_overlay_points(s, d):
    return TB.overlay_points(numbered(s, d), assignments(s, d)).select("sensor_id", "frame_id", "global_id", "left_x", "bottom_y")


@query("""select global_id, frame_id, px, py, case when rn >= 5 then cast(trunc(mx) as integer) else -1 end as smooth_x, case when rn >= 5 then cast(trunc(my) as integer) else -1 end as smooth_y from (select *, avg(px) over w as mx, avg(py) over w as my, row_number() over (partition by global_id order by ts, sensor_id, frame_id) as rn
from (select object_id as global_id, frame_id, sensor_id, ts, cast(trunc((gx + cast(2.5 as double)) * cast(20 as double)) as integer) as px, cast(trunc(cast(1079 as double) - (gy + cast(1.25 as double)) * cast(20 as double)) as integer) as py from long_ where valid and gx is not null) window w as (partition by global_id order by ts, sensor_id, frame_id rows 4 preceding))""", _LONG)
def e09_topview_trajectories(s, d):
    return TB.topview_trajectories(numbered(s, d), assignments(s, d), 2.5, 1.25, 20.0, 1080, 5).select("global_id", "frame_id", "px", "py", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("smooth_x", "smooth_y")])


@query("select object_id, min(frame_id) as first_frame, max(frame_id) as last_frame from (select object_id, frame_id, frame_id - row_number() over (partition by object_id order by frame_id) as island from (select distinct object_id, event_id // 50 as frame_id from det)) group by object_id, island")
def q84_frame_runs(s, d):
    return TB.frame_runs(det(s, d).select("object_id", F.floor(F.col("event_id") / 50).alias("frame_id")), ["object_id"], "frame_id")


@query("select event_id // 4 as \"FrameId\", object_id as \"Id\", min(cast((event_id // 4) % 90 as double)) as x, min(cast(object_id as double)) as y from det group by all")
def q85_truth_locations(s, d):
    f = F.floor(F.col("event_id") / 4)
    return TB.checked_truth_locations(det(s, d).select(f.alias("FrameId"), F.col("object_id").alias("Id"), (f % 90).cast("double").alias("Xworld"), F.col("object_id").cast("double").alias("Yworld")))


@query("select log, \"at\", max(frame_id) as frame_id from (select sensor_id as log, event_id // 3 as frame_id, strftime(make_timestamp((1704067200000 + ((event_id // 3) * 1000) // 30) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as \"at\" from det) group by log, \"at\"")
def q86_synchronised(s, d):
    lines = det(s, d).select(F.col("sensor_id").alias("log"), F.floor(F.col("event_id") / 3).alias("frame_id"), text("event_id").alias("value"))
    return TB.synchronised(lines, 1704067200000, 30.0, "UTC").select("log", "at", "frame_id")


@query("select object_id, conf, area from (select object_id, round(max(conf), 4) as conf, max((w + 1) * (h + 1)) as area from det group by object_id) a where not exists (select 1 from (select object_id, round(max(conf), 4) as conf, max((w + 1) * (h + 1)) as area from det group by object_id) b where (b.conf > a.conf and b.area >= a.area) or (b.conf = a.conf and b.area > a.area))")
def q87_pareto(s, d):
    # A row for each object of the table.
    best = det(s, d).groupBy("object_id").agg(F.round(F.max("conf"), 4).alias("conf"), F.max(C.bbox_area(*BOX)).alias("area"))
    top = TB.pareto_frontier(best, "conf", "area").select("conf", "area").distinct()
    return best.join(top, ["conf", "area"]).select("object_id", "conf", "area")


def _scalars(e: Column) -> dict[str, Column]:
    top = C.topview_pixel("lx", "ty", 2.5, 1.25, 0.75, 1080, 0.5)
    moved = C.shift_center(F.col("lx").cast("double"), F.col("ty").cast("double"), 10.0, (e % 4) * 90.0)
    return {
        "tx": top[0], "ty2": top[1], "sx": F.round(moved[0], 6), "sy": F.round(moved[1], 6), "close": C.is_close(F.col("lx").cast("double"), F.col("lx") + (e % 2) * 0.1), "number": C.sensor_number("sensor_id"),
        "wire_us": us(C.wire_timestamp(e, F.lit(123456789))), "where_": C.place_string(F.array(F.struct(F.lit("building").alias("name"), F.col("place").alias("value")), F.struct(F.lit("room").alias("name"), text("event_id").alias("value")))),
        "polygon": C.plain_polygon(F.concat(F.lit("POLYGON ((),("), text("lx"), F.lit("))"))),
        "directed": F.round(C.directed_distance(F.col("lx").cast("double"), F.col("ty").cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.cos(e.cast("double")), F.sin(e.cast("double")), 0.5), 5),
        "ioa": F.round(C.box_iou("lx", "ty", "w", "h", F.col("lx") + 10, F.col("ty") + 10, "w", "h", of_first=True), 6),
    }


@query(f"""select event_id, cast(trunc((lx + cast(2.5 as double)) * cast(0.75 as double) * cast(0.5 as double)) as integer) as tx, cast(trunc((1080 - (ty + cast(1.25 as double)) * cast(0.75 as double)) * cast(0.5 as double)) as integer) as ty2,
  round(lx + 10 * sin(radians((event_id % 4) * 90.0::double)), 6) as sx, round(ty - 10 * cos(radians((event_id % 4) * 90.0::double)), 6) as sy, abs(lx - (lx + (event_id % 2) * cast(0.1 as double))) <= cast(1e-8 as double) + cast(1e-5 as double) * abs(lx + (event_id % 2) * cast(0.1 as double)) as close,
  regexp_extract(sensor_id, '[0-9]+') as number, (event_id * 1000 + 123) * 1000 as wire_us, 'building=' || place || '/room=' || event_id as where_, 'POLYGON ((' || lx || '))' as polygon,
  round(sqrt(cast(lx * lx + ty * ty as double)) * (1 + acos(greatest(-1, least(1, cos(cast(event_id as double)) / sqrt(cos(cast(event_id as double)) * cos(cast(event_id as double)) + sin(cast(event_id as double)) * sin(cast(event_id as double)))))) / pi()), 5) as directed,
  round(cast(greatest(w - 10, 0) * greatest(h - 10, 0) as double) / cast(w * h as double), 6) as ioa from det""")
def q88_scalars(s, d):
    return det(s, d).select("event_id", *[v.alias(k) for k, v in _scalars(F.col("event_id")).items()])


@query(f"select event_id, cast((w + 1) * (h + 1) as double) as area, round(cast(w + 1 as double) / cast(h + 1 as double), 6) as aspect, round(gx, 6) as gx, round(gy, 6) as gy, {_inside(tuple(ROI), 'fx', 'fy')} as inside, sensor_id || ' #-# ' || object_id as id from proj", f"{DET}, {HOM}")
def q89_sql_functions(s, d):
    from ..functions.register import register

    register(s)
    x, y = C.foot_point("lx", "rx", "bottom")
    det(s, d).withColumns({"fx": x, "fy": y}).createOrReplaceTempView("crossview_detections")
    h, polygon = f"array({', '.join(f'{v}D' for v in map(float, H))})", f"array({', '.join(f'named_struct({chr(39)}x{chr(39)}, {a}D, {chr(39)}y{chr(39)}, {b}D)' for a, b in ROI)})"
    return s.sql(f"""select event_id, bbox_area(lx, ty, rx, bottom) as area, round(bbox_aspect_ratio(lx, ty, rx, bottom), 6) as aspect, round(homography_x(fx, fy, {h}), 6) as gx, round(homography_y(fx, fy, {h}), 6) as gy,
      point_in_polygon(fx, fy, {polygon}) as inside, behavior_id(sensor_id, cast(object_id as string)) as id from crossview_detections""")


# State.
def state_points(s: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("double")
    return segmented(s, d).select(
        C.behavior_id("sensor_id", "object_id").alias("id"), "segment", "ts", "frame_id", *[F.col(a).cast("double").alias(b) for a, b in zip(BOX, ("left_x", "top_y", "right_x", "bottom_y"), strict=True)],
        F.col("conf").alias("confidence"), none.alias("x"), none.alias("y"), F.lit(None).cast("array<double>").alias("embedding"),
    )


@query("select sensor_id || ' #-# ' || object_id as id, segment, n from (select *, max(e) over () as newest from trk) where date_diff('microsecond', e, newest) <= 432000000000", SEG)
def q90_evicted_state(s, d):
    live, _ = ST.evict(state_points(s, d), 5 * DAY)
    return live.groupBy("id", "segment").agg(F.count("*").alias("n"))


@query("select tid, epoch_us(s) as start_us, n from (select sensor_id || ' #-# ' || object_id as tid, * exclude tid from tracklet)", SEG)
def q91_merged_state(s, d):
    """The events of the first half as state, the others as a batch that is appended: the tracklets of all."""
    points = state_points(s, d)
    half = F.lit("2024-01-16 00:00:00").cast("timestamp")
    first, second = points.where(F.col("ts") < half), points.where(F.col("ts") >= half).drop("segment")
    numbered_first = K.split_by_gap(first.drop("segment"), GAP, ["id"], tie="frame_id").select(*points.columns)
    merged = ST.merge_points(numbered_first, second, GAP)
    return merged.groupBy(F.col("id").alias("tid"), "segment").agg(us(F.min("ts")).alias("start_us"), F.count("*").alias("n")).drop("segment")


@query("""select sensor_id, event_id as version, event_type <> 'error' as alive from (select *, row_number() over (partition by sensor_id order by ts desc, event_id desc) as rn from (select 'u' || object_id as sensor_id, event_id, ts, event_type, max(case when event_type = 'purchase' then ts end) over () as whole from det) where whole is null or ts >= whole) where rn = 1""")
def q92_sensor_registry(s, d):
    kind = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "purchase", "upsert-all").otherwise("upsert")
    rows = det(s, d).select(F.concat(F.lit("u"), text("object_id")).alias("sensor_id"), "ts", kind.alias("event"), text("event_id").alias("sensor"))
    registry = ST.sensor_registry(rows.limit(0), rows)
    return registry.select("sensor_id", F.col("sensor").cast("long").alias("version"), (F.col("event") != "delete").alias("alive"))


@query("select distinct object_id as global_id from tracklet where e >= timestamp '2024-01-25 00:00:00'", SEG)
def q93_pruned_objects(s, d):
    t = tracklets(s, d)
    objects = t.groupBy(F.col("object_id").alias("global_id")).agg(F.collect_set("tid").alias("members"))
    return ST.prune_objects(objects, t.where("e >= timestamp '2024-01-25 00:00:00'").select(F.col("tid").alias("key"))).select("global_id")


@query("select 'cam' || k as sensor_id, v as vertex, cast(trunc((x + cast(2.5 as double)) * cast(20 as double)) as integer) as px, cast(trunc(cast(1079 as double) - (y + cast(1.25 as double)) * cast(20 as double)) as integer) as py from (select k, unnest([0, 1, 2]) as v, unnest([k, k + 10, k + 10]) as x, unnest([1, 1, 9]) as y from (select distinct event_id % 4 as k from events))", "")
def q94_view_polygons(s, d):
    own = sensors(s).join(det(s, d).select("sensor_id").distinct(), "sensor_id")
    return TB.field_of_view_pixels(own, 2.5, 1.25, 20.0, 1080)


# More tables.
@query("select event_id, case object_id % 4 when 0 then 239 when 1 then 0 when 2 then 50 else 213 end as b, case object_id % 4 when 0 then 120 when 1 then 185 when 2 then 50 else 145 end as g, case object_id % 4 when 0 then 223 when 1 then 118 when 2 then 240 else 113 end as r from det")
def q95_palette(s, d):
    return det(s, d).select("event_id", TB.palette_color(F.col("object_id")).alias("c")).select("event_id", "c.b", "c.g", "c.r")


@query("select event_id, count(*) over w as held, epoch_us(min(ts) over w) as since_us from det window w as (partition by object_id order by epoch_us(ts) range between 86400000000 preceding and current row)")
def q96_buffered(s, d):
    return TB.buffered(det(s, d), ["object_id"], "ts", DAY).select("event_id", "held", us("since").alias("since_us"))


@query("select event_id, rank from det join (select sensor_id, row_number() over (order by sensor_id) as rank from (select distinct sensor_id from det)) using (sensor_id) where rank <= 3")
def q97_sensor_ranks(s, d):
    e = det(s, d)
    return TB.first_sensors(e, "sensor_id", 3).join(TB.sensor_ranks(e, "sensor_id"), "sensor_id").select("event_id", F.col("rank").cast("long").alias("rank"))


@query("select object_id, n, largest from (select object_id, count(*) as n, max((w + 1) * (h + 1)) as largest from det group by object_id) order by n desc, object_id limit 20")
def q98_top_rows(s, d):
    return TB.top_rows(det(s, d).groupBy("object_id").agg(F.count("*").alias("n"), F.max(C.bbox_area(*BOX)).alias("largest")), "n", ["object_id"])


@query("select event_id, row_number() over (partition by event_id // 16 order by lx * 1000000 + event_id) as position from det")
def q99_output_order(s, d):
    rows = det(s, d).select("event_id", F.floor(F.col("event_id") / 16).alias("frame"), (F.col("lx") * 1000000 + F.col("event_id")).alias("id"))
    return TB.in_output_order(rows, ["frame"], "id").select("event_id", F.col("position").cast("long").alias("position"))


@query("select day, max(object_id) as object_id from (select epoch_us(s) // 86400000000 as day, object_id from tracklet) where day = (select max(epoch_us(s) // 86400000000) from tracklet) group by day", SEG)
def q100_last_batch_id(s, d):
    return TB.last_batch_id(tracklets(s, d).select(F.floor(us("s") / (DAY * 1_000_000)).alias("day"), "object_id"), "day", "object_id")


@query("select event_id, sensor_id in ('cam0', 'cam2') as asked from det")
def q101_query_and_gallery(s, d):
    asked, others = TB.query_and_gallery(det(s, d), "sensor_id", ["cam0", "cam2"])
    return asked.select("event_id", F.lit(True).alias("asked")).unionByName(others.select("event_id", F.lit(False).alias("asked")))


@query("select sensor_id as seq, event_id as frame, dense_rank() over (partition by sensor_id order by object_id) - 1 as dense from det where event_type <> 'error'")
def q102_prepared_truth(s, d):
    rows = det(s, d).select(F.col("sensor_id").alias("seq"), F.col("event_id").alias("frame"), F.col("object_id").alias("id"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("conf"))
    return E.prepared_truth(rows).select("seq", "frame", F.col("dense").cast("long").alias("dense"))


@query(f"select sensor_id as seq, event_id // 4 + 1 as frame from (select *, event_id * 7 % 50 as move from det) where event_type <> 'error' and not (event_type = 'click' and {_MOVED} >= 0.5 - cast(2.220446049250313e-16 as double))")
def q103_without_distractors(s, d):
    truth, prediction = truth_and_prediction(s, d)
    clicks = det(s, d).select(F.col("sensor_id").alias("seq"), (F.floor(F.col("event_id") / 4) + 1).alias("frame"), (F.col("event_type") == "click").alias("distractor"))
    box = ["seq", "frame", "id", "x", "y", "w", "h"]
    return E.without_distractors(truth.select(*box).join(clicks, ["seq", "frame"]), prediction.select(*box)).select("seq", "frame")


# Calibration, control messages, identities.
@query("select event_id, round(gx, 4) as gx, round(gy, 4) as gy from proj", f"{DET}, {HOM}")
def q104_fitted_homography(s, d):
    """Projected through the homography that is fitted to where the known one puts six pixels."""
    import numpy as np

    from ..operators import calibration as CA

    pixels = np.array([[10, 20], [1900, 40], [1850, 1000], [30, 950], [900, 500], [400, 700]], float)
    fitted = CA.homography(pixels, CA.apply(np.array(H).reshape(3, 3), pixels))
    x, y = C.foot_point("lx", "rx", "bottom")
    return det(s, d).select("event_id", C.project(x, y, [float(v) for v in fitted.ravel()]).alias("g")).select("event_id", F.round("g.x", 4).alias("gx"), F.round("g.y", 4).alias("gy"))


@query("select kind, event, count(*) as n, min(epoch_us(ts) // 1000) as first_ms from (select case event_type when 'view' then 'calibration' else 'config' end as kind, case when event_type = 'view' and event_id % 2 = 0 then 'delete' else 'upsert' end as event, ts from det where event_type in ('view', 'click')) group by all")
def q105_notifications(s, d):
    from ..streaming.notifications import parsed

    key = F.when(F.col("event_type") == "view", "calibration").when(F.col("event_type") == "click", "analytics-config").otherwise("other")
    event = F.when((F.col("event_type") == "view") & (F.col("event_id") % 2 == 0), "delete").otherwise("upsert")
    header = lambda k, v: F.struct(F.lit(k).alias("key"), F.encode(v, "UTF-8").alias("value"))
    rows = det(s, d).select(F.encode(key, "UTF-8").alias("key"), F.encode(text("event_id"), "UTF-8").alias("value"), F.array(header("event.type", event), header("timestamp", C.iso_millis("ts"))).alias("headers"))
    return parsed(rows).groupBy("kind", "event").agg(F.count("*").alias("n"), F.min(F.unix_millis("ts")).alias("first_ms"))


@query("select 'name' as line union all select distinct sensor_id from det")
def q106_sequence_map(s, d):
    return W.sequence_map(det(s, d).select(F.col("sensor_id").alias("seq"))).withColumnRenamed("value", "line")


@query("select sensor_id, n, 'building=A/room=' || k as place, 1000 + k as frame_width, case when k = 2 then -1 else 30.0::double end as fps, case when k = 3 then 0 else 3 end as corners, case when k = 1 then -1 else 0.5::double end as h0 from (select sensor_id, count(*) as n, cast(substr(sensor_id, 4) as integer) as k from det group by sensor_id)")
def q107_sensor_states(s, d):
    from ..operators.calibration import sensor_states

    pair = lambda name, value: {"name": name, "value": str(value)}
    rows = [
        {
            "id": f"cam{k}", "attributes": [pair("frameWidth", 1000 + k), pair("frameHeight", 700), pair("fps", "fast" if k == 2 else 30)], "place": [pair("building", "A"), pair("room", k)],
            "rois": [] if k == 3 else [{"roiCoordinates": [{"x": 0, "y": 0}, {"x": 1, "y": 0}, {"x": 1, "y": 1}]}],
        } | ({} if k == 1 else {"homography": [[2, 0, 0], [0, 2, 0], [0, 0, 1]]})
        for k in range(4)
    ]
    states = s.createDataFrame(sensor_states(rows), SENSOR_STATE)
    n = det(s, d).groupBy("sensor_id").agg(F.count("*").alias("n"))
    corners = F.coalesce(F.size(F.get("rois", F.lit(0))), F.lit(0))
    return states.join(n, "sensor_id").select("sensor_id", "n", "place", "frame_width", F.coalesce("fps", F.lit(-1.0)).alias("fps"), F.when(corners < 0, 0).otherwise(corners).alias("corners"), F.coalesce(F.get("homography", F.lit(0)), F.lit(-1.0)).alias("h0"))


@query("select place, object_id as global_id, epoch_us(min(s)) as start_us, epoch_us(max(e)) as end_us, count(*) as n_matched, arg_min(tid, s) as first_key from (select *, 'p' || (cast(substr(sensor_id, 4) as bigint) % 2) as place from tracklet) group by place, object_id", SEG)
def q108_mtmc_objects(s, d):
    from ..operators.clustering import mtmc_objects

    rows = placed(s, d).select("place", F.col("object_id").alias("global_id"), F.col("tid").alias("key"), "sensor_id", text("object_id").alias("object_id"), F.col("s").alias("start"), F.col("e").alias("end"))
    return mtmc_objects(rows, "place").select("place", "global_id", us("start").alias("start_us"), us("end").alias("end_us"), "n_matched", F.col("matched")[0]["key"].alias("first_key"))


# People's heights: every camera looks along y and 0.3 down, from 3 m above the ground.
def _poses() -> dict:
    import numpy as np

    k = np.array([[1080, 0, 960], [0, 1080, 540], [0, 0, 1]], float)
    r = np.array([[1, 0, 0], [0, -np.sin(0.3), -np.cos(0.3)], [0, np.cos(0.3), -np.sin(0.3)]])
    return {f"cam{i}": (k, r, -r @ np.array([0.0, -6.0 - i, 3.0])) for i in range(4)}


_RAYS = f"""{DET}, eye as (select *, ((lx + rx) / 2.0::double - 960) / 1080 as u, (ty - 540) / 1080.0::double as vt, (bottom - 540) / 1080.0::double as vb, -6.0::double - event_id % 4 as oy, sin(0.3::double) as sn, cos(0.3::double) as cs from det
), ray as (select *, cs - sn * vt as ht, -sn - cs * vt as hz, cs - sn * vb as ft, -sn - cs * vb as fz from eye
), foot as (select *, -3.0::double / fz as s, u * (-3.0::double / fz) as px, oy + ft * (-3.0::double / fz) as py from ray
), tall as (select *, case when abs(u) >= 1e-12 then 3 + hz * px / u end as z0, 3 + hz * (py - oy) / ht as z1 from foot
), height as (select *, case when z0 is null then z1 else (z0 + z1) / 2 end as height from tall)"""


@query("select event_id, round(height, 5) as height from height", _RAYS)
def q109_heights(s, d):
    from ..operators import heights

    return heights.with_heights(detections(s, d), _poses()).select("event_id", F.round("height", 5).alias("height"))


@query("select sensor_id, round(avg(height), 5) as height from (select *, row_number() over (partition by sensor_id order by height desc, frame_id) as rn, count(*) over (partition by sensor_id) as n from height where height is not null) where rn <= cast(floor(n * cast(0.7 as double)) as bigint) group by sensor_id", _RAYS)
def q110_camera_heights(s, d):
    from ..config import LocalizationConfig
    from ..operators import heights

    every = AppConfig(localization=LocalizationConfig(peopleHeightNumBatchFrames=1 << 60))
    return heights.estimate(detections(s, d), _poses(), every).select("sensor_id", F.round("height", 5).alias("height"))


@query("""select event_id, round(case when hidden then ex else (lx + rx) / 2.0::double end, 4) as x, round(case when hidden then ey else bottom end, 4) as y, round(seen, 5) as seen from (select *, ey > ty and seen < cast(0.8 as double) as hidden
from (select *, case when ey > ty then least(1.0::double, (bottom - ty + 1) / (ey - ty + 1)) else 1.0::double end as seen from (select *, 960 + 1080 * gx / dz as ex, 540 + 1080 * ((gy - oy) * -sn - -3.0::double * cs) / dz as ey
from (select *, (gy - oy) * cs - -3.0::double * sn as dz from (select *, u * (-1.25::double / hz) as gx, oy + ht * (-1.25::double / hz) as gy from ray)))))""", _RAYS)
def q111_rectified_feet(s, d):
    from ..operators import heights

    poses = _poses()
    rows = heights.rectified(detections(s, d), poses, dict.fromkeys(poses, 1.75), AppConfig())
    return rows.select("event_id", F.round("foot_x", 4).alias("x"), F.round("foot_y", 4).alias("y"), F.round("visibility", 5).alias("seen"))


@query("select event_id, lx + w - 1 as right_x, ty + h - 1 as bottom_y, round(cast(lx as double) / 7, 2) as share from det")
def q112_truth_corners(s, d):
    truth = det(s, d).select("event_id", F.col("lx").alias("X"), F.col("ty").alias("Y"), F.col("w").alias("Width"), F.col("h").alias("Height"), (F.col("lx").cast("double") / 7).alias("share"))
    return TB.rounded_attributes(TB.truth_corners(truth)).select("event_id", "right_x", "bottom_y", "share")


@query("""select tid, cast(sum(case when start_us - ended > 432000000000 then 1 else 0 end) over (partition by object_id order by start_us, tid rows unbounded preceding) as bigint) as run from (select tid, object_id, epoch_us(s) as start_us, max(epoch_us(e)) over (partition by object_id order by epoch_us(s), tid rows between unbounded preceding and 1 preceding) as ended from tracklet)""", SEG)
def q113_stitched_runs(s, d):
    t = tracklets(s, d).select(F.col("object_id").alias("id"), F.col("tid").alias("key"), F.col("s").alias("start"), F.col("e").alias("end"))
    return K.stitch(t, 5 * DAY).select(F.col("key").alias("tid"), F.col("run").cast("long").alias("run"))
