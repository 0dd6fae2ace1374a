import dataclasses
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossview import __main__ as cli
from crossview.config import AppConfig, clock, load_config, updated
from crossview.functions import register
from crossview.operators import calibration, heights
from crossview.operators import tracks as K
from crossview.operators.calibration import sensor_states
from crossview.plans import pipelines as P
from crossview.schema import SENSOR_STATE
from crossview.sources import detections as S
from crossview.sources import sinks as W
from crossview.streaming import live, notifications
from crossview.streaming.mtmc import MtmcStream


def test_mtmc_stream_matches_batch(spark, tmp_path):
    lines, sensors, _ = P.scene(seconds=8)
    dim = spark.createDataFrame(sensor_states(sensors), SENSOR_STATE)
    half = len(lines) // 4
    for k, part in enumerate((lines[:half] + lines[2 * half : 3 * half], lines[half : 2 * half] + lines[3 * half :])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(part))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)  # the order in which the stream takes them
    m = MtmcStream(spark, dim, P.SCENE_CONFIG, f"file://{tmp_path}/state")
    stream = S.detections(S.frames_from_text(S.replay_stream(spark, f"file://{tmp_path}/in")))
    m.start(stream, f"file://{tmp_path}/cp").awaitTermination()
    got = sorted(json.loads(r.members) for r in m.objects().collect())
    rows = P.mtmc_batch(spark, spark.createDataFrame([(x,) for x in lines], "value string"), dim, P.SCENE_CONFIG).collect()
    want = {}
    for r in rows:
        want.setdefault(r.global_id, []).append(r.key)
    assert got == sorted(sorted(v) for v in want.values())
    assert sorted(r.global_id for r in m.objects().collect()) == [1, 2, 3]


def test_live_locations_equal_the_replay(spark, tmp_path):
    """The same log in one go, and as a stream of files; places follow the true ways of the scene's people."""
    lines, sensors, _ = P.scene(seconds=24)
    dim = spark.createDataFrame(sensor_states(sensors), SENSOR_STATE)
    # No re-initialisation on the way, and a buffer that fills early, so that both begin with the same batch.
    config = load_config({"preprocessing": {"mtmcPlusInitBufferLenSec": 4.0, "behaviorRetentionInStateSec": 600.0}, "clustering": {"clusteringAlgo": "AgglomerativeClustering", "agglomerativeClusteringDistThresh": 0.95, "numReassignmentIterations": 2}})
    config = updated(config, {"streaming": {"mtmcPlusFrameBatchSizeMs": 400, "mtmcPlusBehaviorBatchesConsumed": 100}}, frozenset())
    by_time = sorted(lines, key=lambda x: json.loads(x)["@timestamp"])
    (tmp_path / "in").mkdir()
    step = len(by_time) // 4
    for k in range(4):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(by_time[k * step : (k + 1) * step]))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)
    whole = live.replay_locations(live.live_points(P.flagged(spark.createDataFrame([(x,) for x in lines], "value string"), dim, config)), config).collect()
    stream = live.stream_locations(live.live_points(P.flagged(S.replay_stream(spark, f"file://{tmp_path}/in"), dim, config)), config)
    stream.writeStream.outputMode("append").format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(live.ROW).parquet(f"file://{tmp_path}/out").collect()
    plain = lambda rows: sorted((r.place, r.timestamp, r.frameId, [tuple(c) for c in r.objectCounts], [(o.id, o.type, [tuple(p) for p in o.locations], o.matchedBehaviorKeys) for o in r.locationsOfObjects]) for r in rows)
    assert plain(whole)[: len(got)] == plain(got) and len(whole) - len(got) <= 1 and len(got) > 20
    last = plain(whole)[-1]
    assert last[3] == [("Person", 3)] and len(last[4]) == 3 and all(len(o[3]) == 2 for o in last[4])
    f = int(last[2]) - 5  # the middle of the location and smoothing windows
    want = [(3 + 3 * p + np.sin(f / 20 + p), 3 + 1.5 * p + np.cos(f / 25 + p)) for p in range(3)]
    assert all(min(np.hypot(x - a, y - b) for a, b in want) < 0.3 for _, _, ((x, y),), _ in last[4])
    quiet = updated(config, {"streaming": {"mtmcPlusFrameBufferResetSec": 0.1}}, frozenset())
    assert live.replay_locations(live.live_points(P.flagged(spark.createDataFrame([(x,) for x in lines], "value string"), dim, quiet)), quiet).count() == 0  # every frame resets the buffer


def test_load_shedding():
    """After a batch that clustered anew, the first and the last batches that have come since."""
    config = updated(AppConfig(), {"streaming": {"mtmcPlusFrameBatchSizeMs": 0, "mtmcPlusBehaviorBatchesConsumed": 3}}, frozenset())
    row = lambda t: ("s", "1", "Person", int(t * 1e6), t, 0.9, 1.0, 0.5, None, None, 0.0, 0.0, 1.0, [1.0])
    worked = lambda fresh, shed: (t := live.PlaceTracker(config), setattr(t, "fresh", fresh), list(t.feed([row(k) for k in range(11)], shed)), [s[1] for own in t.tracks.values() for x in own for s in x.steps])[-1]
    assert worked(False, True) == worked(True, False) == list(range(10))
    assert worked(True, True) == [0, 8, 9]


def test_command_line(spark, tmp_path):
    lines, sensors, _ = P.scene(seconds=6)
    (tmp_path / "log.json").write_text("\n".join(lines))
    (tmp_path / "calibration.json").write_text(json.dumps({"sensors": sensors}))
    (tmp_path / "config.json").write_text(json.dumps({"clustering": {"clusteringAlgo": "AgglomerativeClustering", "agglomerativeClusteringDistThresh": 0.95}}))
    cli.main(["mtmc-batch", "--config", str(tmp_path / "config.json"), "--calibration", f"file://{tmp_path}/calibration.json", "--input", f"file://{tmp_path}/log.json", "--output", f"file://{tmp_path}/out"])
    assert spark.read.json(f"file://{tmp_path}/out").count() == 3
    # Settings tell input, truth and dumps; the truth is what the scene's cameras see.
    truth = []
    for x in lines:
        m = json.loads(x)
        for o in m["objects"]:
            i, left, top, right, bottom = o.split("|")[:5]
            w, h = int(float(right) - int(float(left)) + 1), int(float(bottom) - int(float(top)) + 1)
            truth.append(f"{int(m['sensorId'][3:])} {int(i) % 10} {int(m['id']) - 1} {int(float(left))} {int(float(top))} {w} {h} 0 0")
    (tmp_path / "truth.txt").write_text("\n".join(truth))
    own = json.loads((tmp_path / "config.json").read_text()) | {"io": {"jsonDataPath": f"file://{tmp_path}/log.json", "groundTruthPath": f"file://{tmp_path}/truth.txt", "enableDebug": True, "outputDirPath": f"file://{tmp_path}/debug"}}
    (tmp_path / "config.json").write_text(json.dumps(own))
    cli.main(["mtmc-batch", "--config", str(tmp_path / "config.json"), "--calibration", f"file://{tmp_path}/calibration.json", "--output", f"file://{tmp_path}/out2"])
    got = {(r.seq, r.metric): r.text for r in spark.read.json(f"file://{tmp_path}/out2-accuracy").collect()}
    assert got["MTMC", "IDF1"] == got["Cam01", "HOTA"] == got["COMBINED", "MOTA"] == "100"
    assert spark.read.json(f"file://{tmp_path}/debug/frames").count() == len(lines) and (tmp_path / "debug" / "behaviors").exists()
    own["io"] |= {"groundTruthFrameIdOffset": 40}
    (tmp_path / "config.json").write_text(json.dumps(own))
    cli.main(["mtmc-batch", "--config", str(tmp_path / "config.json"), "--calibration", f"file://{tmp_path}/calibration.json", "--output", f"file://{tmp_path}/out3"])
    assert {(r.seq, r.metric): r.text for r in spark.read.json(f"file://{tmp_path}/out3-accuracy").collect()}["MTMC", "HOTA"] != "100"
    (tmp_path / "mot.txt").write_text("1 1 0 0 10 10\n2 1 0 0 10 10\n")
    cli.main(["evaluate", "--input", f"file://{tmp_path}/mot.txt", "--ground-truth", f"file://{tmp_path}/mot.txt", "--output", f"file://{tmp_path}/eval"])
    assert {r.text for r in spark.read.json(f"file://{tmp_path}/eval").where("metric in ('HOTA', 'MOTA', 'IDF1')").collect()} == {"100"}


def test_control_messages(spark, tmp_path):
    at = lambda k: f"2024-01-01T00:00:0{k}.000Z"
    sensor = lambda i, w: {"id": i, "attributes": [{"name": "frameWidth", "value": str(w)}], "place": [], "rois": []}
    row = lambda key, event, t, body, *more: (bytearray(key.encode()), bytearray(json.dumps(body).encode() if body is not None else b""), [("event.type", bytearray(event.encode())), ("timestamp", bytearray(t.encode())), *more])
    schema = "key binary, value binary, headers array<struct<key:string,value:binary>>"
    feed = notifications.ControlFeed(spark, f"file://{tmp_path}/control", AppConfig())
    assert feed.sensors() is None and feed.config() == AppConfig()
    first = [row("calibration", "upsert-all", at(1), {"sensors": [sensor("a", 100), sensor("b", 200)]}), row("calibration", "upsert", at(3), {"sensors": [sensor("a", 111)]}), row("calibration", "upsert", at(2), {"sensors": [sensor("a", 999)]}), row("other", "x", at(1), None), row("analytics-config", "upsert", at(2), {"clustering": {"spatioTemporalDistLambda": 0.5}, "io": {"batchId": "9"}}), row("analytics-config", "upsert", at(3), None)]
    feed.process(spark.createDataFrame(first, schema), 0)
    assert {r.sensor_id: r.frame_width for r in feed.sensors().collect()} == {"a": 111, "b": 200}
    assert feed.config().clustering.spatioTemporalDistLambda == 0.5 and feed.config().io.batchId == "0"
    second = [row("calibration", "delete", at(5), {"sensors": [sensor("b", 1)]}), row("calibration", "upsert", at(4), {"sensors": [sensor("b", 300)]})]
    for _ in range(2):  # a batch that runs twice
        feed.process(spark.createDataFrame(second, schema), 1)
    assert {r.sensor_id: r.frame_width for r in feed.sensors().collect()} == {"a": 111}
    for bad in (row("calibration", "drop", at(1), {}), row("analytics-config", "delete", at(1), {}), row("calibration", "upsert", at(1), {}, ("what", bytearray(b"x")))):
        with pytest.raises(Exception, match="not defined"):
            notifications.parsed(spark.createDataFrame([bad], schema)).collect()
    asked = {r.key: r.value for r in notifications.requests(spark, AppConfig(), "t").collect()}
    assert asked["request-calibration"] == "" and set(json.loads(asked["init-analytics-config"])) == {"preprocessing", "localization", "clustering"}


def test_new_calibration_moves_old_points(spark, tmp_path):
    """Points of the first batch lie where the sensors of the second one put them."""
    lines, sensors, _ = P.scene(seconds=4)
    m = MtmcStream(spark, spark.createDataFrame(sensor_states(sensors), SENSOR_STATE), P.SCENE_CONFIG, f"file://{tmp_path}/state", notifications.ControlFeed(spark, f"file://{tmp_path}/control", P.SCENE_CONFIG))
    rows = lambda part: S.detections(S.frames_from_text(spark.createDataFrame([(x,) for x in part], "value string")))
    m.process(rows(lines[:10]), 0)
    moved = [s | {"globalCoordinates": [{"x": p["x"] + 100, "y": p["y"]} for p in s["globalCoordinates"]]} for s in sensors]
    body = bytearray(json.dumps({"sensors": moved}).encode())
    m.control.process(spark.createDataFrame([(bytearray(b"calibration"), body, [("event.type", bytearray(b"upsert-all")), ("timestamp", bytearray(b"2024-01-01T00:00:00Z"))])], "key binary, value binary, headers array<struct<key:string,value:binary>>"), 0)
    m.process(rows(lines[10:20]), 1)
    points = spark.read.parquet(f"file://{tmp_path}/state/points/v1")
    assert "location" not in points.columns
    placed = K.with_flags(points, m.control.sensors(), P.SCENE_CONFIG)
    assert placed.where("location.x < 90").count() == 0 and placed.count() == 60


def test_settings_take_effect(spark, tmp_path):
    import datetime as dt

    lines, sensors, _ = P.scene(seconds=4)
    dim, text = spark.createDataFrame(sensor_states(sensors), SENSOR_STATE), spark.createDataFrame([(x,) for x in lines], "value string")
    start = dt.datetime.fromtimestamp(1_700_000_000, dt.timezone.utc)
    late = dataclasses.replace(load_config({"preprocessing": {"timestampThreshMin": 1.0}}), as_of=start + dt.timedelta(seconds=62))
    assert P.flagged(text, dim, late).count() == 6 * 10 and P.flagged(text, dim, AppConfig()).count() == 6 * 20
    o = S.kafka_options(load_config({"streaming": {}}), "t")
    own = updated(AppConfig(), {"streaming": {"kafkaBootstrapServers": "a:1", "kafkaConsumerMaxRecordsPerPoll": 7, "kafkaRawConsumerPollTimeoutMs": 8, "kafkaNotificationConsumerPollTimeoutMs": 9}}, frozenset())
    assert o["maxOffsetsPerTrigger"] == "100000" and [S.kafka_options(own, "t", n)["kafkaConsumer.pollTimeoutMs"] for n in (False, True)] == ["8", "9"] and S.kafka_options(own, "t")["kafka.bootstrap.servers"] == "a:1"
    faithful = dataclasses.replace(AppConfig(), quirks="faithful")
    assert clock(AppConfig()) is None and clock(faithful) is not None and clock(dataclasses.replace(faithful, io=dataclasses.replace(faithful.io, inMtmcPlusBatchMode=True))) is None
    # Empty rows of locations are left out, and the delay cuts the newest steps.
    base = {"preprocessing": {"mtmcPlusInitBufferLenSec": 1.0}, "clustering": {"clusteringAlgo": "AgglomerativeClustering", "agglomerativeClusteringDistThresh": 0.95}}
    run = lambda **s: live.replay_locations(live.live_points(P.flagged(text, dim, c := updated(load_config(base), {"streaming": s}, frozenset()))), c).collect()
    newest = lambda rows: max(r.timestamp for r in rows)
    assert newest(run(mtmcPlusTimestampDelayMs=0)) - newest(run(mtmcPlusTimestampDelayMs=1000)) == dt.timedelta(seconds=1)
    nowhere = dict(mtmcPlusLocationWindowSec=0.0)
    assert len(run(**nowhere)) > 0 and run(sendEmptyMtmcPlusMessages=False, **nowhere) == []
    W.sequence_map(spark.createDataFrame([("b",), ("a",), ("b",)], "seq string")).coalesce(1).write.text(f"file://{tmp_path}/map")
    assert [r.seq for r in S.read_sequence_map(spark, f"file://{tmp_path}/map").collect()] == ["a", "b"]
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "seqinfo.ini").write_text(W.sequence_description("s1", 33))
    assert [tuple(r) for r in S.read_sequence_lengths(spark, f"file://{tmp_path}/s1/seqinfo.ini").collect()] == [("s1", 33)]


def test_hidden_feet_are_rectified(spark):
    """With the setting a detection's place follows the head and the height of its camera's people."""
    on = load_config({"localization": {"rectifyBboxByCalibration": True, "overwrittenPeopleHeightMeter": 1.75}})
    _, sensors, _ = P.scene(seconds=1)
    rows = spark.createDataFrame([("Cam01", "1", "Person", 1, 400.0, 300.0, 460.0, 500.0, 0.9, None, None)], "sensor_id string, object_id string, object_type string, frame_id long, left_x double, top_y double, right_x double, bottom_y double, confidence double, info map<string,string>, embedding array<double>")
    found = heights.poses(sensors)
    got = P.rectified(rows, sensors, on).first()
    assert got.info is None or set(got.info) == {"footLocation", "visibility"} and "Cam01" in found


def test_sql_functions(spark):
    register.register(spark)
    r = spark.sql("select bbox_area(0, 0, 9, 19) a, homography_x(1, 2, array(1D,0D,2D,0D,1D,3D,0D,0D,1D)) x, homography_y(1, 2, array(1D,0D,2D,0D,1D,3D,0D,0D,0D)) y, cosine_half(array(1D,0D), array(0D,1D)) c, point_in_polygon(3, 1, array(named_struct('x',0D,'y',0D),named_struct('x',4D,'y',0D),named_struct('x',4D,'y',4D))) p, behavior_id('s', '1') b").first()
    assert (r.a, r.x, r.y, r.c, r.p, r.b) == (200, 3, None, 0.5, True, "s #-# 1")
    spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0])], "k int, v array<double>").createOrReplaceTempView("vecs")
    assert spark.sql(register.vec_sum_sql("vecs", "k", "v")).first().total == [4.0, 6.0]


def test_heights(spark):
    k = np.array([[1080, 0, 960], [0, 1080, 540], [0, 0, 1]], float)
    # A camera 3 m above the ground, looking along y and a little down.
    c, s = np.cos(0.3), np.sin(0.3)
    r = np.array([[1, 0, 0], [0, -s, -c], [0, c, -s]], float)
    t = -r @ np.array([0.0, -6.0, 3.0])
    see = lambda p: (k @ (r @ np.array(p) + t))[:2] / (k @ (r @ np.array(p) + t))[2]
    foot, head = see([0.5, 2.0, 0.0]), see([0.5, 2.0, 1.75])
    box = (float(foot[0] - 30), float(head[1]), float(foot[0] + 30), float(foot[1]))
    d = spark.createDataFrame([("a", 1, *box), ("b", 1, *box)], "sensor_id string, frame_id long, left_x double, top_y double, right_x double, bottom_y double")
    got = {x.sensor_id: x.height for x in heights.with_heights(d, {"a": (k, r, t)}).collect()}
    assert abs(got["a"] - 1.75) < 0.05 and (got["b"] is None or np.isnan(got["b"]))
    hidden = (box[0], box[1], box[2], (box[1] + box[3]) / 2)
    h = spark.createDataFrame([("a", 1, *hidden)], d.schema)
    row = heights.rectified(h, {"a": (k, r, t)}, {"a": 1.75}, AppConfig()).first()
    assert abs(row.foot_y - box[3]) < 3 and row.visibility < 0.6
    # Every box as the scalar geometry has it.
    rng = np.random.default_rng(4)
    boxes = [("a" if i % 5 else "z", i, *map(float, (x, y, x + w, y + v))) for i, (x, y, w, v) in enumerate(rng.integers((0, 0, 20, 30), (1800, 900, 140, 260), (200, 4)))]
    many = spark.createDataFrame(boxes, d.schema)
    want = {b[1]: (calibration.people_height(b[2:], k, r, t), calibration.rectified_foot(b[2:], 1.75, k, r, t, 0.8)) for b in boxes}
    for x in heights.with_heights(many, {"a": (k, r, t)}).collect():
        assert (x.height is None) if x.sensor_id == "z" else x.height == pytest.approx(want[x.frame_id][0], rel=1e-9)
    for x in heights.rectified(many, {"a": (k, r, t)}, {"a": 1.75}, AppConfig()).collect():
        plain = ((x.left_x + x.right_x) / 2, x.bottom_y, 1.0)
        assert (x.foot_x, x.foot_y, x.visibility) == pytest.approx(plain if x.sensor_id == "z" else want[x.frame_id][1], rel=1e-9)
    run = heights.RunningHeight(AppConfig())
    assert run.add(0, [1.7] * 10) is None and run.add(700, [1.9]) is not None
    assert heights.estimate(d, {"a": (k, r, t)}, AppConfig()).count() <= 1 and F is not None
