import collections
import datetime as dt
import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crossview import config as cfg
from crossview.functions import columns as C
from crossview.operators import clustering as G
from crossview.operators import evaluation as E
from crossview.operators import relations as R
from crossview.operators import tables as TB
from crossview.operators import tracks as K
from crossview.operators.components import connected_components
from crossview.plans import catalogue as Q
from crossview.plans import pipelines as P
from crossview.sources import detections as S
from crossview.sources import sinks as W
from crossview.streaming import online as O
from crossview.streaming import state as ST

LINE = '{"version":"4.0","id":"12","@timestamp":"2024-01-01T00:00:00.400Z","sensorId":"Cam01","objects":["7|100.0|200.0|160.0|380.0|Person|#|m|30|brown|none|shirt|0.91|embedding|0.6,0.8|SV3DT|0.95|130.0,381.0|1.0,2.0,0.0|-30,-90,30,90","8|1|2|3|4|Car|#|a|b|c|d|e|0.5","9|1|2|3|4|Person|#|a|b|c|d|e|oops","10|1|2|3|4|Person|#|a|b|c|d|e|embedding|0,0"]}'


def ts(sec):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=sec)


def test_frames_from_text(spark):
    d = S.detections(S.frames_from_text(spark.createDataFrame([(LINE,), ("not json",)], "value string"))).orderBy("object_id").collect()
    assert [r.object_id for r in d] == ["10", "7", "9"]
    seven = d[1]
    assert seven.confidence == 0.91 and seven.embedding == pytest.approx([0.6, 0.8]) and seven.info["footLocation"] == "130.0,381.0" and seven.frame_id == 12
    assert d[2].confidence == 1.0 and d[2].embedding is None
    assert d[0].confidence == 1.0 and d[0].embedding is None


def test_apostrophes_and_selection(spark):
    line = LINE.replace('"', "'")
    assert S.frames_from_text(spark.createDataFrame([(line,)], "value string")).count() == 1
    c = cfg.load_config({"clustering": {}})
    assert S.frames_from_text(spark.createDataFrame([(LINE,)], "value string"), cfg.AppConfig(io=cfg.IOConfig(selectedSensorIds=("Other",)))).count() == 0
    assert c.clustering.clusteringAlgo == cfg.HDBSCAN


def test_bad_token_is_an_error(spark):
    bad = LINE.replace("|#|m|", "|x|m|")
    with pytest.raises(Exception, match="without"):
        S.detections(S.frames_from_text(spark.createDataFrame([(bad,)], "value string"))).collect()


def test_wire_json(spark):
    lines = ['{"id":"1","timestamp":"2024-01-01T00:00:00.400Z","sensorId":"a","objects":[{"id":"7","bbox":{"leftX":100,"topY":200,"rightX":160,"bottomY":380},"type":"Person","confidence":0.9,"info":{"visibility":"0.95"},"embedding":{"vector":[3,4]}}]}', '{"locationsOfObjects":[]}']
    rows = S.detections(S.frames_from_wire_json(spark.createDataFrame([(x,) for x in lines], "value string"))).collect()
    assert len(rows) == 1 and rows[0].embedding == [3, 4] and rows[0].right_x == 160


def test_wire_message():
    import struct

    def field(k, v):
        return bytes([k << 3 | 2, len(v)]) + v

    box = b"".join(bytes([k << 3 | 5]) + struct.pack("<f", v) for k, v in enumerate((1, 2, 3, 4), 1))
    obj = field(1, b"7") + field(2, box) + field(3, b"Person") + field(5, field(1, b"visibility") + field(2, b"0.9")) + field(6, field(1, struct.pack("<2f", 3, 4)))
    frame = field(2, b"12") + field(3, b"\x08\x05\x10\x80\x89\x7a") + field(4, b"Cam") + field(5, obj)
    got = S.decode_message(frame)
    assert got["id"] == "12" and got["timestamp"] == 5002 and got["objects"][0]["confidence"] == 1.0 and got["objects"][0]["embedding"] == pytest.approx([0.6, 0.8])
    assert got["objects"][0]["bbox"]["bottomY"] == 4 and got["objects"][0]["info"] == {"visibility": "0.9"}


def test_expressions(spark):
    d = spark.createDataFrame([(0.0, 0.0, 9.0, 19.0)], "l double, t double, r double, b double")
    row = d.select(C.bbox_area("l", "t", "r", "b"), C.bbox_aspect_ratio("l", "t", "r", "b"), C.project("l", "t", [1, 0, 2, 0, 1, 3, 0, 0, 1]).alias("p"), C.project("l", "t", [1, 0, 0, 0, 1, 0, 0, 0, 0]).alias("n")).first()
    assert row[0] == 200 and row[1] == 0.5 and (row.p.x, row.p.y) == (2, 3) and row.n is None
    reject = lambda w: d.select(C.quality_rejected(F.lit(0.9), C.bbox_area("l", "t", "r", "b"), C.bbox_aspect_ratio("l", "t", "r", "b"), w, F.lit(100), 0.5, 0.6, 0.01)).first()[0]
    assert reject(F.lit(100)) is False and reject(F.lit(None).cast("int")) is True  # unknown frames reject here ...
    assert d.select(C.touches_bottom("b", F.lit(None).cast("int"), 0.02)).first()[0] is False  # ... and keep there
    v = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>").select(C.normalized("a").alias("a"), C.normalized("z").alias("z")).first()
    assert v.a == pytest.approx([0.6, 0.8]) and v.z is None


def test_regions(spark):
    square = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4))])
    d = spark.createDataFrame([(1.0, 1.0), (5.0, 1.0)], "x double, y double").withColumn("loc", F.struct("x", "y"))
    assert [r[0] for r in d.select(C.in_regions(F.col("loc"), F.array(square), True)).collect()] == [True, False]
    assert [r[0] for r in d.select(C.in_regions(F.col("loc"), F.array().cast("array<array<struct<x:double,y:double>>>"), True)).collect()] == [True, True]
    assert d.select(C.in_regions(F.lit(None).cast("struct<x:double,y:double>"), F.array(square), True)).first()[0] is False


def test_split_and_downsample(spark):
    d = spark.createDataFrame([("a", ts(x), x) for x in (0, 6, 12, 19)], "k string, ts timestamp, frame_id long")
    assert [r.segment for r in K.split_by_gap(d, 6, ["k"]).orderBy("ts").collect()] == [0, 0, 0, 1]
    many = spark.createDataFrame([("a", x) for x in range(25)], "k string, i long")
    assert [r.i for r in K.downsample(many, ["k"], 10, ["i"]).orderBy("i").collect()] == list(range(0, 25, 4))


def test_hold_back(spark):
    d = spark.createDataFrame([("a", ts(x)) for x in range(5)] + [("b", ts(9.5)), ("b", ts(10))], "k string, ts timestamp")
    assert K.hold_back(d, ["k"], 1000).groupBy("k").count().collect()[0]["count"] == 5
    assert K.hold_back(d, ["k"], 1000, faithful=True).count() == 6


def test_relations(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 2)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50)], "k string, t int, v int")
    assert {(r.k, r.t): r.v for r in R.as_of(left, right, ["k"], "t", ["v"]).collect()} == {("a", 5): 50, ("a", 1): None, ("b", 2): None}
    assert {(r.k, r.t): r.v for r in R.as_of(left, right, ["k"], "t", ["v"], forward=True).collect()} == {("a", 5): 50, ("a", 1): 20, ("b", 2): None}
    iv = spark.createDataFrame([("s", "x", 0, 10), ("s", "y", 5, 15), ("s", "z", 20, 30)], "s string, id string, a int, b int")
    sets = R.stabbing(iv, "s", "id", "a", "b")
    assert sorted(tuple(r.members) for r in R.maximal_sets(sets, "s", "members").collect()) == [("x", "y"), ("z",)]
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "a long, b long")
    assert {r.label for r in connected_components(edges).collect()} == {0, 100}


def test_next_fill_reads_back_and_by_bin(spark):
    rows = [(k, at, at * 10 if at is not None and (at * 7 + len(k or "")) % 5 == 0 else None) for k in ("a", "bb", None) for at in (None, *range(40)) if k != "bb" or at != 3]
    d = spark.createDataFrame(rows, "k string, at int, v int").repartition(3)
    number = lambda at: -1 if at is None else at
    want = {(k, at): next((x for j, b, x in sorted((r for r in rows if r[0] == k), key=lambda r: number(r[1])) if number(b) >= number(at) and x is not None), None) for k, at, _ in rows}
    for bin_of in (None, F.floor(F.col("at") / 4), F.lit(0), F.col("at")):
        filled = R.next_fill(d, ["k"], "at", "v", "next", bin_of)
        got = filled.collect()
        assert filled.columns == ["k", "at", "v", "next"] and len(got) == len(rows) and {(r.k, r["at"]): r.next for r in got} == want
        plan = filled._jdf.queryExecution().executedPlan().toString()
        assert "unboundedfollowing" not in plan.lower()  # Spark reads such a frame again for every row


def test_robot_frames_take_the_next_person_line(spark):
    values = {1: '{"id":"3"}', 2: '{"locationsOfObjects":[1]}', 3: '{"locationsOfObjects":[]}', 4: "not json", 8: '{"id":"5"}', 9: '{"locationsOfObjects":[2]}', 10: None}
    d = spark.createDataFrame([(log, i, v) for log in ("a", "b") for i, v in values.items() if log == "a" or i != 8], "log string, i long, value string")
    for bin_of in (None, F.floor(F.col("i") / 2), F.col("i")):
        found = S.robot_frames(d, "i", bin_of)
        assert found.columns == ["log", "i", "value", "frame_id"]
        assert {(r.log, r.i): r.frame_id for r in found.collect()} == {("a", 2): 5, ("a", 3): 5, ("a", 9): None, ("b", 2): None, ("b", 3): None, ("b", 9): None}
        assert "unboundedfollowing" not in found._jdf.queryExecution().executedPlan().toString().lower()


def test_tracklet_sets_are_of_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = Q.tracklets(spark, d).collect()
    sensors = {r.sensor_id: [x for x in rows if x.sensor_id == r.sensor_id] for r in rows}
    micros = lambda t: round(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    stab = {(k, micros(t)): frozenset(x.tid for x in own if x.s <= t <= x.e) for k, own in sensors.items() for r in own for t in (r.s, r.e)}
    got = Q.q25_interval_stabbing(spark, d).collect()
    assert len(got) == len(stab) and {(r.sensor_id, r.at_us): frozenset(r.members.split(",")) for r in got} == stab and all(r.n == len(r.members.split(",")) for r in got)
    sets = {(k, m) for (k, _), m in stab.items()}
    largest = {(k, m) for k, m in sets if not any(k == j and m < b for j, b in sets)}
    groups = [(r.sensor_id, frozenset(r.members.split(","))) for r in Q.q26_maximal_groups(spark, d).collect()]
    assert len(groups) == len(largest) and set(groups) == largest
    assert {r.sensor_id: r.k for r in Q.q27_max_group_size(spark, d).collect()} == {k: max(len(m) for j, m in largest if j == k) for k in sensors}
    place = lambda r: int(r.sensor_id[3:]) % 2
    covering = {a.tid: sum(place(a) == place(b) and a.sensor_id != b.sensor_id and b.s <= a.s and b.e >= a.e for b in rows) for a in rows}
    assert {r.tid: r.covering for r in Q.q28_coverage_theta_join(spark, d).collect()} == {k: n for k, n in covering.items() if n}


def test_sets_and_components_are_of_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).toPandas().sort_values(["user_id", "t", "event_id"])
    a, b = ({(u, t // (Q.DAY * 1_000_000)) for u, t in zip(own.user_id, own.t, strict=True)} for own in (e[e.event_type == "view"], e[e.event_type != "view"]))
    assert a - b and a & b
    assert {r.op: r.n for r in Q.q46_set_ops(spark, d).collect()} == {"union": len(a | b), "intersect": len(a & b), "except": len(a - b)}
    new = (e.user_id != e.user_id.shift()) | (e.t - e.t.shift() > Q.GAP * 1_000_000)
    want = e.assign(label=e.groupby(new.cumsum()).event_id.transform("min")).set_index("event_id").label.to_dict()
    assert {r.node: r.label for r in Q.q58_components(spark, d).collect()} == want


def test_identities_are_of_all_tracklets(spark):
    """Every tracklet has an identity; those of a place are what clustering its behaviors in memory gives."""
    d = "/root/testdata/sf0.001"
    rows = P.e01_mtmc_batch(spark, d).collect()
    want = {(r.sensor_id, str(r.object_id), r.s): f"g{r.object_id // 5}" for r in Q.tracklets(spark, d).collect()}
    assert len(rows) == len(want) and {(r.sensor_id, r.object_id, r.start): r.place for r in rows} == want
    behaviors = K.filtered(K.behaviors(K.track_points(P.placed_detections(spark, d), P.EVERY)), P.EVERY).where("place = 'g1'").toPandas()
    own, labels = G.cluster(G.behaviors_of(behaviors), P.EVERY.clustering)
    assert {(r.key, r.global_id) for r in rows if r.place == "g1"} == {(b.key, k) for b, k in zip(own, labels, strict=True) if k >= 0}
    m = {(r.seq, r.metric): r.value for r in P.e02_mtmc_accuracy(spark, d).collect()}
    assert m["COMBINED", "CLR_TP"] == m["COMBINED", "GT_Dets"] == m["COMBINED", "Dets"] == 1000 and 0 < m["COMBINED", "IDF1"] <= 1
    assert P.e03_rtls_locations(spark, d).count() > 100


def test_maximal_stabbing_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(f"k{i % 2}", f"i{i:02d}", int(a), int(a + b)) for i, (a, b) in enumerate(zip(rng.integers(0, 12, 40), rng.integers(0, 5, 40), strict=True))]
    iv = spark.createDataFrame(rows, "k string, id string, a int, b int")
    want = R.maximal_sets(R.stabbing(iv, "k", "id", "a", "b"), "k", "members").collect()
    got = R.maximal_stabbing(iv, "k", "id", "a", "b").collect()
    assert sorted((r.k, r.members) for r in got) == sorted((r.k, r.members) for r in want)


def test_stabbing_by_bin_is_that_of_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(f"k{i % 3}", f"i{i:02d}", ts(int(a)), ts(int(a + b))) for i, (a, b) in enumerate(zip(rng.integers(0, 40, 60), rng.integers(-2, 19, 60), strict=True))]
    rows += [("open", "r", ts(5), None), (None, "s", ts(5), ts(6)), ("k0", "t", None, ts(6)), ("never", "q", ts(5), ts(4))]
    iv = spark.createDataFrame(rows, "k string, id string, a timestamp, b timestamp")
    other = spark.createDataFrame([("k0", ts(x / 2)) for x in range(99)] + [("k9", ts(1)), ("k0", None), (None, ts(5))], "k string, at timestamp")
    for points in (None, other):
        want = sorted((r.k, r["at"], tuple(r.members)) for r in R.stabbing(iv, "k", "id", "a", "b", points=points).collect())
        for most in (1, 50, 10**6):
            monkeypatch.setattr(R, "MEMBERS", most)
            for seconds in (1, 7, 1000):
                got = R.stabbing(iv, "k", "id", "a", "b", seconds, points)
                assert got.columns == ["k", "at", "members"] and sorted((r.k, r["at"], tuple(r.members)) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "collect_list" not in plan  # a bin's intervals are looked through once for a point
    table = pa.RecordBatch.from_pylist([{"_key": 1, "_ident": x, "_s": 0, "_e": 99, "_point": False} for x in "ba"] + [{"_key": 1, "_ident": None, "_s": x, "_e": x, "_point": True} for x in range(40)])
    for most, rows in ((6, 3), (1, 1), (1000, 40)):
        monkeypatch.setattr(R, "MEMBERS", most)
        batches = list(R._holding(iter([table])))
        assert max(x.num_rows for x in batches) == rows and sum((x["members"].to_pylist() for x in batches), []) == [["a", "b"]] * 40


def test_spans_are_those_of_the_segments(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(f"k{k}" if k else None, int(o) if o else None, ts(int(t))) for k, o, t in zip(rng.integers(0, 3, 300), rng.integers(0, 3, 300), rng.integers(0, 400, 300), strict=True)]
    rows += [("k1", 1, None), ("never", 1, None)]
    d = spark.createDataFrame(rows, "sensor_id string, object_id long, ts timestamp")
    keys = ["sensor_id", "object_id", "segment"]
    for gap in (0, 6, 1000):
        want = sorted(map(str, K.split_by_gap(d, gap).groupBy(*keys).agg(F.min("ts").alias("s"), F.max("ts").alias("e")).where("s is not null").collect()))
        for most, parts in ((1, 1), (40, 3), (10**6, 2)):
            monkeypatch.setattr(K, "MERGED", most)
            found = K.spans(d.repartition(parts), gap)
            assert found.columns == [*keys, "s", "e"] and sorted(map(str, found.collect())) == want
    monkeypatch.setattr(K, "MERGED", 4)
    at = lambda *times: pa.RecordBatch.from_pylist([{"k": "a", "_s": t} for t in times], pa.schema([("k", pa.string()), ("_s", pa.int64())]))
    merged = [x.to_pylist() for x in K._runs(["k"], 6)(iter([at(9, 1), at(), at(3, 20), at(2)]))]  # runs leave the task, not detections
    assert merged == [[{"k": "a", "_s": 1, "_e": 9}, {"k": "a", "_s": 20, "_e": 20}], [{"k": "a", "_s": 2, "_e": 2}]]


def test_stabbing_shuffles_runs_and_no_points(spark):
    d = "/root/testdata/sf0.001"
    plan = Q.q25_interval_stabbing(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "MapInArrow" in plan and "array_join" not in plan
    rows = [("k", f"i{i}", ts(i), ts(i + i % 5 - 1)) for i in range(20)] + [("k", None, ts(0), ts(30))]
    iv = spark.createDataFrame(rows, "k string, id string, a timestamp, b timestamp")
    other = spark.createDataFrame([("k", ts(x)) for x in range(9)], "k string, at timestamp")
    for points in (None, other):
        want = sorted((r["at"], len(r.members), "+".join(r.members)) for r in R.stabbing(iv, "k", "id", "a", "b", points=points).collect() if r.members)
        for seconds in (None, 1, 7, 1000):
            found = R.stabbing(iv, "k", "id", "a", "b", seconds, points, "+")
            assert found.columns == ["k", "at", "n", "members"] and sorted((r["at"], r.n, r.members) for r in found.where("n > 0").collect()) == want


def test_maximal_stabbing_by_bin(spark):
    rng = np.random.default_rng(8)
    rows = [(f"k{i % 2}", f"i{i:02d}", ts(int(a)), ts(int(a + b))) for i, (a, b) in enumerate(zip(rng.integers(0, 30, 50), rng.integers(0, 9, 50), strict=True))]
    rows += [("k2", "p", ts(0), ts(10)), ("k2", "q", ts(0), ts(4))]
    iv = spark.createDataFrame(rows, "k string, id string, a timestamp, b timestamp")
    want = sorted((r.k, tuple(r.members)) for r in R.maximal_sets(R.stabbing(iv, "k", "id", "a", "b"), "k", "members").collect())
    odd = spark.createDataFrame([("k2", "r", ts(6), ts(-5)), ("k0", "x", ts(9), ts(2)), ("k1", "y", ts(40), ts(-3)), ("k1", "z", None, ts(2))], iv.schema)  # these never hold
    for seconds in (None, 1, 7, 1000):
        got = R.maximal_stabbing(iv.unionByName(odd), "k", "id", "a", "b", seconds)
        assert sorted((r.k, tuple(r.members)) for r in got.collect()) == want


def test_maximal_stabbing_passes_on_first_starts_only(spark):
    plan = Q.q26_maximal_groups(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "_end" not in plan and "array_join" not in plan  # starts and ends are put in order within their bin
    rng = np.random.default_rng(10)
    starts = [int(x) for x in (*rng.integers(0, 60, 40), *rng.integers(500, 540, 40), *rng.integers(2000, 2400, 40))]
    rows = [(f"k{i % 2}", f"i{i:03d}", ts(a), ts(a + int(b))) for i, (a, b) in enumerate(zip(starts, rng.integers(0, 40, 120), strict=True))] + [("k0", "long", ts(30), ts(2100))]
    iv = spark.createDataFrame(rows, "k string, id string, a timestamp, b timestamp")
    want = sorted((r.k, ",".join(r.members)) for r in R.maximal_sets(R.stabbing(iv, "k", "id", "a", "b"), "k", "members").collect())
    for seconds in (None, 1, 10, 33, 400, 10**6):
        found = R.maximal_stabbing(iv, "k", "id", "a", "b", seconds, ",")
        assert found.columns == ["k", "at", "n", "members"] and sorted((r.k, r.members) for r in found.collect()) == want


def test_largest_stabbing_counts_without_sets(spark):
    rng = np.random.default_rng(4)
    rows = [(f"k{i % 3}", f"i{i:02d}", ts(int(a)), ts(int(a + b))) for i, (a, b) in enumerate(zip(rng.integers(0, 40, 60), rng.integers(-2, 9, 60), strict=True))]
    rows += [("one", "p", ts(5), ts(5)), ("never", "q", ts(5), ts(4)), ("open", "r", ts(5), None), (None, "s", ts(5), ts(6)), ("k0", "t", None, ts(6))]
    iv = spark.createDataFrame(rows, "k string, id string, a timestamp, b timestamp")
    want = {r.k: r.n for r in R.stabbing(iv, "k", "id", "a", "b").groupBy("k").agg(F.max(F.size("members")).alias("n")).collect()}
    for seconds in (1, 7, 100):
        largest = R.largest_stabbing(iv, "k", "a", "b", seconds)
        assert {r.k: r[1] for r in largest.collect()} == want and want["one"] == 1 and "never" not in want
    for made in (largest, Q.q27_max_group_size(spark, "/root/testdata/sf0.001")):
        assert "collect_" not in made._jdf.queryExecution().executedPlan().toString()  # it lists no members


def test_covering_counts_are_those_of_the_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(f"i{i:03d}", f"p{i % 2}", f"c{i % 5}", ts(int(a)), ts(int(a + b))) for i, (a, b) in enumerate(zip(rng.integers(0, 40, 150), rng.integers(0, 30, 150), strict=True))]
    odd = [("x", None, "c0", ts(5), ts(6)), ("y", "p0", None, ts(5), ts(6)), ("z", "p0", "c0", None, ts(6)), ("alone", "p9", "c0", ts(5), ts(6))]
    t = spark.createDataFrame(rows + odd, "tid string, place string, sensor string, s timestamp, e timestamp")
    want = collections.Counter(a[0] for a in rows for b in rows if a[1] == b[1] and a[2] != b[2] and b[3] <= a[3] and b[4] >= a[4])
    for seconds in (1, 6, 1000):
        counted = R.covering_counts(t, "tid", "place", "sensor", "s", "e", seconds)
        assert {r.tid: r.covering for r in counted.collect()} == want
    assert {r.tid: r.n for r in R.covering_pairs(t, t, "place", "sensor", "s", "e", "s", "e", 6).groupBy("tid").agg(F.count("*").alias("n")).collect()} == want
    # Of as many copies, each row has as many times the pairs; they are counted and not made.
    many = R.covering_counts(t.crossJoin(spark.range(20)).withColumn("tid", F.concat_ws("-", "tid", "id")), "tid", "place", "sensor", "s", "e", 6)
    assert {r.tid: r.covering for r in many.collect()} == {f"{k}-{i}": 20 * n for k, n in want.items() for i in range(20)}
    plan = Q.q28_coverage_theta_join(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "other_" not in plan  # its one join takes the sums over bins


def test_detections_cluster_alike_in_blocks(spark, monkeypatch):
    from crossview.numerics import cluster as N

    rng = np.random.default_rng(6)
    spots = rng.normal(0, 1, (4, 6))
    x = np.float32(np.concatenate([rng.normal(spots[i % 4], 0.2) for i in range(300)]).reshape(300, 6))
    x[20:40] = x[20]  # exact copies
    rows = [("a" if i < 200 else "b" if i < 297 else None if i < 299 else "c", int(i * 7 % 300), v.tolist()) for i, v in enumerate(x)] + [("a", 1000, None)]
    d = spark.createDataFrame(rows, "part string, id long, embedding array<float>")
    want = {}
    for part in ("a", "b", None, "c"):
        own = sorted((r[1], r[2]) for r in rows if r[0] == part and r[2])
        want |= {(part, k): v for (k, _), v in zip(own, N.hdbscan(np.array([v for _, v in own], np.float32), min(5, len(own))).tolist(), strict=True)}
    assert len(set(want.values())) > 3
    for block in (4000, 30):
        monkeypatch.setattr(G, "BLOCK", block)
        got = G.cluster_detections(d, "part", "id", 5)
        assert got.columns == ["part", "id", "label"] and {(r.part, r.id): r.label for r in got.collect()} == want


def test_coexisting_groups_are_maximal():
    b = lambda k, s, e, sensor="a": G.Behavior(k, sensor, "1", s, e, np.array([1.0]))
    rows = [b("x", 0, 10), b("y", 5, 15), b("z", 12, 20), b("w", 0, 30, "b")]
    assert G.coexisting_groups(rows) == [[0, 1], [1, 2]]


def test_cluster_single_and_empty():
    assert G.cluster([], cfg.ClusteringConfig())[1].size == 0
    assert G.cluster([G.Behavior("k", "s", "1", 0, 1, np.array([1.0, 0]))], cfg.ClusteringConfig())[1].tolist() == [1]


def test_overlap_suppression():
    e = np.array([[1.0, 0], [0.99, 0.1], [0, 1.0]])
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    out = G.suppress_overlaps(np.array([0, 0, 1]), [[0, 1]], e)
    assert out[0] != out[1]
    assert G.suppress_overlaps(np.array([0, 0, 0]), [[0, 1]], e).tolist() == [0, 0, 0]  # infeasible


def test_stitching():
    ids, nxt = G.stitch_clusters([{"a", "b"}, {"c"}, {"z"}], {5: {"b"}, 6: {"a", "x"}, -1: {"c"}}, 7)
    assert ids[0] in (5, 6) and ids[1] == 7 and ids[2] == 8 and nxt == 9


def measured(spark, sequences, lengths=None):
    """Measures of sequences given as rows (frame, truth, predicted, similarity); rows without a partner have None."""
    rows = [(s, *r) for s, own in sequences.items() for r in own]
    pairs = spark.createDataFrame([(s, f, g, p, float(x)) for s, f, g, p, x in rows if g is not None and p is not None], "seq string, frame long, gt_id long, pr_id long, sim double")
    side = lambda k: spark.createDataFrame(sorted({(r[0], r[1], r[k]) for r in rows if r[k] is not None}), "seq string, frame long, id long")
    out = {}
    for r in E.measures(pairs, side(2), side(3), lengths).collect():
        out.setdefault(r.seq, {})[r.metric] = r.value
    return out


def test_metrics_by_hand(spark):
    lengths = spark.createDataFrame([("perfect", 10)], "seq string, length long")
    m = measured(
        spark,
        {
            "perfect": [(f, 1, 9, 1.0) for f in range(1, 6)],
            "switch": [(f, 1, 9 if f < 3 else 8, 1.0) for f in range(1, 5)],
            "nothing": [(f, 1, None, None) for f in range(1, 5)],
            "only": [(f, None, 3, None) for f in range(1, 5)],
            "gap": [(1, 1, 9, 1.0), (2, 1, 8, 0.1), (3, 1, 9, 1.0)],
            "half": [(1, 1, 9, 0.5)],
            "alone": [(1, 1, 9, 1.0), (2, 1, None, None), (3, 1, 9, 1.0)],
        },
        lengths,
    )
    assert m["perfect"]["HOTA"] == pytest.approx(1) and m["perfect"]["MOTA"] == 1 and m["perfect"]["IDF1"] == 1 and m["perfect"]["IDSW"] == 0
    assert m["perfect"]["Frames"] == m["perfect"]["CLR_Frames"] == 10 and m["perfect"]["MT"] == 1
    assert m["switch"]["IDSW"] == 1 and m["switch"]["MOTA"] == 0.75 and m["switch"]["IDF1"] == 0.5 and m["switch"]["AssA"] == pytest.approx(0.5)
    assert m["nothing"]["CLR_FN"] == 4 and m["nothing"]["HOTA"] == 0 and m["nothing"]["IDF1"] == 0 and m["nothing"]["MLR"] == 1 and m["nothing"]["ML"] == 1 and m["nothing"]["LocA"] == 1
    assert m["only"]["CLR_FP"] == 4 and m["only"]["GT_Dets"] == 0 and m["only"]["MLR"] == 1 and m["only"]["MODA"] == 0 and m["only"]["CLR_Frames"] == 0 and m["only"]["Frames"] == 4
    assert m["gap"]["Frag"] == 1 and m["gap"]["IDSW"] == 0 and m["gap"]["LocA___90"] == 1
    assert m["half"]["CLR_TP"] == 1 and m["half"]["IDTP"] == 1
    assert m["alone"]["Frag"] == 0  # a frame without any prediction is no turn
    assert m["COMBINED"]["CLR_TP"] == 14 and m["COMBINED"]["GT_Dets"] == 20 and m["COMBINED"]["Frames"] == sum(m[s]["Frames"] for s in m if s != "COMBINED")


def brute_measures(rows):
    """All measures of one sequence by trying every matching of every frame."""
    frames = sorted({r[0] for r in rows})
    sim = {(f, g, p): x for f, g, p, x in rows if g is not None and p is not None}
    gts = {f: sorted({r[1] for r in rows if r[0] == f and r[1] is not None}) for f in frames}
    prs = {f: sorted({r[2] for r in rows if r[0] == f and r[2] is not None}) for f in frames}
    in_gt = collections.Counter(g for f in frames for g in gts[f])
    in_pr = collections.Counter(p for f in frames for p in prs[f])

    def best(left, right, score):
        """The matching of the largest sum of positive scores."""
        top, out = 0.0, []
        small, large, flip = (left, right, False) if len(left) <= len(right) else (right, left, True)
        for chosen in itertools.permutations(large, len(small)):
            own = [(b, a) if flip else (a, b) for a, b in zip(small, chosen)]
            own = [x for x in own if score.get(x, 0) > 0]
            if (total := sum(score[x] for x in own)) > top:
                top, out = total, own
        return out

    potential = collections.Counter()
    for (f, g, p), x in sim.items():
        whole = sum(sim.get((f, g, q), 0) for q in prs[f]) + sum(sim.get((f, h, p), 0) for h in gts[f]) - x
        potential[g, p] += x / whole if whole > 0 else 0
    aligned = {k: v / (in_gt[k[0]] + in_pr[k[1]] - v) for k, v in potential.items()}
    hits = [(f, g, p) for f in frames for g, p in best(gts[f], prs[f], {(g, p): aligned[g, p] * sim[f, g, p] for g in gts[f] for p in prs[f]})]
    out, curve = {}, []
    for alpha in E.ALPHAS:
        own = [h for h in hits if sim[h] >= alpha - 1e-12]
        n, pairs = len(own), collections.Counter((g, p) for _, g, p in own)
        ass = sum(c * c / (in_gt[g] + in_pr[p] - c) for (g, p), c in pairs.items()) / max(1, n)
        det = n / (sum(in_gt.values()) + sum(in_pr.values()) - n)
        curve.append(((det * ass) ** 0.5, det, ass, sum(sim[h] for h in own) / n if n else 0.0))
    out["HOTA"], out["DetA"], out["AssA"], out["LocA"] = (float(np.mean([c[k] for c in curve])) for k in range(4))
    last, ever, runs, seen, switches, total = {}, {}, collections.Counter(), collections.Counter(), 0, 0.0
    for f in frames:
        if not gts[f] or not prs[f]:
            continue
        own = best(gts[f], prs[f], {(g, p): sim[f, g, p] + 1000 * (last.get(g) == p) for g in gts[f] for p in prs[f] if sim[f, g, p] >= 0.5})
        for g, p in own:
            switches += g in ever and ever[g] != p
            runs[g] += g not in last
            seen[g] += 1
            total += sim[f, g, p]
        last = dict(own)
        ever |= last
    share = [seen[g] / n for g, n in in_gt.items()]
    out |= {"CLR_TP": sum(seen.values()), "IDSW": switches, "Frag": sum(r - 1 for r in runs.values()), "MOTP": total / max(1, sum(seen.values())), "MT": sum(x > 0.8 for x in share), "ML": sum(x < 0.2 for x in share)}
    out["MOTA"] = (out["CLR_TP"] - (sum(in_pr.values()) - out["CLR_TP"]) - switches) / sum(in_gt.values())
    over = collections.Counter((g, p) for (f, g, p), x in sim.items() if x >= 0.5)
    tp = sum(over[k] for k in best(sorted(in_gt), sorted(in_pr), over))
    return out | {"IDTP": tp, "IDF1": tp / (0.5 * sum(in_gt.values()) + 0.5 * sum(in_pr.values()))}


def test_metrics_by_brute_force(spark):
    rng, sequences = random.Random(13), {}
    for s in range(6):
        rows = []
        for f in range(1, 30):
            g, p = rng.sample(range(4), rng.randint(0, 4)), rng.sample(range(10, 14), rng.randint(0, 4))
            near = {x: 10 + (x + (f > 15) * (s % 3)) % 4 for x in g}
            rows += [(f, x, y, (0.3 + 0.7 * rng.random()) if near[x] == y else rng.random() * 0.7) for x in g for y in p]
            rows += [(f, x, None, None) for x in g] + [(f, None, y, None) for y in p]
        sequences[f"s{s}"] = rows
    got = measured(spark, sequences)
    for s, rows in sequences.items():
        for k, v in brute_measures(rows).items():
            assert got[s][k] == pytest.approx(v, abs=1e-9), (s, k)


def test_summary_and_details(spark, tmp_path):
    pairs = spark.createDataFrame([("a", 1, 1, 9, 1.0), ("a", 2, 1, 9, 0.8), ("b", 1, 1, 9, 0.6)], "seq string, frame long, gt_id long, pr_id long, sim double")
    m = E.measures(pairs, pairs.select("seq", "frame", F.col("gt_id").alias("id")), pairs.select("seq", "frame", F.col("pr_id").alias("id"))).cache()
    E.write_summary(m, f"file://{tmp_path}/s")
    text = spark.read.csv(f"file://{tmp_path}/s", sep=" ", header=True).first()
    assert text.asDict()["MOTP"] == "80" and text["CLR_TP"] == "3" and list(text.asDict()) == E.SUMMARY
    values = [0.123456, 1.0, 0.0, 1.234e-7, 0.5, 0.99999999, 12.3]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(E._five_digits(F.col("v")).alias("t")).collect()
    assert [float(r.t) for r in got] == [float(f"{v:.5g}") for v in values] and [r.t for r in got if "e" not in r.t] == [f"{v:.5g}" for v in values if "e" not in f"{v:.5g}"]
    E.write_detailed(m, f"file://{tmp_path}/d")
    back = {(r.seq, r.metric): r.value for r in E.read_detailed(spark, f"file://{tmp_path}/d").collect()}
    first = {(r.seq, r.metric): r.value for r in m.collect()}
    assert all(back[k] == pytest.approx(v) for k, v in first.items() if k in back) and ("COMBINED", "HOTA___50") in back
    classes = m.where("seq <> 'COMBINED'").withColumnRenamed("seq", "class").unionByName(spark.createDataFrame([("c", "MOTP", 0.0), ("c", "CLR_TP", 0.0)], "class string, metric string, value double"))
    whole, some = ({r.metric: r.value for r in E.class_averages(classes, x).collect()} for x in (False, True))
    assert whole["MOTP"] == pytest.approx((0.9 + 0.6) / 3) and some["MOTP"] == pytest.approx(0.75) and whole["CLR_TP"] == some["CLR_TP"] == 3


def test_duplicate_ids_are_an_error(spark):
    d = spark.createDataFrame([("s", 1, 1, 0.0, 0.0), ("s", 1, 1, 1.0, 1.0)], "seq string, frame long, id long, x double, y double")
    with pytest.raises(Exception, match="twice"):
        E.similarities(d, d, "point").collect()


def test_scene_end_to_end(spark):
    rows = P.scene_identities(spark).collect()
    person = {r.object_id: int(r.object_id) % 10 for r in rows}
    by = {}
    for r in rows:
        by.setdefault(r.global_id, set()).add(person[r.object_id])
    assert len(rows) == 6 and len(by) == 3 and all(len(v) == 1 for v in by.values())
    got = {r.metric: r.value for r in P.scene_accuracy(spark).where("seq = 'COMBINED'").collect()}
    assert got["IDF1"] >= 0.95 and got["HOTA"] > 0.9


def test_online_places_and_shadows():
    c = P.SCENE_CONFIG
    e = np.eye(3)
    at = lambda k, s, o, v, t0, t1, x: G.Behavior(k, s, o, int(t0 * 1e6), int(t1 * 1e6), v, np.arange(t0, t1 + 0.1, 0.5) * 1e6 // 1, np.array([[x, 0.0]] * len(np.arange(t0, t1 + 0.1, 0.5))))
    state = O.PlaceState()
    assert O.step(state, [at("a", "s1", "1", e[0], 0, 5, 0)], c) is None  # the buffer is not full
    live = [at("a", "s1", "1", e[0], 0, 12, 0), at("b", "s2", "1", e[0], 0, 12, 0), at("c", "s1", "2", e[1], 0, 12, 50)]
    row = O.step(state, live, c)
    assert row["counts"] == {"": 2} and sorted(len(o["keys"]) for o in row["objects"].values()) == [1, 2]
    live = [at(b.key, b.sensor, b.object_id, b.embedding, 0, 13, b.path[0][0]) for b in live]
    more = [*live, at("d", "s1", "3", e[2], 11, 13, 200)]
    assert O.step(state, more, c)["counts"] == {"": 2} and any(g < 0 for g in state.tracked)
    start = min(next(t.locations for g, t in state.tracked.items() if g < 0))
    wait = c.clustering.dynamicUpdateLengthThreshSec
    for t, n in ((15, 2), (18, 2), (start / 1e6 + wait, 2), (start / 1e6 + wait + 0.5, 3)):  # strictly later than the first place and the wait
        live = [at(b.key, b.sensor, b.object_id, b.embedding, b.start / 1e6, t, b.path[0][0]) for b in more]
        row = O.step(state, live, c)
        assert row["counts"] == {"": n}, t
    assert all(g > 0 for g in row["objects"])


def test_weighted_places():
    b = lambda k, s, xs, w, kind="Person": G.Behavior(k, s, "1", 0, 10, np.ones(1), np.arange(len(xs)), np.array([[x, 0.0] for x in xs], float), np.array(w, float), kind, 7)
    at = O.located([b("a", "s1", [0, 0], [1, 1]), b("b", "s2", [3, 9], [2, 0]), b("c", "s3", [1], [1])], {"a": 4, "b": 4}, 100)
    assert at.places == {4: (1.5, 0.0)} and at.frame_id == 7 and at.types == {4: "Person"} and at.keys == {4: ["a", "b"]}
    with pytest.raises(ValueError, match="two types"):
        O.located([b("a", "s1", [0], [1]), b("b", "s2", [0], [1], "Car")], {"a": 1, "b": 1}, 100)


def test_state_tables(spark):
    n = spark.createDataFrame([("a", ts(1), "upsert", "v1"), ("a", ts(3), "delete", None), ("a", ts(2), "upsert", "v2"), ("b", ts(1), "upsert", "w")], "sensor_id string, ts timestamp, event string, sensor string")
    reg = ST.sensor_registry(n.limit(0), n)
    assert [r.sensor_id for r in ST.live_sensors(reg).collect()] == ["b"] and reg.count() == 2
    empty = spark.createDataFrame([], ST.SEGMENT)
    point = lambda i, s: (i, ts(s), s, 0.0, 0.0, 1.0, 1.0, 0.9, 0.0, 0.0, None)
    batch = lambda rows: spark.createDataFrame(rows, ST.SEGMENT.replace("segment long, ", ""))
    one = ST.merge_points(empty, batch([point("x", 0), point("x", 3), point("x", 20)]), 6)
    two = ST.merge_points(one, batch([point("x", 22), point("x", 60)]), 6)
    assert two.select("segment").distinct().count() == 3 and two.where("segment = 1").count() == 2
    live, ended = ST.evict(two, 30)
    assert sorted(r.segment for r in ended.collect()) == [0, 1] and live.count() == 1
    ids, nxt = ST.continue_ids([{"cluster": 0, "members": ["k"]}, {"cluster": 1, "members": ["k", "m"]}], {"k": {4: 1}}, 9)
    assert [(c["cluster"], c["global_id"]) for c in ids] == [(1, 4), (0, 9)] and nxt == 10
    assert [k for k, _ in ST.buffered_batches([0, 100, 200, 300, 9000], 180, 4000)] == ["flushed", "dropped", "held"]


def test_stream_of_several_batches(spark, tmp_path):
    """Of each segment the row of the last batch that touched it."""
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").repartitionByRange(3, "ts").write.parquet(f"file://{tmp_path}/events.parquet")
    for k, f in enumerate(sorted((tmp_path / "events.parquet").glob("part-*"))):  # the order in which the stream takes them
        os.utime(f, (1_700_000_000 + 60 * k,) * 2)
    from crossview.functions import columns as C

    def plan(p):
        return ST.stream_tracklets(p.select(C.behavior_id("sensor_id", "user_id").alias("id"), "ts"), Q.GAP)

    import pyspark.sql.streaming.readwriter as rw

    old = rw.DataStreamReader.parquet
    rw.DataStreamReader.parquet = lambda self, path, **k: old(self.option("maxFilesPerTrigger", 1), path, **k)
    try:
        got = P.run_stream(spark, f"file://{tmp_path}", plan, ["id", "segment"]).collect()
    finally:
        rw.DataStreamReader.parquet = old
    want = Q.tracklets(spark, "/root/testdata/sf0.001").select(F.unix_micros("s"), F.unix_micros("e"), "n").collect()
    assert sorted((r.start_us, r.end_us, r.n) for r in got) == sorted(tuple(r) for r in want)


def test_stream_equals_batch(spark):
    from crossview.plans import catalogue as Q

    d = "/root/testdata/sf0.001"
    s = P.e05_stream_tracklets(spark, d)
    b = Q.tracklets(spark, d)
    got = sorted((r.start_us, r.end_us, r.n) for r in s.collect())
    want = sorted((r[0], r[1], r[2]) for r in b.select(F.unix_micros("s"), F.unix_micros("e"), "n").collect())
    assert got == want


def test_sinks_and_tables(spark):
    assert W.sanitized("a/b$c") == "abc" and W.valid_path("/tmp/x.json") and not W.valid_path("../x")
    m = spark.createDataFrame([(1, "Person", ts(0), ts(1), [("s", "k", "1", "2")])], "global_id long, object_type string, start timestamp, end timestamp, matched array<struct<sensor_id:string,key:string,start_frame:string,end_frame:string>>")
    body = W.mtmc_messages(m, spark.createDataFrame([("s", "live")], "sensor_id string, source string"), "recorder").first().value
    assert "start_frame" not in body and "key" not in body
    assert "start_frame" in W.mtmc_messages(m, spark.createDataFrame([("s", "recorder")], "sensor_id string, source string"), "recorder").first().value
    runs = TB.frame_runs(spark.createDataFrame([("a", x) for x in (1, 2, 3, 7, 8)], "k string, f long"), ["k"], "f").orderBy("first_frame").collect()
    assert [(r.first_frame, r.last_frame) for r in runs] == [(1, 3), (7, 8)]


def test_text_round_trips(spark, tmp_path):
    rows = spark.createDataFrame([(1, 7, 10, 20, 5, 6), (2, -1, 1, 2, 3, 4)], "frame int, id int, x int, y int, w int, h int")
    W.write_mot_rows(rows, f"file://{tmp_path}/mot")
    assert [tuple(r) for r in S.read_mot_rows(spark, f"file://{tmp_path}/mot", ["f", "i", "x", "y", "w", "h"]).collect()] == [(1, 7, 10, 20, 5, 6)]
    (tmp_path / "log").write_text("b'{\"frameId\": 3, \"timestamp\": \"2024-01-01T00:00:00.500Z\"}'\n{\"frameId\": 4}\n")
    assert sorted(r.frame_id for r in S.read_rtls_log(spark, f"file://{tmp_path}/log").collect()) == [3, 4]
    lines = spark.createDataFrame([('{"sensorId":"a","x":1}',), ('{"sensorId":""}',), ('{"sensorId":"b"}',), ("{}",)], "value string")
    W.split_by_sensor(lines, f"file://{tmp_path}/split")
    back = spark.read.text(f"file://{tmp_path}/split")
    assert sorted((r.sensorId, r.value) for r in back.collect()) == [("a", '{"sensorId":"a","x":1}'), ("b", '{"sensorId":"b"}')]
    for broken in (lambda: S.configured_stream(spark, cfg.AppConfig(), "t"), lambda: W.write_configured(lines, cfg.AppConfig())):  # without the connector jar
        with pytest.raises(Exception, match="(?i)kafka"):
            broken()


def test_calibration_errors_and_angles(spark):
    from crossview.operators import calibration as CA

    errors = CA.reprojection_errors(spark, P.scene()[1]).collect()
    assert len(errors) == 8 and max(max(abs(v) for v in r if isinstance(v, float) and abs(v) < 1e-3) for r in errors) < 1e-3
    for axis in range(3):
        v = np.zeros(3)
        v[axis] = 0.4
        assert CA.euler_degrees(CA.rotation(v)) == pytest.approx(np.degrees(v))


def test_appearance_alone():
    rng = np.random.default_rng(1)
    unit = lambda v: v / np.linalg.norm(v)
    faces = np.eye(4)[:3]
    rows = [G.Behavior(f"{s}{p}", s, str(p), p, 10, unit(faces[p] + 0.05 * rng.normal(size=4))) for s in ("a", "b") for p in range(3)]
    labels = dict(zip([b.key for b in sorted(rows, key=lambda b: b.order)], G.appearance_only(rows, 3, 0.3), strict=True))
    assert all(labels[f"a{p}"] == labels[f"b{p}"] for p in range(3)) and len(set(labels.values())) == 3


def test_config():
    with pytest.raises(ValueError):
        cfg.load_config({"clustering": {"nope": 1}})
    with pytest.raises(ValueError):
        cfg.ClusteringConfig(spatioTemporalDistLambda=2)
    c = cfg.updated(cfg.AppConfig(), {"io": {"batchId": "9"}, "preprocessing": {"behaviorSplitThreshSec": 9}})
    assert c.io.batchId == "0" and c.preprocessing.behaviorSplitThreshSec == 9
    for preset in (cfg.MTMC_PRESET, cfg.RTLS_PRESET):
        assert cfg.load_config({k: v for k, v in preset.items() if k != "streaming"})
