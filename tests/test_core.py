"""Literal cases of the domain's rules."""

import datetime as dt
import json
import struct

import pytest
from pyspark.sql import functions as F

from headway.config import Accuracy, Bunching, RunSettings
from headway.functions import geo, rounding, text, time, wire
from headway.operators import accuracy, census, detect, enrich, keyed
from headway.plans import incremental, marts, quality, queries_more
from headway.schemas import ALERT, SchemaMismatch, Severity, conform, schema_diff
from headway.sources import archive, realtime, sinks, static
from headway.streaming import jobs


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_rounding(spark):
    r = one(spark, rounding.float_to_int(F.lit(2.5)), rounding.float_to_int(F.lit(3.5)), rounding.numeric(F.lit(112.5), 0), rounding.percent(F.lit(1), F.lit(3)), rounding.percent(F.lit(1), F.lit(0)))
    assert (r[0], r[1], float(r[2]), str(r[3]), r[4]) == (2, 4, 113.0, "33.33", None)


def test_clock_and_days(spark):
    c = lambda x: F.lit(x).cast("string")
    r = one(spark, *[time.clock_seconds(c(x)) for x in ("25:14:00", "7:05:09", "noon", None)])
    assert tuple(r) == (90840, 25509, None, None)
    r = one(spark, *[time.service_day(c(x)) for x in ("2026-09-22", "20260922", "9/22/2026", "2026-9-22", None)])
    assert tuple(r) == ("20260922", "20260922", None, None, None)
    r = one(spark, *[time.epoch_seconds(c(x)) for x in ("2026-09-22T06:12:26Z", "1790000000", "x", None)])
    assert tuple(r) == (int(dt.datetime(2026, 9, 22, 6, 12, 26, tzinfo=dt.timezone.utc).timestamp()), None, None, None)
    r = one(spark, *[time.gtfs_date(c(x)) for x in ("20260931", "20260930", "", None)])
    assert tuple(r) == (None, dt.date(2026, 9, 30), None, None)


def test_service_origin_on_days_that_clocks_change(spark):
    at = lambda d, o="midnight": F.unix_seconds(time.service_origin(F.lit(d).cast("date"), origin=o))
    utc = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())
    r = one(spark, at("2026-09-14"), at("2026-12-15"), at("2026-03-08"), at("2026-03-09"), at("2026-11-01"), at("2026-11-02"), at("2026-03-08", "noon_minus_12h"), at("2026-11-01", "noon_minus_12h"))
    assert (r[0], r[1]) == (utc(2026, 9, 14, 7), utc(2026, 12, 15, 8))
    assert (r[3] - r[2], r[5] - r[4]) == (23 * 3600, 25 * 3600)
    assert (r[6], r[7]) == (utc(2026, 3, 8, 7), utc(2026, 11, 1, 8))


@pytest.mark.parametrize("s, label", [(-60, "past"), (0, "0-2m"), (119, "0-2m"), (120, "2-5m"), (780, "10-15m"), (2700, "45-60m"), (3600, "45-60m")])
def test_lead_buckets(spark, s, label):
    assert one(spark, time.lead_bucket(F.lit(s)))[0] == label


def test_text_and_wire(spark):
    tr = lambda *p: F.array(*[F.struct(F.lit(t).cast("string").alias("text"), F.lit(g).cast("string").alias("language")) for t, g in p])
    r = one(spark, text.english_text(tr(("a", "fr"), ("b", "en-US"))), text.english_text(tr(("a", "fr"), (None, "EN"))), text.english_text(tr(("a", "fr"))), text.english_text(tr(("a", None))), text.pair_key(F.lit("9"), F.lit("10")), text.snake_case(F.lit("informedEntity.agencyId")))
    assert tuple(r) == ("b", None, "a", "a", "10|9", "informed_entity.agency_id")
    framed = wire.frame(F.lit('{"a":1}'), F.lit(300))
    r = one(spark, framed, wire.schema_id(framed), wire.unframe(framed).cast("string"), wire.unframe(F.lit(b"\x01\x00\x00\x00\x01x")), wire.unframe(F.lit(b"\x00")))
    assert bytes(r[0]) == b"\x00" + struct.pack(">I", 300) + b'{"a":1}' and tuple(r)[1:] == (300, '{"a":1}', None, None)


def test_geometry(spark):
    line = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0))])
    p = lambda x, y: geo.project_on_line(F.lit(x), F.lit(y), line)
    assert tuple(one(spark, p(0.5, 0.3), p(-1.0, 0.0), p(2.0, 0.5), p(1.0, 9.0))) == (0.25, 0.0, 0.75, 1.0)
    ring = lambda a, b: F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))])
    donut = F.array(F.array(ring(0.0, 4.0), ring(1.0, 2.0)))
    c = lambda x, y: geo.polygon_covers(F.lit(x), F.lit(y), donut)
    assert tuple(one(spark, c(0.5, 0.5), c(1.5, 1.5), c(0.0, 2.0), c(4.0, 4.0), c(1.0, 1.5), c(5.0, 1.0))) == (True, False, True, True, True, False)


def test_interpolation(spark):
    pts = lambda *p: F.array(*[F.struct(F.lit(float(d)).alias("dist"), F.lit(s).alias("seconds")) for d, s in p])
    f = lambda points, x: enrich.interpolate(points, F.lit(float(x)))
    a, b, c = pts((0, 100), (10, 200)), pts((0, 0), (5, 50), (5, 70), (10, 100)), pts((5, 1))
    assert tuple(one(spark, f(a, 5), f(a, 0), f(a, 10), f(a, 11), f(a, -1), f(b, 5), f(c, 5))) == (150.0, 100.0, 200.0, None, None, 50.0, None)


def test_cooldown_in_batch_and_step(spark):
    windows = [60, 120, 180, 720, 780, 840, 1500, 1560]
    (batch,) = one(spark, detect.cooldown_fold(F.array(*[F.lit(w).cast("long") for w in windows])))
    out, n, last, alert = [], 0, None, None
    for w in windows:
        fires, n, last, alert = detect.cooldown_step(n, last, alert, w)
        out += [w] * fires
    assert batch == out == [120, 780, 1560]


def position(v, ts, dist, seq=10, lat=47.6, lon=-122.3):
    return (v, dt.datetime.fromtimestamp(ts, dt.timezone.utc), f"t{v}", "r", 0, "R", lat, lon, float(dist), 5, seq)


POSITION = "vehicle_id string, position_timestamp timestamp, trip_id string, route_id string, direction_id int, route_short_name string, latitude double, longitude double, shape_dist_traveled double, schedule_deviation_seconds int, current_stop_sequence int"


def test_detection_gates_and_pairs(spark):
    rows = [position("a", 10, 5000), position("a", 30, 5100), position("b", 40, 6099.0), position("c", 41, 7099.0), position("d", 5, 99), position("e", 6, 200, 3), position("f", 7, 400, None), position("g", 8, 7150, lat=47.7)]
    df = spark.createDataFrame(rows, POSITION)
    found = detect.adjacent_pairs(detect.gates(detect.latest_in_window(detect.parse_records(df))))
    assert [(r.vehicle_id_a, r.vehicle_id_b, r.gap_ft, r.window_end) for r in found.collect()] == [("a", "b", 999.0, 60)]
    two = spark.createDataFrame(rows + [position("a", 70, 5100), position("b", 80, 5500)], POSITION)
    assert [(r.vehicle_id_a, r.window_end) for r in detect.detect(two).collect()] == [("a", 120)]


def test_stream_of_pairs_equals_batch(spark, tmp_path):
    rows = [position(v, 60 * m + s, 1000 * k + 37 * m) for m in range(30) for k, (v, s) in enumerate((("a", 5), ("b", 15), ("c", 50)))]
    df = spark.createDataFrame(rows, POSITION)
    batch = detect.adjacent_pairs(detect.gates(detect.latest_in_window(detect.parse_records(df), Bunching(gap_ft=1100.0)), Bunching(gap_ft=1100.0)), Bunching(gap_ft=1100.0))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = jobs.windowed_pairs(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), Bunching(gap_ft=1100.0))
    found = jobs.run_available(stream, str(tmp_path)).collect()
    want = {(r.vehicle_id_a, r.vehicle_id_b, r.window_end, r.gap_ft) for r in batch.collect() if r.window_end <= 60 * 29 + 50 - 360}
    assert {(r.vehicle_id_a, r.vehicle_id_b, r.window_end, r.gap_ft) for r in found} == want and want


def test_accuracy_edges(spark):
    p = [("2026-09-22", "t", "s", i, i + lead) for i, lead in ((1000, 600), (1400, -60), (1500, 3600), (1501, 3601), (2000, 60))] + [("2026-09-22", "t", "s", None, 5)]
    o = [("20260922", "t", "s", "STOPPED_AT", "r", "R", 2000), ("20260922", "t", "s", "STOPPED_AT", "r", "R", 2500), ("20260922", "t", "s", "IN_TRANSIT_TO", "r", "R", 10), ("20260923", "t", "s", "STOPPED_AT", "r", "R", 3000)]
    P = spark.createDataFrame(p, "start_date string, trip_id string, stop_id string, issued_at long, predicted_arrival long")
    O = spark.createDataFrame(o, "start_date string, trip_id string, stop_id string, current_status string, route_id string, route_short_name string, observed_at long")  # noqa: E741
    P, O = accuracy.parse_predictions(P), accuracy.parse_observations(O)  # noqa: E741
    rows = sorted((r.issued_at, r.lead_bucket, r.error_s) for r in accuracy.join_arrivals(P, O).collect())
    assert rows == [(1000, "10-15m", -400), (1400, "past", -660), (1500, "45-60m", 3100)]
    assert accuracy.join_arrivals(P, O, Accuracy(keep_negative_lead=False)).count() == 2
    many = spark.createDataFrame([("20260922", "t", "s", i, i + 100) for i in range(145)], "start_date string, trip_id string, stop_id string, issued_at long, predicted_arrival long")
    assert sorted(r.issued_at for r in accuracy.join_arrivals(accuracy.parse_predictions(many), O).collect()) == list(range(25, 145))
    out, seen, waiting = jobs.arrivals_step(("d", "t", "s"), [(1000, 1000, 1600, None), (2000, None, None, 2000), (2100, 1900, 1950, None)], None, [], Accuracy())
    assert [r[3:] for r in out] == [(1000, 1600, 2000), (1900, 1950, 2000)] and seen == 2000 and waiting == []


def test_value_dedupe_and_upsert(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["A", "A", "B", None, None, "A"])] + [(2, 0, None)], "k int, i int, v string")
    assert sorted((r.k, r.i) for r in keyed.value_dedupe(df, ["k"], ["i"], ["v"]).collect()) == [(1, 0), (1, 2), (1, 3), (1, 5), (2, 0)]


def test_merge_partitions_is_idempotent(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, n int, seq int, event_date string")
    path = f"{tmp_path}/table"
    sinks.merge_partitions(rows(("a", 1, 1, "2026-01-01"), ("b", 2, 1, "2026-01-02")), path, ["k"], "seq")
    for _ in range(2):
        sinks.merge_partitions(rows(("a", 5, 2, "2026-01-01"), ("c", 3, 1, "2026-01-01"), ("c", 4, 2, "2026-01-01")), path, ["k"], "seq")
    assert sorted((r.k, r.n) for r in spark.read.parquet(path).collect()) == [("a", 5), ("b", 2), ("c", 4)]
    assert sinks.partitions_to_drop(["p_20260101", "p_20260102", "p_default", "p_2026"], "20260102") == ["p_20260101"]


def test_static_and_exports(spark, tmp_path):
    (tmp_path / "trips.txt").write_text("﻿trip_id,route_id,extra\nt1,r1,x\nt2,,y\n", encoding="utf-8")
    rows = static.read_member(spark, str(tmp_path / "trips.txt"), "trips", 7).orderBy("trip_id").collect()
    assert [(r.version_id, r.trip_id, r.route_id, r.shape_id) for r in rows] == [(7, "t1", "r1", None), (7, "t2", None, None)]
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = lambda n, kind, c: {"properties": {"neigh_num": n, "neighborhood_name": "x"}, "geometry": {"type": kind, "coordinates": c}}
    (tmp_path / "n.json").write_text(json.dumps({"features": [feature(1, "Polygon", [ring]), feature(2, "MultiPolygon", [[ring], [ring]])]}))
    assert [len(r.polygons) for r in static.read_neighborhoods(spark, str(tmp_path / "n.json"), 2).orderBy("neigh_num").collect()] == [1, 2]
    with pytest.raises(ValueError):
        static.read_neighborhoods(spark, str(tmp_path / "n.json"), 3)
    df = spark.createDataFrame([(1.0, 2.0, "s")], "longitude double, latitude double, stop string")
    assert sinks.export_geojson(df, {"a": 1}) == sinks.export_geojson(df, {"a": 1}) and json.loads(sinks.export_geojson(df, {}))["features"][0]["geometry"]["coordinates"] == [1.0, 2.0]


def test_versions(spark):
    rows = [(1, True, None, 1), (2, True, None, 2), (3, False, None, 3), (4, True, "2026-01-01", 4)]
    assert enrich.current_version(spark.createDataFrame(rows, "version_id long, ready boolean, retired_at string, loaded_at int")) == 2


def test_archive(spark, tmp_path):
    for epoch, etag in ((1790000000, '"a"'), (1790000100, '"b"'), (1790003700, '"c"')):
        f = tmp_path / archive.object_name("vehicle_positions", epoch, etag, "pb")
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(etag.encode())
    rows = archive.scan(spark, str(tmp_path), "vehicle_positions", 1790000000, 1790003700).collect()
    assert [(r.fetched_s, r.feed_etag, bytes(r.content)) for r in rows] == [(1790000000, '"a"', b'"a"'), (1790000100, '"b"', b'"b"')]
    assert archive.scan(spark, str(tmp_path), "vehicle_positions", 0, 3600).count() == 0


def test_decoders(spark):
    p = queries_more._part
    trip = p(1, b"trip") + p(5, b"route") + p(3, b"20260922")
    stop = lambda n, s: p(2, p(1, n) + p(4, s) + p(2, p(1, (1 << 64) - 30) + p(2, 1790000000)))
    update = p(2, p(1, b"e") + p(3, p(1, trip) + p(4, 0) + stop(1, b"s1") + stop(2, b"s2")))
    df = spark.createDataFrame([("x", bytearray(update)), ("y", bytearray(update[:-4])), ("z", bytearray(b""))], "feed_etag string, content binary")
    rows = realtime.decode("trip_updates", df).orderBy("feed_etag", "stop_id").collect()
    assert [(r.feed_etag, r.stop_id, r.arrival_delay, r.trip_timestamp, r.reason) for r in rows] == [("x", "s1", -30, None, None), ("x", "s2", -30, None, None), ("y", None, None, None, "malformed_payload")]
    alerts = spark.createDataFrame([("a", '{"entity":[{"id":"1","alert":{"cause":"X","active_period":[]}},{"alert":{}}]}'), ("b", "{nope")], "feed_etag string, content string")
    assert sorted((r.feed_etag, r.alert_id, r.reason) for r in realtime.decode_alerts(alerts).collect()) == [("a", "1", None), ("b", None, "malformed_payload")]


def test_schemas(spark):
    df = spark.createDataFrame([tuple([None] * len(ALERT))], ALERT)
    assert conform(df.select(*reversed(df.columns)), ALERT).columns == ALERT.fieldNames()
    with pytest.raises(SchemaMismatch):
        conform(df.drop("gap_ft"), ALERT)
    old = {1: ("id", "string", True), 2: ("n", "int32", True), 3: ("x", "double", True), 4: ("gone", "string", True), 5: ("moved", "string", True)}
    new = {1: ("id", "string", False), 2: ("n", "int64", True), 3: ("x", "string", True), 6: ("moved", "string", True), 7: ("fresh", "string", True)}
    found = {(n, s) for s, n, _ in schema_diff(old, new)}
    assert found == {(1, Severity.SEMANTIC_HAZARD), (2, Severity.SEMANTIC_HAZARD), (3, Severity.WIRE_INCOMPATIBLE), (4, Severity.SEMANTIC_HAZARD), (5, Severity.SEMANTIC_HAZARD), (6, Severity.WIRE_INCOMPATIBLE), (7, Severity.BENIGN)}


def test_run_settings():
    RunSettings(mode="variant", source="replay.enriched", target="replay.alerts", min_stop_sequence=4)
    for bad in ({"mode": "x"}, {"target": "replay.alerts"}, {"mode": "baseline", "source": "replay.a", "target": "replay.b"}, {"mode": "variant"}):
        with pytest.raises(ValueError):
            RunSettings(**bad)


def minutes(spark, seen):
    rows = [(f"v{i}", dt.datetime.fromtimestamp(60 * m + 7, dt.timezone.utc), lag) for i, (m, lag) in enumerate(seen)]
    df = spark.createDataFrame(rows, "vehicle_id string, position_at timestamp, ingest_lag_s int")
    return df.withColumn("is_stale_timestamp", F.col("ingest_lag_s") > 3600)


def test_feed_health_and_increments(spark):
    live = [m for m in range(900) if m not in (5, *range(10, 14), *range(400, 412), *range(700, 790))]
    rows = [(m, 10 + m % 3) for m in live] + [(11, 3601), (411, 5000), (12, 3600)]
    positions = minutes(spark, rows)
    health = {r.minute: r for r in marts.feed_health(positions).collect()}
    at = lambda m: health[dt.datetime.fromtimestamp(60 * m, dt.timezone.utc).replace(tzinfo=None)].stall_minutes
    assert [at(m) for m in (5, 10, 11, 12, 13, 405, 0)] == [1, 2, 2, 0, 1, 12, 0]
    key = lambda df: sorted(map(tuple, df.collect()))
    mart = None
    for upto in (300, 407, 760, 900):
        part = positions.filter(F.unix_seconds("position_at") < 60 * upto)
        mart = incremental.feed_health(mart, part)
        assert key(mart) == key(marts.feed_health(part))
        mart = spark.createDataFrame(mart.collect(), mart.schema)
    assert quality.minutes_covered(marts.feed_health(positions)).count() == 0
    assert marts.stall_report(marts.feed_health(minutes(spark, [(0, 1), (1, 1)]))).first().stall_minutes == 0


def test_census_and_lags(spark):
    df = spark.createDataFrame([((None, "b"), 1), (("x", "c"), None)], "a struct<p: string, q: string>, n int")
    assert sorted((r.path, r.present) for r in census.field_census(df).collect()) == [("a.p", 1), ("a.q", 2), ("n", 1)]
    lags = spark.createDataFrame([("a", 5), ("b", 50), ("c", None)], "grp string, lag int")
    limits = spark.createDataFrame([(g, 10) for g in "abcd"], "grp string, max_lag int")
    assert sorted(r.grp for r in quality.lag_over(lags, limits).collect()) == ["b", "c", "d"]


def test_cap_counts_only_predictions_before_the_arrival(spark):
    """150 before the arrival and 130 after it: the newest 120 of the former are due."""
    p = spark.createDataFrame([("20240101", "t", "s", 1000 + i, 2000) for i in [*range(150), *range(200, 330)]], "service_day string, trip_id string, stop_id string, issued_at long, predicted_arrival long")
    o = spark.createDataFrame([("20240101", "t", "s", "1", "R1", 1180)], "service_day string, trip_id string, stop_id string, route_id string, route_short_name string, observed_at long")
    assert sorted(r.issued_at for r in accuracy.join_arrivals(p, o).collect()) == [1000 + i for i in range(30, 150)]



def test_windows_dropped_as_late_stay_out(spark, tmp_path):
    """The last file has a row that is days late; only the window that the last watermark leaves open comes from the batch form."""
    at = [(0, 100), (1, 200_000), (2, 200_400), (3, 200_500), (4, 50_000)]
    p = spark.createDataFrame([(i, "v", s, "1", 0) for i, s in at], "arrival int, vehicle_id string, position_s long, route_id string, direction_id int").withColumn("position_timestamp", F.timestamp_seconds("position_s"))
    stream = queries_more.streamed(spark, p, 4, "arrival")
    config = Bunching(window_s=3600)
    out = jobs.with_open_windows(jobs.tumbling_counts(stream, config), jobs.tumbling_counts(p, config), str(tmp_path))
    assert sorted((r.window_end, r.positions) for r in out.collect()) == [(3600, 1), (201_600, 3)]
