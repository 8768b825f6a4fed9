"""Versions of the schedule, published files, retention, streams and the command line."""

import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from headway import __main__ as cli
from headway import ship
from headway.config import Bunching
from headway.operators import census, detect, keyed, messages
from headway.plans import exports, incremental, marts
from headway.sources import enriched, sinks, store, streams, versions
from headway.streaming import jobs

UTC = dt.timezone.utc


def schedule(path, **members):
    given = {
        "routes": "route_id,route_short_name\nr1,7\n", "trips": "﻿trip_id,route_id,service_id\nt1,r1,wk\nt2,r1,wk\n", "stops": "stop_id,stop_name,stop_lat,stop_lon\ns1,One,47.6,-122.3\n",
        "stop_times": 'trip_id,stop_id,stop_sequence,arrival_time\nt1,s1,1,"24:01:00"\n', "shapes": "shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon\nx,1,47.6,-122.3\n", "feed_info": "feed_version,feed_start_date\nv9,20260901\n",
    } | members
    with zipfile.ZipFile(path, "w") as z:
        for name, text in given.items():
            if text is not None:
                z.writestr(f"google/{name}.txt", text)


def test_versions(spark, tmp_path, capsys):
    path, now = f"{tmp_path}/static", dt.datetime(2026, 9, 1, tzinfo=UTC)
    schedule(tmp_path / "a.zip")
    schedule(tmp_path / "b.zip", trips="trip_id,route_id\nt9,r1\n")
    assert versions.load(spark, f"{tmp_path}/a.zip", path, "e1", now=now) == 1
    assert versions.load(spark, f"{tmp_path}/a.zip", path, "e1", now=now) is None  # one etag is one version
    assert versions.load(spark, f"{tmp_path}/a.zip", path, "e1", force=True, now=now) == 1
    assert versions.load(spark, f"{tmp_path}/b.zip", path, "e2", now=now + dt.timedelta(days=1)) == 2
    rows = versions.status(spark, path).collect()
    assert [(r.version_id, r.label, r.ready, r.mark, r.trips) for r in rows] == [(2, "v9", True, "current", 1), (1, "v9", True, None, 2)]
    assert spark.read.parquet(f"{path}/trips/version_id=1").count() == 2 and spark.read.parquet(f"{path}/stop_times/version_id=1").first().arrival_time == "24:01:00"
    assert versions.retire(spark, path, 2) and not versions.retire(spark, path, 2) and not versions.retire(spark, path, 5)
    assert [(r.version_id, r.mark) for r in versions.status(spark, path).collect()] == [(2, "retired"), (1, "current")]
    assert cli.main(["static", path, "--status"]) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["mark"] == "current"
    assert cli.main(["static", path, "--retire", "7"]) == 1
    schedule(tmp_path / "c.zip", stops=None)
    with pytest.raises(ValueError, match="stops"):
        versions.load(spark, f"{tmp_path}/c.zip", path, "e3")


def mart_tables(spark):
    day = dt.date(2026, 9, 7)
    alerts = spark.createDataFrame(
        [(day, 16, "7", 100.0, 47.6, -122.3, "s1", "One"), (day, 9, "7", 300.0, 47.7, -122.4, "s1", "One"), (day, 17, None, 50.0, None, None, None, None), (day + dt.timedelta(days=5), 1, "8", 10.0, 47.5, -122.0, "s2", "Two"), (dt.date(2026, 9, 20), 1, "8", 10.0, 47.5, -122.0, "s2", "Two")],
        "local_date date, local_hour int, route_short_name string, gap_ft double, latitude double, longitude double, stop_id string, stop_name string",
    )
    minutes = [(dt.datetime(2026, 9, 7, 0, m), 0 if m < 2 else 5, m < 2, None if m < 2 else m) for m in range(8)]
    health = spark.createDataFrame(minutes, "minute_local timestamp_ntz, positions long, is_silent boolean, median_lag_s int")
    histogram = spark.createDataFrame([(day, "0-2m", 10, 2), (day, "0-2m", 21, 2), (day, "45-60m", 200, 1), (day, "past", 5, 1)], "observed_day date, lead_bucket string, abs_error_s int, predictions long")
    daily = spark.createDataFrame([(day, "0-2m", 4, 10, 0), (day, "45-60m", 1, 200, 2800), (day, "past", 1, -5, -30)], "observed_day date, lead_bucket string, predictions long, sum_error_s long, min_lead_time_s int")
    return {"alerts": alerts, "health": health, "histogram": histogram, "daily": daily}


def test_published_files(spark, tmp_path, capsys):
    tables, out = mart_tables(spark), f"{tmp_path}/out"
    first, last, now = dt.date(2026, 9, 7), dt.date(2026, 9, 30), dt.datetime(2026, 9, 15, 5, tzinfo=UTC)
    assert exports.publish(spark, out, tables, first, last, now) == (first, dt.date(2026, 9, 13))
    texts = {n: (tmp_path / "out" / n).read_text() for n in exports.FILES}
    found = {n: json.loads(t) for n, t in texts.items()}
    assert all(f["window"] == {"first": "2026-09-07", "last": "2026-09-13"} for f in found.values())
    assert found["bunching_by_hour.json"]["data"]["weekday"][16] == 0.2 and found["bunching_by_hour.json"]["data"]["weekend"][1] == 0.5
    assert [(r["route"], r["alerts"], r["per_day"], r["median_gap_ft"]) for r in found["routes.json"]["data"]] == [("7", 2, 0.29, 200.0), ("8", 1, 0.14, 10.0), (None, 1, 0.14, 50.0)]
    stops = found["hotspots.geojson"]["features"]
    assert [(f["properties"]["stop_id"], f["properties"]["alerts"], f["properties"]["routes"], f["geometry"]["coordinates"]) for f in stops] == [("s1", 2, [["7", 2]], [-122.35, 47.65]), ("s2", 1, [["8", 1]], [-122.0, 47.5])]
    assert [(p["lead_bucket"], p["median_abs_error_s"], p["mean_error_s"]) for p in found["prediction_curve.json"]["data"]] == [("past", 5, -5), ("0-2m", 16, 3), ("45-60m", 200, 200)]
    assert found["feed_health.json"]["data"] == [{"date": "2026-09-07", "live_share": 0.75, "median_ingest_lag_s": 5, "minutes": 8, "positions": 30, "silent_minutes": 2}]
    k = found["kpis.json"]["data"]
    assert (k["days"], k["alerts"], k["alerts_per_day"], k["located_share"], k["pm_peak_share"], k["live_share"], k["median_abs_error_short_s"], k["median_abs_error_long_s"]) == (7, 4, 0.6, 0.75, 0.5, 0.75, 16, 200)
    exports.publish(spark, out, tables, first, last, now)
    assert texts == {n: (tmp_path / "out" / n).read_text() for n in exports.FILES}  # the same bytes again
    with pytest.raises(ValueError):
        exports.publish(spark, out, tables, dt.date(2026, 9, 20), last, now)
    for n, df in tables.items():
        df.write.parquet(f"{tmp_path}/tables/{n}")
    assert cli.main(["export", f"{tmp_path}/tables", out, "--first", "2026-09-07", "--last", "2026-09-13"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["last"] == "2026-09-13"


def test_retention(spark, tmp_path, capsys):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(f"2026-09-{d:02d}", d) for d in range(1, 11)], "event_date string, n int")
    sinks.write_clustered(df, path, "event_date", "n")
    store.put(spark, f"{path}/event_date=__HIVE_DEFAULT_PARTITION__/keep", b"x")
    assert sinks.drop_partitions(spark, path, "2026-09-04") == ["2026-09-01", "2026-09-02", "2026-09-03"]
    assert cli.main(["drop", path, "--as-of", "2026-09-10", "--days", "4"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"dropped": ["2026-09-04", "2026-09-05"]}
    assert "event_date=__HIVE_DEFAULT_PARTITION__" in store.names(spark, path) and store.names(spark, f"{tmp_path}/none") == []
    assert not store.put(spark, f"{path}/event_date=__HIVE_DEFAULT_PARTITION__/keep", b"y", overwrite=False) and store.get(spark, f"{path}/event_date=__HIVE_DEFAULT_PARTITION__/keep") == b"x"


def test_alert_mart_restarts(spark):
    """An alert that found no place is built again for two days; old ones that did stay as they are."""
    alerts = spark.createDataFrame([(f"a{i}", "v", "w", "t", "t", 1000 * i + 60, dt.date(2026, 9, 7)) for i in range(5)], "alert_id string, vehicle_id_a string, vehicle_id_b string, trip_id_a string, trip_id_b string, window_end long, local_date date")
    position = lambda i, x: [(v, "t", 1000 * i + 30, x, -122.0, "s1", 3) for v in "vw"]
    frame = lambda rows: spark.createDataFrame(rows, "vehicle_id string, trip_id string, position_s long, latitude double, longitude double, stop_id string, current_stop_sequence int")
    stops = spark.createDataFrame([("s1", 1, "One")], "stop_id string, version_id int, stop_name string")
    first = incremental.placed_alerts(None, alerts.filter("window_end < 3500"), frame(position(0, 47.0) + position(1, 47.0)), stops)
    first = spark.createDataFrame(first.collect(), first.schema)
    later = frame([r for i in range(5) for r in position(i, 47.5)])
    found = {r.alert_id: (r.latitude, r.day_type) for r in incremental.placed_alerts(first, alerts, later, stops).collect()}
    assert found == {"a0": (47.0, "weekday"), "a1": (47.0, "weekday"), "a2": (47.5, "weekday"), "a3": (47.5, "weekday"), "a4": (47.5, "weekday")}
    assert marts.placed_alerts(alerts, later, stops).count() == 5


def test_repeated_keys_and_one_sided_fields(spark):
    live = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, None), (None, 7, "z")], "k int, at int, v string")
    replay = spark.createDataFrame([(1, 2, "y", 1), (1, 1, "q", 1), (1, 0, "r", 1), (2, 1, "n", None), (None, 7, "z", 3)], "k int, at int, v string, extra int")
    assert {r.field: r.mismatches for r in keyed.field_mismatches(live, replay, ["k"], order=["at"]).collect()} == {"at": 0, "v": 1, "extra": 2}


def test_census_of_arrays(spark):
    df = spark.createDataFrame([([("a", [1, 2]), (None, [])],), ([],), (None,), ([("b", None), ("a", [9])],)], "stops array<struct<name: string, at: array<int>>>")
    assert {r.path: (r.present, r.pct, r.samples) for r in census.field_census(df, 2).collect()} == {"stops[].name": (2, 50.0, "a,b"), "stops[].at[]": (2, 50.0, "1,2")}


def test_messages(spark):
    rows = spark.createDataFrame([("k", t, v) for t, v in ((0, "a"), (10, "a"), (25, None), (40, None), (41, "a"))], "k string, at long, v string")
    assert [tuple(r) for r in messages.cadence(rows, ["k"], "at", []).collect()] == [("k", 1, 15, 15)]
    assert {r.k: (r.seen, r.suppressed) for r in messages.suppression(rows, ["k"], ["at"], "v", ["k"]).collect()} == {"k": (5, 0.4)}
    topic = spark.createDataFrame([("a", b"1", 0), ("a", b"2", 1), ("b", b"1", 0), ("b", None, 1)], "key string, value binary, offset int")
    assert [(r.key, bytes(r.value)) for r in streams.newest_by_key(topic, ["offset"]).collect()] == [("a", b"2")]
    assert streams.kafka_options("h:1", "t")["failOnDataLoss"] == "true" and streams.kafka_options("h:1", "t", group="g")["kafka.group.id"] == "g"


POSITION = "vehicle_id string, position_timestamp long, trip_id string, route_id string, direction_id int, route_short_name string, latitude double, longitude double, shape_dist_traveled double, schedule_deviation_seconds int, current_stop_sequence int"


def two_vehicles(minutes, start=0):
    return [(v, start + 60 * m + s, f"t{v}", "1", 0, "R1", 47.6, -122.3, 1000.0 + 10 * m + d, 5, 9) for m in minutes for v, s, d in (("a", 5, 0.0), ("b", 15, 50.0))]


def test_stream_job_over_restarts(spark, tmp_path):
    """Three runs of one job, each over new files: together they give the alerts of the batch form."""
    config, rows = Bunching(), two_vehicles([*range(25), *range(40, 60)])
    (tmp_path / "in").mkdir()
    for part in (rows[:30], rows[30:52], rows[52:]):
        enriched.encode_enriched(spark.createDataFrame(part, POSITION), 3).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("key string, value binary").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        jobs.bunching_job(stream, f"{tmp_path}/out", config).awaitTermination()
    found = sorted(r.window_end for r in spark.read.parquet(f"{tmp_path}/out/alerts").collect())
    df = spark.createDataFrame(rows, POSITION).withColumn("position_timestamp", F.timestamp_seconds("position_timestamp"))
    closed = max(r[1] for r in rows) - config.lateness_s
    pairs = detect.adjacent_pairs(detect.gates(detect.latest_in_window(detect.parse_records(df)))).filter(F.col("window_end") <= closed)
    assert found == sorted(r.window_end for r in detect.cooled_alerts(pairs).collect()) and len(found) >= 3


def test_stream_pairs_nobody_with_itself(spark, tmp_path):
    rows = [("a", 10, "t2"), ("a", 10, "t1"), ("b", 12, "t3"), ("a", 2000, "t1")]
    df = spark.createDataFrame([(v, t, trip, "1", 0, "R1", 47.6, -122.3, 1000.0, 5, 9) for v, t, trip in rows], POSITION).withColumn("position_timestamp", F.timestamp_seconds("position_timestamp"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    found = jobs.run_available(jobs.windowed_pairs(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")), str(tmp_path)).collect()
    assert [(r.vehicle_id_a, r.trip_id_a, r.vehicle_id_b, r.deviation_a, r.route_short_name) for r in found] == [("a", "t1", "b", 5, "R1")]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    """A row 300 s behind still counts, one far behind is dropped, and the stream says so."""
    from headway.plans.queries_more import streamed

    at = [(0, 10_000), (1, 9_700), (1, 10_050), (2, 5_000), (3, 20_000)]
    p = spark.createDataFrame([(i, "v", s, "1", 0) for i, s in at], "arrival int, vehicle_id string, position_s long, route_id string, direction_id int").withColumn("position_timestamp", F.timestamp_seconds("position_s"))
    q = jobs.tumbling_counts(streamed(spark, p, 4, "arrival"), Bunching()).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).outputMode("append").start()
    q.awaitTermination()
    assert sum(o["numRowsDroppedByWatermark"] for b in q.recentProgress for o in b["stateOperators"]) == 1
    assert sorted((r.window_end, r.positions) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(9_720, 1), (10_020, 1), (10_080, 1)]


def test_state_expires(spark, tmp_path):
    """The last value of a key is forgotten after its time to live, so the same value passes again."""
    import time

    rows = lambda i: spark.createDataFrame([("k", i, i, "x")], "key string, id long, at long, value string")
    jobs.use_rocksdb(spark)
    rows(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("key string, id long, at long, value string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = jobs.value_dedupe(stream, ttl_s=20).writeStream.format("memory").queryName("expiring").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    try:
        until = lambda n: next((True for _ in range(90) if spark.sql("select * from expiring").count() >= n or time.sleep(1)), False)
        assert until(1)
        rows(1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(30)  # past its time to live, and past the batch of the repeated value
        rows(2).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assert until(2)
        assert [r.id for r in spark.sql("select id from expiring order by id").collect()] in ([0, 2], [0, 1])  # the repeat itself may come late on a slow machine
    finally:
        q.stop()


def test_fixture_comes_back(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None, dt.date(2026, 9, 2)), (1, "a", 0.5, dt.date(2026, 9, 1))], "n int, s string, x double, d date")
    sinks.fixture_csv(df, f"{tmp_path}/f", ["n"])
    assert [tuple(r) for r in sinks.read_fixture(spark, f"{tmp_path}/f").collect()] == [(1, "a", 0.5, dt.date(2026, 9, 1)), (2, "b", None, dt.date(2026, 9, 2))]
    store.put(spark, f"{tmp_path}/f.manifest.json", store.get(spark, f"{tmp_path}/f.manifest.json").replace(b'"rows": 2', b'"rows": 3'))
    with pytest.raises(ValueError):
        sinks.read_fixture(spark, f"{tmp_path}/f")


def test_package_ships_whole():
    with zipfile.ZipFile(io.BytesIO(ship.packed())) as z:
        assert "headway/operators/detect.py" in z.namelist() and ship.packed() == ship.packed()
