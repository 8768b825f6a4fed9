"""From payloads to enriched records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway import __main__ as cli
from headway import ingest
from headway.plans import calendar
from headway.plans.queries_more import _part as part
from headway.sources import archive

UTC = dt.timezone.utc


def vehicle(name, at, lat, lon, trip="t1", status=2):
    body = part(1, part(1, trip.encode()) + part(3, b"20260914")) + part(2, part(1, lat) + part(2, lon)) + part(4, status) + part(5, at) + part(8, part(1, name.encode()))
    return part(2, part(1, b"e") + part(4, body))


@pytest.fixture()
def root(tmp_path):
    polls = {1790000000: vehicle("a", 100, 47.6, -122.3) + vehicle("b", 100, 0.0, 0.0), 1790000010: vehicle("a", 100, 47.6, -122.3), 1790000020: vehicle("a", 160, 47.61, -122.3), 1790000030: b"\xff\xff"}
    for k, (epoch, content) in enumerate(polls.items()):
        f = tmp_path / archive.object_name("vehicle_positions", epoch, f"e{k}", "pb")
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(content)
    return str(tmp_path)


def test_payloads_to_records(spark, root, capsys, tmp_path):
    records, letters = ingest.process(spark, root, "vehicle_positions", 1790000000, 1790000100)
    assert sorted((r.vehicle_id, r.position_timestamp.replace(tzinfo=UTC).timestamp()) for r in records.collect()) == [("a", 100), ("a", 160)]
    assert sorted(json.loads(r.value)["reason"] for r in letters.collect()) == ["malformed_payload", "position_out_of_bounds"]
    arguments = ["ingest", "--feed", "vehicle_positions", "--root", root, "--start", "2026-09-21T14:13:20Z", "--end", "2026-09-21T15:00:00Z", "--out", f"{tmp_path}/out"]
    assert cli.main([*arguments, "--dry-run"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"records": 2, "dead_letters": 2}
    with pytest.raises(ValueError):
        cli.main(["replay", *arguments[1:]])


def test_enrichment_end_to_end(spark):
    origin = int(dt.datetime(2026, 9, 14, 7, tzinfo=UTC).timestamp())
    at = lambda s: dt.datetime.fromtimestamp(origin + s, UTC)
    positions = spark.createDataFrame(
        [("a", at(3600 + 90), "t1", 47.6, -122.25, "20260914"), ("b", at(50_000), "t1", 47.6, -122.2, "20260914"), ("c", at(0), "nope", 47.6, -122.3, "20260914"), ("d", at(3600), "t2", 47.9, -122.3, "garbage")],
        "vehicle_id string, position_timestamp timestamp, trip_id string, latitude double, longitude double, start_date string",
    )
    frame = lambda rows, ddl: spark.createDataFrame(rows, "version_id long, " + ddl)
    static = {
        "feed_version": frame([(1, True, None, 1), (2, True, None, 2), (3, False, None, 3)], "ready boolean, retired_at string, loaded_at int"),
        "trips": frame([(v, t, "r1", "wk", "Downtown", "b1", "s1") for v in (1, 2) for t in ("t1", "t2")], "trip_id string, route_id string, service_id string, trip_headsign string, block_id string, shape_id string"),
        "routes": frame([(1, "r1", "old", "x", 3), (2, "r1", "7", "Seven", 3)], "route_id string, route_short_name string, route_long_name string, route_type int"),
        "stop_times": frame([(2, "t1", 1, "1:00:00", 0.0), (2, "t1", 2, "1:02:00", 1000.0), (2, "t1", 3, "soon", 1500.0)], "trip_id string, stop_sequence int, arrival_time string, shape_dist_traveled double"),
        "shapes": frame([(2, "s1", 2, 47.6, -122.2, 1000.0), (2, "s1", 1, 47.6, -122.3, 0.0)], "shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double, shape_dist_traveled double"),
    }
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((-122.26, 47.59), (-122.24, 47.59), (-122.24, 47.61), (-122.26, 47.61), (-122.26, 47.59))])
    hoods = spark.range(2).select((F.col("id") + 5).cast("int").alias("neigh_num"), F.concat(F.lit("n"), "id").alias("neighborhood_name"), F.array(F.array(ring)).alias("polygons"))
    done, letters = ingest.enrich_current(positions, static, hoods, F.lit(at(9000)))
    rows = {r.vehicle_id: r for r in done.collect()}
    assert set(rows) == {"a", "b", "d"} and [json.loads(r.value)["entity_key"] for r in letters.collect()] == ["c"]
    a = rows["a"]
    assert (round(a.shape_dist_traveled, 6), a.schedule_deviation_seconds, a.route_short_name, a.neighborhood_num, a.static_feed_version) == (500.0, 30, "7", 5, 2)
    assert rows["b"].schedule_deviation_seconds is None and rows["b"].neighborhood_num is None
    assert rows["d"].schedule_deviation_seconds is None
    first, _ = ingest.enrich_current(positions, static, hoods, F.lit(at(9000)), version=1)
    assert "schedule_deviation_seconds" not in first.columns


def test_closed_windows(spark):
    now = dt.datetime(2026, 9, 15, 5, tzinfo=UTC)  # still the 14th on the coast
    assert calendar.closed_last(now) == dt.date(2026, 9, 13)
    assert calendar.closed_window(dt.date(2026, 9, 7), dt.date(2026, 9, 30), now) == (dt.date(2026, 9, 7), dt.date(2026, 9, 13))
    with pytest.raises(ValueError):
        calendar.closed_window(dt.date(2026, 9, 14), None, now)
    days = calendar.window_days(spark, dt.date(2026, 9, 7), dt.date(2026, 9, 13))
    assert {r.day_type: r.days for r in calendar.days_by_type(days).collect()} == {"weekday": 5, "saturday": 1, "sunday": 1}
    assert [calendar.parse_duration(x) for x in ("30s", "5m", "24h", "7d")] == [30, 300, 86_400, 604_800]
    with pytest.raises(ValueError):
        calendar.parse_duration("1w")


def test_enriched_wire():
    from headway.sources import enriched

    record = {"vehicle_id": "é", "position_timestamp": 5, "schedule_deviation_seconds": -30, "speed": 0.0, "current_stop_sequence": 0, "direction_id": 0}
    raw = enriched.encoded(record, 3)
    back = enriched.decoded(raw)
    assert (back["vehicle_id"], back["schedule_deviation_seconds"], back["speed"], back["current_stop_sequence"], back["direction_id"], back["bearing"], back["trip_id"]) == ("é", -30, 0.0, 0, 0, None, "")
    assert enriched.decoded(raw[:5] + b"\x02\x01\x00" + raw[6:])["vehicle_id"] == "é"  # an index array of two
    assert [enriched.decoded(x) for x in (None, b"{}", raw[:-1], b"\x01" + raw[1:])] == [None] * 4
