"""Staging views, versions, archives, retention, published figures and streaming jobs over the driver's tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import functions as F

from headway import ingest
from headway.config import Bunching, Warehouse
from headway.functions import text
from headway.operators import accuracy, detect, enrich, keyed, messages
from headway.plans import exports, incremental, marts, quality, report, roles
from headway.plans.define import Registry
from headway.plans.queries_core import health, numbers, seconds
from headway.plans.queries_joins import live_and_replay
from headway.plans.queries_more import _part, folder, payloads, streamed
from headway.plans.queries_report import RUNS_SQL, two_runs
from headway.sources import archive, enriched, realtime, sinks, store, streams, versions
from headway.streaming import jobs

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
table = roles.table
SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"


# --- staging ---


@query(
    "staging_alerts",
    f"""WITH {roles.ALERTS_SQL}, w AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', make_timestamp(window_end * 1000000))) AS wall FROM alerts)
SELECT alert_id, strftime(wall, '%Y-%m-%d %H:%M:%S') AS window_local, strftime(wall, '%Y-%m-%d') AS local_date, CAST(hour(wall) AS INTEGER) AS local_hour FROM w""",
)
def staging_alerts(spark, sf_dir):
    a = roles.alerts(spark, sf_dir).select("alert_id", F.timestamp_seconds("window_end").alias("window_end"))
    s = marts.staging_alerts(a)
    return s.select("alert_id", F.date_format("window_local", "yyyy-MM-dd HH:mm:ss").alias("window_local"), F.col("local_date").cast("string").alias("local_date"), "local_hour")


@query(
    "staging_accuracy",
    f"""WITH {roles.ACCURACY_SQL}, w AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', make_timestamp(observed_at * 1000000))) AS wall FROM accuracy)
SELECT trip_id, issued_at, predicted_arrival, strftime(strptime(service_day, '%Y%m%d'), '%Y-%m-%d') AS service_date, CAST(hour(wall) AS INTEGER) AS local_hour FROM w""",
)
def staging_accuracy(spark, sf_dir):
    a = roles.accuracy(spark, sf_dir)
    dated = a.withColumn("observed_at", F.timestamp_seconds("observed_at")).withColumn("start_date", F.date_format(F.to_date("service_day", "yyyyMMdd"), "yyyy-MM-dd"))
    return marts.staging_accuracy(dated).select("trip_id", "issued_at", "predicted_arrival", F.col("service_date").cast("string").alias("service_date"), "local_hour")


@query(
    "mart_feed_health",
    f"""WITH {roles.HEALTH_SQL} SELECT CAST(epoch(minute) AS BIGINT) AS minute, strftime(timezone('America/Los_Angeles', timezone('UTC', minute)), '%Y-%m-%d %H:%M') AS minute_local, positions, is_silent FROM health""",
)
def mart_feed_health(spark, sf_dir):
    h = seconds(marts.health_mart(health(spark, sf_dir)), "minute")
    return h.select("minute", F.date_format("minute_local", "yyyy-MM-dd HH:mm").alias("minute_local"), "positions", "is_silent")


@query(
    "dq_never_silent",
    f"""WITH {roles.HEALTH_SQL} SELECT CAST(epoch(minute) AS BIGINT) AS minute FROM health WHERE is_silent AND timezone('America/Los_Angeles', timezone('UTC', minute)) BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 02:59:00'""",
)
def dq_never_silent(spark, sf_dir):
    """Minutes of one night that were silent: the driver's table is thin, so there are some."""
    return seconds(quality.never_silent(marts.health_mart(health(spark, sf_dir)), "2024-01-10 00:00:00", "2024-01-10 02:59:00"), "minute").select("minute")


# --- the schedule ---


@query("version_resolve", "SELECT max(n_nationkey) AS version_id FROM nation WHERE n_nationkey % 5 <> 4 AND n_nationkey % 7 <> 0 AND n_regionkey = (SELECT max(n_regionkey) FROM nation WHERE n_nationkey % 5 <> 4 AND n_nationkey % 7 <> 0)")
def version_resolve(spark, sf_dir):
    """Nations as versions: some not ready, some retired; the region is the time of loading."""
    v = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("version_id"), (F.col("n_nationkey") % 5 != 4).alias("ready"), F.when(F.col("n_nationkey") % 7 == 0, F.lit("x")).alias("retired_at"), F.col("n_regionkey").alias("loaded_at"))
    return spark.createDataFrame([(enrich.current_version(v),)], v.select("version_id").schema)


@query(
    "shape_lines",
    """WITH p AS (SELECT CAST(user_id AS VARCHAR) AS shape_id, event_id, CAST((event_id * 631) % 60000 AS DOUBLE) AS d, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT shape_id, count(*) AS n_points, max(d) AS max_dist, CAST(min(event_id) AS DOUBLE) AS first_lon, CAST(max(event_id) AS DOUBLE) AS last_lon FROM p GROUP BY shape_id""",
)
def shape_lines(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("shape_id"), F.col("event_id").alias("shape_pt_sequence"), F.col("event_id").cast("double").alias("shape_pt_lon"), F.lit(47.5).alias("shape_pt_lat"), ((F.col("event_id") * 631) % 60000).cast("double").alias("shape_dist_traveled"))
    lines = enrich.shape_lines(e)
    return lines.select("shape_id", "n_points", "max_dist", F.get("line", F.lit(0))["lon"].alias("first_lon"), F.element_at("line", -1)["lon"].alias("last_lon"))


@query(
    "schedule_deviation",
    f"SELECT event_id, CAST(floor(epoch(ts)) - epoch(timezone('America/Los_Angeles', CAST(CAST(ts AS DATE) AS TIMESTAMP))) - event_id % 3600 AS INTEGER) AS late_s FROM events",
)
def schedule_deviation(spark, sf_dir):
    ts = F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")))
    late = enrich.deviation(ts, F.date_format("ts", "yyyyMMdd"), F.col("event_id") % 3600)
    return table(spark, sf_dir, "events").select("event_id", late.alias("late_s"))


@query("schedule_zip", "SELECT 'routes' AS name, count(*) AS n FROM nation UNION ALL SELECT 'trips', count(*) FROM supplier UNION ALL SELECT 'stops', count(*) FROM region UNION ALL SELECT 'stop_times', count(*) FROM nation UNION ALL SELECT 'shapes', count(*) FROM nation UNION ALL SELECT 'feed_info', 1")
def schedule_zip(spark, sf_dir):
    """Small tables as the members of a schedule's zip, loaded twice as one version; what its manifest counts."""
    import io
    import zipfile

    column = lambda name, key: [r[0] for r in table(spark, sf_dir, name).select(key).collect()]  # noqa: E731  a few hundred rows
    nations, out = column("nation", "n_nationkey"), io.BytesIO()
    members = {
        "routes": ["route_id,route_short_name", *(f"r{k},{k}" for k in nations)], "trips": ["trip_id,route_id", *(f"t{k},r1" for k in column("supplier", "s_suppkey"))], "stops": ["stop_id,stop_lat,stop_lon", *(f"s{k},47.6,-122.3" for k in column("region", "r_regionkey"))],
        "stop_times": ["trip_id,stop_id,stop_sequence,arrival_time", *(f"t1,s1,{k},25:00:00" for k in nations)], "shapes": ["shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon", *(f"x,{k},47.6,-122.3" for k in nations)], "feed_info": ["feed_version", "v1"],
    }
    with zipfile.ZipFile(out, "w") as z:
        for name, lines in members.items():
            z.writestr(f"{name}.txt", "\n".join(lines) + "\n")
    path = folder(spark)
    store.put(spark, f"{path}/feed.zip", out.getvalue())
    for _ in range(2):
        versions.load(spark, f"{path}/feed.zip", f"{path}/static", "etag")
    return versions.manifest(spark, f"{path}/static").filter("ready").select(F.explode("row_counts").alias("name", "n"))


@query("neighborhood_file", "SELECT CAST(r_regionkey AS INTEGER) AS neigh_num, r_name AS neighborhood_name, CAST(r_regionkey AS DOUBLE) AS least_lon, CAST(1 + r_regionkey % 2 AS BIGINT) AS polygons FROM region")
def neighborhood_file(spark, sf_dir):
    """Regions as GeoJSON squares, every other one of two polygons."""
    import json

    from headway.sources import static

    square = lambda k: [[[k, 0.0], [k + 1, 0.0], [k + 1, 1.0], [k, 0.0]]]
    rows = [(r[0], r[1]) for r in table(spark, sf_dir, "region").select("r_regionkey", "r_name").collect()]
    shape = lambda k: {"type": "MultiPolygon", "coordinates": [square(float(k)), square(k + 9.0)]} if k % 2 else {"type": "Polygon", "coordinates": square(float(k))}
    features = [{"properties": {"neigh_num": k, "neighborhood_name": n}, "geometry": shape(k)} for k, n in rows]
    path = f"{folder(spark)}/hoods.json"
    store.put(spark, path, json.dumps({"features": features}).encode())
    found = static.read_neighborhoods(spark, path, len(rows))
    least = F.array_min(F.transform(F.get(F.get("polygons", F.lit(0)), F.lit(0)), lambda c: c["lon"]))
    return found.select("neigh_num", "neighborhood_name", least.alias("least_lon"), F.size("polygons").cast("long").alias("polygons"))


# --- feeds ---


def updates(spark, sf_dir):
    """Events as encoded predictions, one stop a payload; some without a stop, some cut off."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("trip"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))

    def encode(batches):
        for batch in batches:
            content = []
            for r in batch.to_pylist():
                delay = -(r["event_id"] % 90)
                arrival = _part(1, delay & (1 << 64) - 1) + _part(2, r["at"])
                stop = _part(1, r["event_id"] % 40) + _part(2, arrival) + (_part(4, b"s%d" % (r["event_id"] % 9)) if r["event_id"] % 10 else b"")
                whole = _part(2, _part(1, b"e") + _part(3, _part(1, _part(1, r["trip"].encode())) + _part(2, stop)))
                content.append(whole[:-2] if r["event_id"] % 31 == 0 else whole)
            yield pa.record_batch([pa.array([str(i) for i in batch.column(0).to_pylist()]), pa.array(content, pa.binary())], names=["feed_etag", "content"])

    return e.mapInArrow(encode, "feed_etag string, content binary")


@query(
    "decode_trip_updates",
    f"""SELECT CAST(event_id AS VARCHAR) AS feed_etag, CASE WHEN event_id % 31 = 0 THEN 'malformed_payload' WHEN event_id % 10 = 0 THEN 'missing_required_field' END AS reason,
CASE WHEN event_id % 31 <> 0 THEN CAST(user_id AS VARCHAR) END AS trip_id, CASE WHEN event_id % 31 <> 0 THEN CAST(-(event_id % 90) AS DOUBLE) END AS arrival_delay, CASE WHEN event_id % 31 <> 0 THEN CAST({SECONDS} AS DOUBLE) END AS arrival_s FROM events""",
)
def decode_trip_updates(spark, sf_dir):
    rows = realtime.decode("trip_updates", updates(spark, sf_dir))
    return numbers(rows.select("feed_etag", "reason", "trip_id", "arrival_delay", F.unix_seconds("arrival_time").alias("arrival_s")), "arrival_delay", "arrival_s")


@query("archive_window", "SELECT CAST(1704067200 + 1800 * i AS BIGINT) AS fetched_s, '\"e' || i || '\"' AS feed_etag, CAST(i + 1 AS BIGINT) AS size FROM generate_series(0, 47) t(i) WHERE 1704067200 + 1800 * i >= 1704074400 AND 1704067200 + 1800 * i < 1704085200")
def archive_window(spark, sf_dir):
    """A day of payloads archived, some twice, and a few hours of it read back."""
    root = folder(spark)
    for i in [*range(48), 5, 6]:
        archive.put(spark, root, "vehicle_positions", 1704067200 + 1800 * i, f'W/"e{i}"', "pb", bytes(i + 1))
    return archive.scan(spark, root, "vehicle_positions", 1704074400, 1704085200).select("fetched_s", "feed_etag", F.octet_length("content").cast("long").alias("size"))


@query(
    "ingest_dedupe",
    f"""WITH {roles.POSITIONS}, ok AS (SELECT * FROM positions WHERE event_id % 97 <> 0 AND latitude BETWEEN 47.10 AND 47.85), seen AS (SELECT vehicle_id, position_s, lag(position_s) OVER (PARTITION BY vehicle_id ORDER BY position_s, event_id) AS p FROM ok)
SELECT vehicle_id, CAST(count(*) FILTER (p IS DISTINCT FROM position_s) AS BIGINT) AS published FROM seen GROUP BY vehicle_id""",
)
def ingest_dedupe(spark, sf_dir):
    """Position payloads, each fetched when its event was: a vehicle's record is new when its time has moved on."""
    p = payloads(spark, sf_dir).join(table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("feed_etag"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("fetched_s")), "feed_etag")
    records, _ = ingest.published("vehicle_positions", p)
    return records.groupBy("vehicle_id").agg(F.count("*").alias("published"))


@query("latest_message", "SELECT CAST(user_id AS VARCHAR) AS key, props AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_id % 8 <> 0")
def latest_message(spark, sf_dir):
    """A compacted topic: the newest value of each key, keys that end with a tombstone gone."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.when(F.col("event_id") % 8 != 0, F.col("props")).alias("value"), "ts", "event_id")
    return streams.newest_by_key(e, ["ts", "event_id"])


# --- retention, upserts, differences ---


@query("drop_partitions", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') || '-01' AS day FROM orders WHERE o_orderdate >= DATE '1997-01-01'")
def drop_partitions(spark, sf_dir):
    """Orders by month, written in order of time within a partition; partitions before 1997 are dropped."""
    path = folder(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("event_date"))
    sinks.write_clustered(o, path, "event_date", "o_orderdate")
    sinks.drop_partitions(spark, path, "1997-01-01")
    return spark.read.parquet(path).select(F.col("event_date").cast("string").alias("day")).distinct()


@query("upsert_alerts", f"WITH {roles.ALERTS_SQL} SELECT vehicle_id_a, vehicle_id_b, window_end, max(gap_ft + CASE WHEN window_end // 3600 % 2 = 0 THEN 1 ELSE 0 END) AS gap_ft FROM alerts GROUP BY ALL")
def upsert_alerts(spark, sf_dir):
    """All alerts, then half of them again with another gap, then the same again."""
    a, path = roles.alerts(spark, sf_dir).select("vehicle_id_a", "vehicle_id_b", "window_end", "gap_ft"), folder(spark)
    again = a.filter(F.floor(F.col("window_end") / 3600) % 2 == 0).withColumn("gap_ft", F.col("gap_ft") + 1)
    for batch in (a, again, again):
        sinks.upsert_alerts(batch, path)
    return spark.read.parquet(path).drop("event_date")


@query(
    "repeated_key_mismatches",
    """WITH a AS (SELECT l_orderkey, max(l_partkey) AS p FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, max(l_partkey) AS p FROM lineitem WHERE l_linenumber < 3 GROUP BY 1)
SELECT 'l_partkey' AS field, count(*) FILTER (a.p <> b.p) AS mismatches FROM a JOIN b USING (l_orderkey) UNION ALL SELECT 'only_live', count(*) FROM a JOIN b USING (l_orderkey)""",
)
def repeated_key_mismatches(spark, sf_dir):
    """Orders as keys with several rows on both sides: the last row counts, and a field of one side only differs everywhere."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    live, replay = rows.select("l_orderkey", "l_partkey", F.lit(1).alias("only_live")), rows.filter("l_linenumber < 3").select("l_orderkey", "l_partkey")
    return keyed.field_mismatches(live, replay, ["l_orderkey"], order=["l_partkey"])


@query(
    "capped_accuracy",
    f"""WITH p AS (SELECT user_id % 5 AS k, {SECONDS} AS issued_at, event_id AS predicted_arrival FROM events), a AS (SELECT k, (min(issued_at) + max(issued_at)) // 2 AS observed_at FROM p GROUP BY k),
r AS (SELECT p.*, observed_at, row_number() OVER (PARTITION BY k ORDER BY issued_at DESC, predicted_arrival DESC) AS n FROM p JOIN a USING (k) WHERE issued_at < observed_at)
SELECT CAST(k AS VARCHAR) AS trip_id, issued_at, predicted_arrival, observed_at FROM r WHERE n <= 120""",
)
def capped_accuracy(spark, sf_dir):
    """Far over 120 predictions of a key on both sides of its arrival: the newest 120 before it count."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    p = table(spark, sf_dir, "events").select(F.lit("20240101").alias("service_day"), (F.col("user_id") % 5).cast("string").alias("trip_id"), F.lit("p").alias("stop_id"), at.alias("issued_at"), F.col("event_id").alias("predicted_arrival"))
    middle = F.floor((F.min("issued_at") + F.max("issued_at")) / 2).alias("observed_at")
    o = p.groupBy("service_day", "trip_id", "stop_id").agg(middle).withColumns({"route_id": F.lit("1"), "route_short_name": F.lit("R1")})
    return accuracy.join_arrivals(p, o).select("trip_id", "issued_at", "predicted_arrival", "observed_at")


@query("lag_threshold", "SELECT CAST(user_id AS VARCHAR) AS grp, CAST(lag AS DOUBLE) AS lag FROM (SELECT user_id, CASE WHEN user_id % 6 <> 0 THEN max(event_id) - min(event_id) END AS lag FROM events GROUP BY user_id) WHERE lag IS NULL OR lag > 5000")
def lag_threshold(spark, sf_dir):
    grp = F.col("user_id").cast("string").alias("grp")
    e = table(spark, sf_dir, "events")
    lags = e.filter(F.col("user_id") % 6 != 0).groupBy(grp).agg((F.max("event_id") - F.min("event_id")).alias("lag"))
    return numbers(quality.lag_over(lags, e.select(grp).distinct().withColumn("max_lag", F.lit(5000))).select("grp", "lag"), "lag")


# --- marts and published figures ---


def _stops(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.concat(F.lit("s"), F.col("event_id") % 50).alias("stop_id"), F.lit(1).alias("version_id"), F.concat(F.lit("Stop "), F.col("event_id") % 50).alias("stop_name")).distinct()


@query("incremental_alert_mart", f"WITH {roles.ALERTS_SQL} SELECT CAST(0 AS BIGINT) AS extra, CAST(0 AS BIGINT) AS missing, count(*) AS alerts, count(*) AS typed FROM alerts")
def incremental_alert_mart(spark, sf_dir):
    """Rows in which a mart built in three steps, its positions late at first, differs from a whole build: none, and how many agree."""
    config = Warehouse(alert_lookback_min=180, unplaced_days=60)
    a, p, s = roles.alerts(spark, sf_dir).select("alert_id", "vehicle_id_a", "vehicle_id_b", "trip_id_a", "trip_id_b", "window_end", "local_date"), roles.positions(spark, sf_dir), _stops(spark, sf_dir)
    middle = a.agg(F.floor((F.min("window_end") + F.max("window_end")) / 2)).first()[0] or 0
    early = a.filter(F.col("window_end") <= middle)
    built = incremental.placed_alerts(None, early, p.filter(F.col("position_s") < middle - 90_000), s, config)
    path = folder(spark)
    for i, (alerts, positions) in enumerate(((early, p), (a, p))):
        built.write.parquet(f"{path}/{i}")
        built = incremental.placed_alerts(spark.read.parquet(f"{path}/{i}"), alerts, positions, s, config)
    whole = marts.placed_alerts(a, p, s).select(*built.columns)
    n = lambda df, c="*": df.agg(F.count(c)).scalar()
    return spark.range(1).select(n(built.exceptAll(whole)).alias("extra"), n(whole.exceptAll(built)).alias("missing"), n(built).alias("alerts"), n(built, "day_type").alias("typed"))


@query(
    "replay_routes",
    f"""WITH {RUNS_SQL}, b AS (SELECT route_short_name AS r, count(*) AS n FROM one GROUP BY 1), v AS (SELECT route_short_name AS r, count(*) AS n FROM alerts WHERE (window_end // 3600) % 3 <> 1 GROUP BY 1)
SELECT coalesce(b.r, v.r) AS route_short_name, coalesce(b.n, 0) AS baseline, coalesce(v.n, 0) AS variant FROM b FULL JOIN v ON b.r IS NOT DISTINCT FROM v.r""",
)
def replay_routes(spark, sf_dir):
    a = roles.alerts(spark, sf_dir)
    hour = F.floor(F.col("window_end") / 3600)
    return report.by_route(a.filter(hour % 3 != 0), a.filter(hour % 3 != 1))


@query(
    "replay_added_routes",
    f"""WITH {roles.ALERTS_SQL}, s AS (SELECT route_short_name, 's' || (CAST(vehicle_id_a AS INTEGER) % 4) AS stop, gap_ft FROM alerts),
t AS (SELECT route_short_name, count(*) AS added, quantile_cont(gap_ft, 0.5) AS median_gap_ft FROM s GROUP BY 1),
c AS (SELECT route_short_name, stop, count(*) AS n FROM s GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY route_short_name ORDER BY n DESC, stop) AS k FROM c)
SELECT t.route_short_name, added, median_gap_ft, (SELECT string_agg(stop || ':' || n, ',' ORDER BY k) FROM n WHERE n.route_short_name IS NOT DISTINCT FROM t.route_short_name AND k <= 3) AS stops FROM t ORDER BY added DESC, t.route_short_name NULLS LAST LIMIT 8""",
)
def replay_added_routes(spark, sf_dir):
    """The report's feature is the eight routes with most alerts."""
    a = roles.alerts(spark, sf_dir).withColumn("stop", F.concat(F.lit("s"), F.col("vehicle_id_a").cast("int") % 4))
    return report.added_by_route(a)


@query(
    "replay_peak_share",
    f"""WITH {RUNS_SQL} SELECT count(*) AS alerts, round(coalesce(CAST(count(*) FILTER (hour(timezone('America/Los_Angeles', timezone('UTC', make_timestamp(window_end * 1000000)))) BETWEEN 16 AND 18) AS DOUBLE) / count(*), 0.0), 4) AS peak_share FROM one""",
)
def replay_peak_share(spark, sf_dir):
    return report.peak_share(two_runs(spark, sf_dir)[0])


@query(
    "export_hours",
    f"""WITH {roles.ALERTS_SQL}, a AS (SELECT * FROM alerts WHERE local_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-19'),
n AS (SELECT CASE WHEN isodow(local_date) < 6 THEN 'weekday' ELSE 'weekend' END AS kind, local_hour, count(*) AS n FROM a GROUP BY ALL)
SELECT k.kind, CAST(h AS INTEGER) AS local_hour, round(CAST(coalesce(n.n, 0) AS DOUBLE) / CASE k.kind WHEN 'weekday' THEN 10 ELSE 4 END, 2) AS per_day FROM (VALUES ('weekday'), ('weekend')) k(kind) CROSS JOIN generate_series(0, 23) g(h) LEFT JOIN n ON n.kind = k.kind AND n.local_hour = h""",
)
def export_hours(spark, sf_dir):
    """The published hours of two weeks: a window is the feature."""
    first, last = dt.date(2024, 1, 6), dt.date(2024, 1, 19)
    from headway.plans import calendar

    found = exports.hours(exports.between(roles.alerts(spark, sf_dir), "local_date", first, last), calendar.window_days(spark, first, last))
    return spark.createDataFrame([(k, h, float(v)) for k, row in found.items() for h, v in enumerate(row)], "kind string, local_hour int, per_day double")


@query(
    "export_kpis",
    f"""WITH {roles.ALERTS_SQL}, {roles.HEALTH_SQL.replace(roles.POSITIONS + ',', '')}, a AS (SELECT count(*) AS n, count(*) FILTER (local_hour IN (16, 17, 18)) AS p FROM alerts),
l AS (SELECT * FROM health WHERE CAST(timezone('America/Los_Angeles', timezone('UTC', minute)) AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
SELECT 31 AS days, a.n AS alerts, round(a.n / 31.0, 1) AS alerts_per_day, round(CAST(a.p AS DOUBLE) / a.n, 3) AS pm_peak_share, (SELECT round(CAST(count(*) FILTER (NOT is_silent) AS DOUBLE) / count(*), 3) FROM l) AS live_share, (SELECT CAST(sum(positions) AS BIGINT) FROM l) AS positions FROM a""",
)
def export_kpis(spark, sf_dir):
    """The headline figures of the month that the driver's events fill."""
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    alerts = roles.alerts(spark, sf_dir).withColumns({"latitude": F.lit(47.6), "longitude": F.lit(-122.3)})
    days = exports.health_days(exports.between(marts.health_mart(health(spark, sf_dir)), "minute_local", first, last))
    k = exports.kpis(exports.between(alerts, "local_date", first, last), days, [], first, last)
    names = ("days", "alerts", "alerts_per_day", "pm_peak_share", "live_share", "positions")
    return spark.createDataFrame([tuple(k[n] for n in names)], "days int, alerts long, alerts_per_day double, pm_peak_share double, live_share double, positions long")


@query(
    "export_health_days",
    f"""WITH {roles.HEALTH_SQL}, l AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', minute)) AS wall FROM health)
SELECT strftime(wall, '%Y-%m-%d') AS date, count(*) AS minutes, count(*) FILTER (is_silent) AS silent_minutes, round(1 - CAST(count(*) FILTER (is_silent) AS DOUBLE) / count(*), 4) AS live_share, CAST(sum(positions) AS BIGINT) AS positions FROM l GROUP BY 1""",
)
def export_health_days(spark, sf_dir):
    rows = exports.health_days(marts.health_mart(health(spark, sf_dir)))
    return spark.createDataFrame([(str(r["date"]), r["minutes"], r["silent_minutes"], r["live_share"], r["positions"]) for r in rows], "date string, minutes long, silent_minutes long, live_share double, positions long")


# --- detection under thresholds that many rows meet ---


PAIRS_OF_HOURS = f"""windows AS (SELECT DISTINCT CAST(user_id % 4 AS VARCHAR) || '|' || CAST(user_id % 4 + 4 AS VARCHAR) AS pair, {SECONDS} // 3600 * 3600 AS window_end FROM events),
breaks AS (SELECT *, CASE WHEN window_end - lag(window_end) OVER (PARTITION BY pair ORDER BY window_end) <= 3600 THEN 0 ELSE 1 END AS b FROM windows),
runs AS (SELECT pair, window_end, sum(b) OVER (PARTITION BY pair ORDER BY window_end) AS run FROM breaks),
ordered AS (SELECT pair, window_end, row_number() OVER (PARTITION BY pair, run ORDER BY window_end) AS place, row_number() OVER (PARTITION BY pair ORDER BY window_end) AS k FROM runs),
fold AS (SELECT pair, k, window_end, place >= 2 AS fires, CASE WHEN place >= 2 THEN window_end END AS alert FROM ordered WHERE k = 1
  UNION ALL SELECT o.pair, o.k, o.window_end, o.place >= 2 AND (f.alert IS NULL OR o.window_end - f.alert >= 14400), CASE WHEN o.place >= 2 AND (f.alert IS NULL OR o.window_end - f.alert >= 14400) THEN o.window_end ELSE f.alert END
  FROM fold f JOIN ordered o ON o.pair = f.pair AND o.k = f.k + 1)"""


def _hourly_pairs(spark, sf_dir):
    """Each hour in which users of a remainder have events, as a window of a pair."""
    k, at = F.col("user_id") % 4, F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(k.cast("string").alias("vehicle_id_a"), (k + 4).cast("string").alias("vehicle_id_b"), (F.floor(at / 3600) * 3600).alias("window_end")).distinct()


@query("cooldown_many", f"WITH RECURSIVE {PAIRS_OF_HOURS} SELECT pair, window_end FROM fold WHERE fires")
def cooldown_many(spark, sf_dir):
    alerts = detect.cooled_alerts(_hourly_pairs(spark, sf_dir), Bunching(window_s=3600, cooldown_s=14_400))
    return alerts.select(text.pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("pair"), "window_end")


@query("stream_cooldown_many", f"WITH RECURSIVE {PAIRS_OF_HOURS} SELECT pair, window_end FROM fold WHERE fires")
def stream_cooldown_many(spark, sf_dir):
    """The same windows through the stateful cooldown, in four files in order of time."""
    p = _hourly_pairs(spark, sf_dir).select(text.pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("pair"), "window_end")
    jobs.use_rocksdb(spark)
    return jobs.run_available(jobs.cooled(streamed(spark, p, 4, "window_end"), Bunching(window_s=3600, cooldown_s=14_400)), folder(spark))


@query(
    "gates_fresh",
    f"""WITH {roles.POSITIONS}, latest AS (SELECT * FROM (SELECT *, CAST(floor(position_s / 3600) AS BIGINT) * 3600 + 3600 AS window_end,
    row_number() OVER (PARTITION BY CAST(floor(position_s / 3600) AS BIGINT), route_id, direction_id, vehicle_id ORDER BY position_timestamp DESC) AS n FROM positions) WHERE n = 1)
SELECT vehicle_id, window_end FROM latest WHERE window_end - position_s <= 900 AND shape_dist_traveled >= 100 AND coalesce(current_stop_sequence, 0) >= 4""",
)
def gates_fresh(spark, sf_dir):
    """An age that cuts most positions of an hour."""
    config = replace(roles.DETECTION, max_age_s=900)
    return detect.gates(detect.latest_in_window(detect.parse_records(roles.positions(spark, sf_dir)), config), config).select("vehicle_id", "window_end")


# --- the streaming job ---


@query(
    "stream_bunching_job",
    f"""WITH {roles.POSITIONS} SELECT count(*) AS differences FROM positions WHERE false""",
)
def stream_bunching_job(spark, sf_dir):
    """Framed records through decode, windows, pairs and cooldown: rows in which its alerts differ from the batch form's."""
    config = roles.DETECTION
    p = roles.positions(spark, sf_dir).withColumn("position_timestamp", F.col("position_s"))
    path = folder(spark)
    jobs.bunching_job(streamed(spark, enriched.encode_enriched(p.drop("enriched_at"), 3)), path, config).awaitTermination()
    last = p.agg(F.max("position_s")).first()[0] or 0
    at = p.withColumn("position_timestamp", F.timestamp_seconds("position_s"))
    pairs = detect.adjacent_pairs(detect.gates(detect.latest_in_window(detect.parse_records(at), config), config), config).filter(F.col("window_end") <= last - config.lateness_s)
    columns = ["vehicle_id_a", "vehicle_id_b", "window_end", "trip_id_a", "trip_id_b"]
    want = detect.cooled_alerts(pairs, config).select(*columns)
    found = spark.read.parquet(f"{path}/alerts").select(*columns) if any(n.startswith("batch=") for n in store.names(spark, f"{path}/alerts")) else want.limit(0)
    wrong = want.exceptAll(found).unionAll(found.exceptAll(want))
    return wrong.agg(F.count("*").alias("differences"))
