"""Joins, differences, enrichment and geometry over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.config import Bounds
from headway.functions.geo import in_bounds, polygon_covers, project_on_line
from headway.operators import accuracy, enrich, keyed
from headway.plans import marts, roles
from headway.plans.define import Registry
from headway.plans.queries_core import numbers

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
table = roles.table


@query(
    "first_arrival_join",
    f"WITH {roles.ACCURACY_SQL} SELECT service_day, trip_id, stop_id, route_id, route_short_name, issued_at, predicted_arrival, observed_at, lead_time_s, error_s, abs_error_s, lead_bucket FROM accuracy",
)
def first_arrival_join(spark, sf_dir):
    return roles.accuracy(spark, sf_dir)


@query(
    "buffer_cap",
    "SELECT service_day, trip_id, issued_at, predicted_arrival FROM (SELECT strftime(ts, '%Y%m') AS service_day, CAST(user_id % 10 AS VARCHAR) AS trip_id, CAST(floor(epoch(ts)) AS BIGINT) AS issued_at, event_id AS predicted_arrival, row_number() OVER (PARTITION BY user_id % 10 ORDER BY floor(epoch(ts)) DESC, event_id DESC) AS n FROM events) WHERE n <= 120",
)
def buffer_cap(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select(F.date_format(ts, "yyyyMM").alias("service_day"), (F.col("user_id") % 10).cast("string").alias("trip_id"), F.lit("p").alias("stop_id"), F.unix_seconds(ts).alias("issued_at"), F.col("event_id").alias("predicted_arrival"))
    return accuracy.newest(rows).drop("stop_id")


LAST_SQL = (
    roles.ALERTS_SQL
    + """,
seen_a AS (SELECT alert_id, max_by(struct_pack(latitude := p.latitude, longitude := p.longitude, stop_id := p.stop_id, seq := p.current_stop_sequence, position_s := p.position_s), struct_pack(s := p.position_s, t := p.stop_id)) AS a
  FROM alerts JOIN positions p ON p.vehicle_id = vehicle_id_a AND p.trip_id = trip_id_a AND p.position_s >= window_end - 1800 AND p.position_s < window_end GROUP BY alert_id),
seen_b AS (SELECT alert_id, max_by(struct_pack(latitude := p.latitude, longitude := p.longitude, stop_id := p.stop_id, seq := p.current_stop_sequence, position_s := p.position_s), struct_pack(s := p.position_s, t := p.stop_id)) AS b
  FROM alerts JOIN positions p ON p.vehicle_id = vehicle_id_b AND p.trip_id = trip_id_b AND p.position_s >= window_end - 1800 AND p.position_s < window_end GROUP BY alert_id),
stops AS (SELECT 's' || (p_partkey % 50) AS stop_id, arg_max(p_name, p_partkey) AS stop_name FROM part GROUP BY 1),
placed AS (SELECT alerts.*, (a.latitude + b.latitude) / 2 AS latitude, (a.longitude + b.longitude) / 2 AS longitude,
    CASE WHEN a.seq IS NULL AND b.seq IS NULL THEN NULL WHEN b.seq IS NULL OR a.seq <= b.seq THEN a.stop_id ELSE b.stop_id END AS at_stop
  FROM alerts LEFT JOIN seen_a USING (alert_id) LEFT JOIN seen_b USING (alert_id))"""
)


def placed(spark, sf_dir):
    """Alerts placed by the positions of their last half hour: an equi-join on half-hour slots."""
    stops = table(spark, sf_dir, "part").select(F.concat(F.lit("s"), F.col("p_partkey") % 50).alias("stop_id"), F.col("p_partkey").alias("version_id"), F.col("p_name").alias("stop_name"))
    a, p = roles.alerts(spark, sf_dir), roles.positions(spark, sf_dir)
    return marts.placed_alerts(a, p, stops, 1800)


@query("last_position_asof", f"WITH {LAST_SQL} SELECT alert_id, a.position_s, a.stop_id, a.latitude FROM seen_a")
def last_position_asof(spark, sf_dir):
    last = marts.last_positions(roles.alerts(spark, sf_dir), roles.positions(spark, sf_dir), "vehicle_id_a", "trip_id_a", 1800)
    return last.select("alert_id", "p.position_s", "p.stop_id", "p.latitude")


@query("midpoint_placement", f"WITH {LAST_SQL} SELECT alert_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, at_stop AS stop_id, stop_name FROM placed LEFT JOIN stops ON stops.stop_id = at_stop")
def midpoint_placement(spark, sf_dir):
    return placed(spark, sf_dir).select("alert_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "stop_id", "stop_name")


@query(
    "hotspots_top_routes",
    f"""WITH {LAST_SQL},
located AS (SELECT at_stop AS stop_id, route_short_name, count(*) AS n, sum(longitude) AS lon, sum(latitude) AS lat, count(*) FILTER (local_hour IN (16, 17, 18)) AS pm FROM placed WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY n DESC, route_short_name NULLS LAST) AS k FROM located)
SELECT stop_id, CAST(sum(n) AS BIGINT) AS alerts, round(sum(lon), 6) AS longitude_sum, round(sum(lat), 6) AS latitude_sum, CAST(sum(pm) AS BIGINT) AS pm_alerts,
string_agg(coalesce(route_short_name, '?'), ',' ORDER BY k) FILTER (k <= 3) AS top_routes FROM ranked GROUP BY stop_id""",
)
def hotspots_top_routes(spark, sf_dir):
    found = marts.hotspots(placed(spark, sf_dir), digits=12)  # means times counts: sums of few decimals, without ties when rounded
    sums = [F.round(F.col(c) * F.col("alerts"), 6).alias(f"{c}_sum") for c in ("longitude", "latitude")]
    return found.select("stop_id", "alerts", "pm_alerts", "top_routes", *sums)


@query("stop_latest_version", "SELECT p_brand AS stop_id, arg_max(p_name, p_partkey) AS stop_name FROM part GROUP BY p_brand")
def stop_latest_version(spark, sf_dir):
    return marts.latest_stop_names(table(spark, sf_dir, "part").select(F.col("p_brand").alias("stop_id"), F.col("p_partkey").alias("version_id"), F.col("p_name").alias("stop_name")))


def live_and_replay(spark, sf_dir):
    """Line items, and a copy without some rows, with others, and with changed fields."""
    live = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    changed = live.filter("l_orderkey % 17 <> 0").withColumns({
        "l_orderkey": F.when(F.col("l_orderkey") % 23 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")),
        "l_quantity": F.when(F.col("l_partkey") % 19 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")), "l_returnflag": F.when(F.col("l_partkey") % 29 != 0, F.col("l_returnflag")),
    })
    keys = ["l_orderkey", "l_linenumber"]
    return keyed.latest_per_key(live, keys, ["l_partkey", "l_quantity"]), keyed.latest_per_key(changed, keys, ["l_partkey", "l_quantity"]), keys


REPLAY_SQL = """
live AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_quantity DESC) AS n FROM lineitem) WHERE n = 1),
changed AS (SELECT CASE WHEN l_orderkey % 23 = 0 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 19 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 29 <> 0 THEN l_returnflag END AS l_returnflag FROM lineitem WHERE l_orderkey % 17 <> 0),
replay AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_quantity DESC) AS n FROM changed) WHERE n = 1)"""


@query(
    "diff_keys",
    f"WITH {REPLAY_SQL} SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, CASE WHEN a.l_orderkey IS NULL THEN 'replay' WHEN b.l_orderkey IS NULL THEN 'live' ELSE 'both' END AS side FROM live a FULL JOIN replay b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber",
)
def diff_keys(spark, sf_dir):
    return keyed.diff_keys(*live_and_replay(spark, sf_dir))


@query(
    "field_mismatches",
    f"""WITH {REPLAY_SQL}, m AS (SELECT count(*) FILTER (a.l_partkey IS DISTINCT FROM b.l_partkey) AS p, count(*) FILTER (a.l_quantity IS DISTINCT FROM b.l_quantity) AS q, count(*) FILTER (a.l_returnflag IS DISTINCT FROM b.l_returnflag) AS r
FROM live a JOIN replay b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
SELECT 'l_partkey' AS field, p AS mismatches FROM m UNION ALL SELECT 'l_quantity', q FROM m UNION ALL SELECT 'l_returnflag', r FROM m""",
)
def field_mismatches(spark, sf_dir):
    return keyed.field_mismatches(*live_and_replay(spark, sf_dir))


@query("intersect_keys", f"WITH {REPLAY_SQL} SELECT l_orderkey FROM live INTERSECT SELECT l_orderkey FROM replay")
def intersect_keys(spark, sf_dir):
    live, replay, _ = live_and_replay(spark, sf_dir)
    return live.select("l_orderkey").intersect(replay.select("l_orderkey"))


@query("except_keys", f"WITH {REPLAY_SQL} SELECT l_orderkey FROM live EXCEPT SELECT l_orderkey FROM replay")
def except_keys(spark, sf_dir):
    live, replay, _ = live_and_replay(spark, sf_dir)
    return live.select("l_orderkey").subtract(replay.select("l_orderkey"))


@query("idempotent_upsert", f"WITH {REPLAY_SQL} SELECT coalesce(b.l_orderkey, a.l_orderkey) AS l_orderkey, coalesce(b.l_linenumber, a.l_linenumber) AS l_linenumber, CASE WHEN b.l_orderkey IS NULL THEN a.l_quantity ELSE b.l_quantity END AS l_quantity FROM live a FULL JOIN replay b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber")
def idempotent_upsert(spark, sf_dir):
    live, replay, keys = live_and_replay(spark, sf_dir)
    live, replay = (x.select(*keys, "l_quantity", F.lit(0).alias("seq")) for x in (live, replay))
    once = keyed.upsert(live, replay, keys, "seq")
    return keyed.upsert(once, replay, keys, "seq").drop("seq")  # again: no effect


@query("trip_enrichment", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def trip_enrichment(spark, sf_dir):
    names = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return table(spark, sf_dir, "customer").join(enrich.small(names), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query("unknown_reference_dlq", "SELECT event_id, 'unknown_trip_id' AS reason, CAST(user_id AS VARCHAR) AS entity_key FROM events WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = user_id)")
def unknown_reference_dlq(spark, sf_dir):
    known = enrich.small(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("user_id")))
    return table(spark, sf_dir, "events").join(known, "user_id", "left_anti").select("event_id", F.lit("unknown_trip_id").alias("reason"), F.col("user_id").cast("string").alias("entity_key"))


@query("join_rate", "SELECT event_type, count(*) AS n, round(avg(CASE WHEN user_id < 25 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM events GROUP BY event_type")
def join_rate(spark, sf_dir):
    known = enrich.small(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("user_id"), F.lit(1.0).alias("hit")))
    return table(spark, sf_dir, "events").join(known, "user_id", "left").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("hit", F.lit(0.0))), 6).alias("hit_rate"))


SMALL_BOX = Bounds(min_lon=-122.29, min_lat=47.51, max_lon=-122.26, max_lat=47.54)


@query("bbox_split", f"WITH {roles.POSITIONS} SELECT event_id, latitude BETWEEN 47.51 AND 47.54 AND longitude BETWEEN -122.29 AND -122.26 AS inside FROM positions")
def bbox_split(spark, sf_dir):
    p = roles.positions(spark, sf_dir)
    kept, rejected = keyed.split_by(p, in_bounds(F.col("latitude"), F.col("longitude"), SMALL_BOX))
    return kept.select("event_id", F.lit(True).alias("inside")).unionByName(rejected.select("event_id", F.lit(False).alias("inside")))


SCHEDULE_SQL = """
stops AS (SELECT l_orderkey AS trip_id, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dist, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS stop_sequence FROM lineitem),
points AS (SELECT trip_id, stop_sequence, dist, stop_sequence * 90 AS seconds, lag(dist) OVER w AS d0, lag(stop_sequence * 90) OVER w AS s0, min(dist) OVER (PARTITION BY trip_id) AS first, max(dist) OVER (PARTITION BY trip_id) AS last, count(*) OVER (PARTITION BY trip_id) AS n FROM stops WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence))"""


def trip_points(spark, sf_dir):
    """Orders as trips, their lines as stops a minute and a half apart, at their running quantity."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    stops = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trip_id"), F.row_number().over(w).alias("stop_sequence"), F.sum("l_quantity").over(w).alias("shape_dist_traveled"))
    s = F.col("stop_sequence") * 90
    clock = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return enrich.schedules(stops.withColumn("arrival_time", clock))


@query(
    "schedule_interpolation",
    f"""WITH {SCHEDULE_SQL}, asked AS (SELECT o_orderkey AS trip_id, CAST(o_custkey % 150 AS DOUBLE) AS x FROM orders)
SELECT trip_id, x, max(CASE WHEN n >= 2 AND x >= first AND x <= last AND x <= dist AND (d0 IS NULL OR d0 < x) THEN CASE WHEN d0 IS NULL THEN CAST(seconds AS DOUBLE) ELSE round(s0 + (seconds - s0) * (x - d0) / (dist - d0), 6) END END) AS seconds
FROM asked JOIN points USING (trip_id) GROUP BY trip_id, x""",
)
def schedule_interpolation(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), (F.col("o_custkey") % 150).cast("double").alias("x"))
    return asked.join(trip_points(spark, sf_dir), "trip_id").select("trip_id", "x", F.round(enrich.interpolate(F.col("points"), F.col("x")), 6).alias("seconds"))


LINE = [(-122.30, 47.50), (-122.28, 47.52), (-122.28, 47.54), (-122.25, 47.55)]
LINE_SQL = ", ".join(f"({i}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for i, (a, b) in enumerate(zip(LINE, LINE[1:])))


def points_literal(points):
    return F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in points])


@query(
    "project_on_line",
    f"""WITH {roles.POSITIONS}, seg0(i, ax, ay, bx, by_) AS (SELECT i, CAST(ax AS DOUBLE), CAST(ay AS DOUBLE), CAST(bx AS DOUBLE), CAST(b_y AS DOUBLE) FROM (VALUES {LINE_SQL}) v(i, ax, ay, bx, b_y)),
seg AS (SELECT *, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) AS len, coalesce(sum(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM seg0),
near AS (SELECT event_id, i, run, len, greatest(0.0, least(1.0, ((longitude - ax) * (bx - ax) + (latitude - ay) * (by_ - ay)) / (len * len))) AS t, ax, ay, bx, by_, longitude, latitude FROM positions, seg),
far AS (SELECT event_id, i, run + t * len AS along, (ax + t * (bx - ax) - longitude) ** 2 + (ay + t * (by_ - ay) - latitude) ** 2 AS d FROM near)
SELECT event_id, round(arg_min(along, d) / (SELECT sum(len) FROM seg), 6) AS fraction FROM far GROUP BY event_id""",
)
def project_on_line_query(spark, sf_dir):
    p = roles.positions(spark, sf_dir)
    return p.select("event_id", F.round(project_on_line(F.col("longitude"), F.col("latitude"), points_literal(LINE)), 6).alias("fraction"))


RING = [(-122.29, 47.51), (-122.26, 47.51), (-122.26, 47.54), (-122.275, 47.525), (-122.29, 47.54), (-122.29, 47.51)]
RING_SQL = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(RING, RING[1:]))


@query(
    "point_in_polygon",
    f"""WITH {roles.POSITIONS}, e(ax, ay, bx, b_y) AS (SELECT CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE) FROM (VALUES {RING_SQL}) v(a, b, c, d))
SELECT event_id, count(*) FILTER ((ay > latitude) <> (b_y > latitude) AND longitude < (bx - ax) * (latitude - ay) / (b_y - ay) + ax) % 2 = 1
OR bool_or((bx - ax) * (latitude - ay) - (b_y - ay) * (longitude - ax) = 0 AND longitude BETWEEN least(ax, bx) AND greatest(ax, bx) AND latitude BETWEEN least(ay, b_y) AND greatest(ay, b_y)) AS inside FROM positions, e GROUP BY event_id""",
)
def point_in_polygon(spark, sf_dir):
    p = roles.positions(spark, sf_dir)
    return p.select("event_id", polygon_covers(F.col("longitude"), F.col("latitude"), F.array(F.array(points_literal(RING)))).alias("inside"))


@query(
    "neighborhood_join",
    f"""WITH {roles.POSITIONS} SELECT event_id, CAST(CASE WHEN longitude BETWEEN -122.29 AND -122.27 AND latitude BETWEEN 47.51 AND 47.53 THEN 1 WHEN longitude BETWEEN -122.28 AND -122.255 AND latitude BETWEEN 47.52 AND 47.545 THEN 2 END AS DOUBLE) AS neighborhood_num FROM positions""",
)
def neighborhood_join(spark, sf_dir):
    box = lambda a, b, c, d: F.array(F.array(points_literal([(a, b), (c, b), (c, d), (a, d), (a, b)])))
    one = spark.range(1).select(F.lit(1).alias("neigh_num"), F.lit("west").alias("neighborhood_name"), box(-122.29, 47.51, -122.27, 47.53).alias("polygons"))
    two = spark.range(1).select(F.lit(2).alias("neigh_num"), F.lit("east").alias("neighborhood_name"), box(-122.28, 47.52, -122.255, 47.545).alias("polygons"))
    return numbers(enrich.with_neighborhood(roles.positions(spark, sf_dir), one.unionByName(two)).select("event_id", "neighborhood_num"), "neighborhood_num")


@query(
    "pair_near",
    f"""WITH {roles.ALERTS_SQL} SELECT alert_id, EXISTS (SELECT 1 FROM alerts b WHERE b.pair = a.pair AND b.alert_id <> a.alert_id AND abs(b.window_end - a.window_end) <= 14400) AS near FROM alerts a""",
)
def pair_near(spark, sf_dir):
    """Another alert of the same unordered pair within four hours: an equi-join on pair and slot, then the interval."""
    from headway.functions.text import pair_key

    a = roles.alerts(spark, sf_dir).select("alert_id", pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("pair"), "window_end", F.floor(F.col("window_end") / 14400).alias("slot"))
    b = a.select(F.col("alert_id").alias("other"), "pair", F.col("window_end").alias("then"), F.explode(F.array(F.col("slot") - 1, F.col("slot"), F.col("slot") + 1)).alias("slot"))
    hit = a.join(b, ["pair", "slot"]).filter((F.col("other") != F.col("alert_id")) & (F.abs(F.col("then") - F.col("window_end")) <= 14400)).select("alert_id").distinct()
    return a.select("alert_id").join(hit.withColumn("near", F.lit(True)), "alert_id", "left").select("alert_id", F.coalesce("near", F.lit(False)).alias("near"))


@query(
    "min_sequence_in_window",
    f"""WITH {roles.ALERTS_SQL} SELECT alert_id, CAST(min(p.current_stop_sequence) AS DOUBLE) AS min_sequence FROM alerts JOIN positions p ON p.trip_id = trip_id_a AND p.vehicle_id = vehicle_id_a AND p.position_s >= window_end - 3600 AND p.position_s < window_end GROUP BY alert_id""",
)
def min_sequence_in_window(spark, sf_dir):
    a = roles.alerts(spark, sf_dir).select("alert_id", F.col("vehicle_id_a").alias("vehicle_id"), F.col("trip_id_a").alias("trip_id"), "window_end")
    asked = a.withColumn("slot", F.explode(F.array(F.floor((F.col("window_end") - 3600) / 3600), F.floor((F.col("window_end") - 1) / 3600)))).distinct()
    seen = roles.positions(spark, sf_dir).select("vehicle_id", "trip_id", "position_s", "current_stop_sequence", F.floor(F.col("position_s") / 3600).alias("slot"))
    hit = asked.join(seen, ["vehicle_id", "trip_id", "slot"]).filter("position_s >= window_end - 3600 and position_s < window_end")
    return numbers(hit.groupBy("alert_id").agg(F.min("current_stop_sequence").alias("min_sequence")), "min_sequence")


@query("live_minute", f"WITH {roles.HEALTH_SQL} SELECT event_id FROM positions JOIN health ON date_trunc('minute', position_timestamp) - INTERVAL 1 MINUTE = minute WHERE NOT is_silent")
def live_minute(spark, sf_dir):
    from headway.plans.queries_core import health

    before = F.date_trunc("minute", "position_timestamp") - F.expr("INTERVAL 1 MINUTE")
    live = health(spark, sf_dir).filter(~F.col("is_silent")).select("minute")
    return roles.positions(spark, sf_dir).withColumn("minute", before).join(live, "minute").select("event_id")


@query("anti_coverage", f"WITH {REPLAY_SQL} SELECT 'missing' AS kind, count(*) AS n FROM live a ANTI JOIN replay b USING (l_orderkey, l_linenumber) UNION ALL SELECT 'orphan', count(*) FROM replay a ANTI JOIN live b USING (l_orderkey, l_linenumber)")
def anti_coverage(spark, sf_dir):
    live, replay, keys = live_and_replay(spark, sf_dir)
    side = lambda a, b, kind: a.join(b, keys, "left_anti").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return side(live, replay, "missing").unionByName(side(replay, live, "orphan"))


@query("semi_unplaced", f"WITH {LAST_SQL} SELECT event_id FROM positions WHERE CAST(floor(position_s / 3600) AS BIGINT) * 3600 + 3600 IN (SELECT window_end FROM placed WHERE latitude IS NULL)")
def semi_unplaced(spark, sf_dir):
    unplaced = placed(spark, sf_dir).filter("latitude is null").select("window_end")
    p = roles.positions(spark, sf_dir).withColumn("window_end", F.floor(F.col("position_s") / 3600) * 3600 + 3600)
    return p.join(unplaced, "window_end", "left_semi").select("event_id")
