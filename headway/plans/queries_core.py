"""Marts, aggregations and windows over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.functions.rounding import numeric
from headway.functions.time import lead_bucket
from headway.operators import detect, keyed, messages
from headway.plans import marts, roles
from headway.plans.define import Registry

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def staged(spark, sf_dir):
    return marts.staging_positions(roles.positions(spark, sf_dir), roles.HEALTH, "UTC")


def health(spark, sf_dir):
    return marts.feed_health(staged(spark, sf_dir))


def numbers(df, *names):
    """Integers that may be null as doubles, so that any reader holds them alike."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def seconds(df, *names):
    """Instants as epoch seconds."""
    return df.withColumns({n: F.unix_seconds(n) for n in names})


@query("feed_health_minute", f"WITH {roles.HEALTH_SQL} SELECT CAST(epoch(minute) AS BIGINT) AS minute, positions, vehicles, CAST(median_lag_s AS DOUBLE) AS median_lag_s, is_silent, stall_minutes FROM health")
def feed_health_minute(spark, sf_dir):
    return numbers(seconds(health(spark, sf_dir), "minute"), "median_lag_s")


@query(
    "stall_report",
    f"""WITH {roles.HEALTH_SQL},
recent AS (SELECT minute, is_silent, row_number() OVER (ORDER BY minute) - row_number() OVER (PARTITION BY is_silent ORDER BY minute) AS i FROM health WHERE minute > (SELECT max(minute) FROM health) - INTERVAL 70 MINUTE),
runs AS (SELECT count(*) AS minutes, min(minute) AS s, max(minute) AS e FROM recent WHERE is_silent GROUP BY i ORDER BY 1 DESC, 2 DESC LIMIT 1)
SELECT coalesce(max(minutes), 0) AS stall_minutes, CAST(epoch(max(s)) AS DOUBLE) AS start_s, CAST(epoch(max(e)) AS DOUBLE) AS end_s, coalesce(max(minutes), 0) >= 5 AS alert FROM runs""",
)
def stall_report(spark, sf_dir):
    return numbers(marts.stall_report(health(spark, sf_dir)), "start_s", "end_s")


@query(
    "route_deviation_hourly",
    f"""WITH {roles.POSITIONS} SELECT route_short_name, strftime(position_timestamp, '%Y-%m-%d') AS service_date, CAST(hour(position_timestamp) AS INTEGER) AS local_hour, count(*) AS positions,
CAST(round_even(quantile_cont(schedule_deviation_seconds, 0.5), 0) AS INTEGER) AS median_deviation_s, CAST(CAST(round(10000 * CAST(count(*) FILTER (schedule_deviation_seconds > 100) AS DECIMAL(18,6)) / count(*)) AS DOUBLE) / 100 AS DOUBLE) AS pct_late
FROM positions WHERE lag <= 400 AND route_short_name IS NOT NULL AND schedule_deviation_seconds IS NOT NULL GROUP BY ALL""",
)
def route_deviation_hourly(spark, sf_dir):
    from dataclasses import replace

    mart = marts.route_deviation_hourly(staged(spark, sf_dir), replace(roles.HEALTH, late_s=100))
    return mart.withColumns({"service_date": F.col("service_date").cast("string"), "pct_late": F.col("pct_late").cast("double")})


@query(
    "bunching_by_route_hour",
    f"""WITH {roles.ALERTS_SQL} SELECT route_short_name, direction_id, local_hour, count(*) AS alerts, round(quantile_cont(gap_ft, 0.5), 1) AS median_gap_ft,
CAST(round(quantile_cont(deviation_a, 0.5)) AS DOUBLE) AS median_deviation_a, CAST(round(quantile_cont(deviation_b, 0.5)) AS DOUBLE) AS median_deviation_b FROM alerts GROUP BY ALL""",
)
def bunching_by_route_hour(spark, sf_dir):
    return numbers(marts.bunching_by_route_hour(roles.alerts(spark, sf_dir)), "median_gap_ft", "median_deviation_a", "median_deviation_b")


def with_days(spark, sf_dir):
    return roles.accuracy(spark, sf_dir).withColumn("observed_at", F.timestamp_seconds("observed_at"))


DAY = "strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d')"


@query("error_histogram", f"WITH {roles.ACCURACY_SQL} SELECT {DAY} AS observed_day, lead_bucket, CAST(abs_error_s AS INTEGER) AS abs_error_s, count(*) AS predictions, CAST(0 AS BIGINT) AS fractional_values FROM accuracy GROUP BY ALL")
def error_histogram(spark, sf_dir):
    return marts.error_histogram(with_days(spark, sf_dir)).withColumn("observed_day", F.col("observed_day").cast("string"))


@query("bucket_daily", f"WITH {roles.ACCURACY_SQL} SELECT {DAY} AS observed_day, lead_bucket, count(*) AS predictions, CAST(sum(error_s) AS BIGINT) AS sum_error_s, min(lead_time_s) AS min_lead_time_s FROM accuracy GROUP BY ALL")
def bucket_daily(spark, sf_dir):
    return marts.bucket_daily(with_days(spark, sf_dir)).withColumn("observed_day", F.col("observed_day").cast("string"))


@query(
    "error_curve",
    f"""WITH {roles.ACCURACY_SQL} SELECT lead_bucket, count(*) AS predictions, CAST(round_even(CAST(sum(error_s) AS DOUBLE) / count(*), 0) AS INTEGER) AS mean_error_s, min(lead_time_s) AS bucket_order,
CAST(round_even(quantile_cont(abs_error_s, 0.5), 0) AS INTEGER) AS median_abs_error_s, CAST(round_even(quantile_cont(abs_error_s, 0.9), 0) AS INTEGER) AS p90_abs_error_s FROM accuracy GROUP BY lead_bucket ORDER BY bucket_order""",
)
def error_curve(spark, sf_dir):
    a = with_days(spark, sf_dir)
    return marts.prediction_error_by_lead(marts.error_histogram(a), marts.bucket_daily(a))


@query("histogram_percentile", f"WITH {roles.ACCURACY_SQL} SELECT lead_bucket, quantile_cont(CAST(abs_error_s AS DOUBLE), 0.75) AS value FROM accuracy GROUP BY lead_bucket")
def histogram_percentile(spark, sf_dir):
    return marts.histogram_percentile(marts.error_histogram(with_days(spark, sf_dir)), ["lead_bucket"], "abs_error_s", "predictions", 0.75)


@query(
    "lead_bucket",
    """SELECT CASE WHEN s < 0 THEN 'past' WHEN s < 120 THEN '0-2m' WHEN s < 300 THEN '2-5m' WHEN s < 600 THEN '5-10m' WHEN s < 900 THEN '10-15m' WHEN s < 1200 THEN '15-20m' WHEN s < 1800 THEN '20-30m' WHEN s < 2700 THEN '30-45m' ELSE '45-60m' END AS lead_bucket,
count(*) AS n FROM (SELECT CAST(floor(value) AS BIGINT) * 9 - 300 AS s FROM events) GROUP BY 1""",
)
def lead_buckets(spark, sf_dir):
    return roles.table(spark, sf_dir, "events").groupBy(lead_bucket(F.floor("value").cast("long") * 9 - 300).alias("lead_bucket")).agg(F.count("*").alias("n"))


@query("segment_hour_medians", "SELECT CAST(user_id % 20 AS BIGINT) AS route, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, round(quantile_cont(floor(value), 0.5), 1) AS median FROM events GROUP BY ALL")
def segment_hour_medians(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 20).alias("route"), F.hour("ts").alias("hour")).agg(F.count("*").alias("n"), numeric(F.percentile(F.floor("value"), F.lit(0.5)), 1).cast("double").alias("median"))


@query(
    "tumbling_latest",
    f"WITH {roles.PAIRS_SQL} SELECT window_end, route_id, direction_id, vehicle_id, position_s, trip_id, shape_dist_traveled, CAST(current_stop_sequence AS DOUBLE) AS current_stop_sequence FROM latest",
)
def tumbling_latest(spark, sf_dir):
    p = roles.positions(spark, sf_dir)
    latest = detect.latest_in_window(p, roles.DETECTION).select("window_end", "route_id", "direction_id", "vehicle_id", "position_s", "trip_id", "shape_dist_traveled", "current_stop_sequence")
    return numbers(latest, "current_stop_sequence")


@query(
    "adjacent_pairs",
    f"WITH {roles.PAIRS_SQL} SELECT route_id, direction_id, route_short_name, vehicle_id_a, vehicle_id_b, trip_id_a, trip_id_b, gap_ft, window_end, CAST(deviation_a AS DOUBLE) AS deviation_a, CAST(deviation_b AS DOUBLE) AS deviation_b FROM confirmed",
)
def adjacent_pairs(spark, sf_dir):
    return numbers(roles.adjacent(spark, sf_dir), "deviation_a", "deviation_b")


@query("haversine_confirm", f"WITH {roles.PAIRS_SQL} SELECT vehicle_id_a, vehicle_id_b, window_end, round(apart_ft, 3) AS apart_ft, apart_ft <= greatest(gap_ft, 5000) * 1.25 AS near FROM pairs")
def haversine_confirm(spark, sf_dir):
    from dataclasses import replace

    from headway.functions.geo import haversine_ft

    every = replace(roles.DETECTION, proximity_margin=1e9)
    p = roles.positions(spark, sf_dir)
    latest = detect.gates(detect.latest_in_window(detect.parse_records(p), roles.DETECTION), roles.DETECTION)
    pairs = detect.adjacent_pairs(latest, every)
    at = latest.select("window_end", "vehicle_id", "latitude", "longitude")
    a, b = (at.select("window_end", F.col("vehicle_id").alias(f"vehicle_id_{s}"), F.col("latitude").alias(f"lat_{s}"), F.col("longitude").alias(f"lon_{s}")) for s in "ab")
    apart = haversine_ft(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    near = apart <= F.greatest(F.col("gap_ft"), F.lit(5000.0)) * 1.25
    return pairs.join(a, ["window_end", "vehicle_id_a"]).join(b, ["window_end", "vehicle_id_b"]).select("vehicle_id_a", "vehicle_id_b", "window_end", F.round(apart, 3).alias("apart_ft"), near.alias("near"))


RUNS_SQL = (
    roles.PAIRS_SQL
    + """,
windows AS (SELECT DISTINCT pair, window_end FROM confirmed),
breaks AS (SELECT *, CASE WHEN window_end - lag(window_end) OVER (PARTITION BY pair ORDER BY window_end) <= 3600 THEN 0 ELSE 1 END AS b FROM windows),
runs AS (SELECT pair, window_end, sum(b) OVER (PARTITION BY pair ORDER BY window_end) AS run FROM breaks),
numbered AS (SELECT pair, window_end, row_number() OVER (PARTITION BY pair, run ORDER BY window_end) AS run_position FROM runs)"""
)


@query("consecutive_windows", f"WITH {RUNS_SQL} SELECT * FROM numbered")
def consecutive_windows(spark, sf_dir):
    return detect.consecutive_runs(roles.adjacent(spark, sf_dir), roles.DETECTION)


@query(
    "cooldown_alerts",
    f"""WITH RECURSIVE {RUNS_SQL},
ordered AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY window_end) AS k FROM numbered),
fold AS (SELECT pair, k, window_end, run_position >= 2 AS fires, CASE WHEN run_position >= 2 THEN window_end END AS last_alert FROM ordered WHERE k = 1
  UNION ALL SELECT o.pair, o.k, o.window_end, o.run_position >= 2 AND (f.last_alert IS NULL OR o.window_end - f.last_alert >= 21600),
    CASE WHEN o.run_position >= 2 AND (f.last_alert IS NULL OR o.window_end - f.last_alert >= 21600) THEN o.window_end ELSE f.last_alert END
  FROM fold f JOIN ordered o ON o.pair = f.pair AND o.k = f.k + 1)
SELECT c.route_id, c.direction_id, c.vehicle_id_a, c.vehicle_id_b, c.gap_ft, c.window_end FROM confirmed c JOIN fold f ON f.pair = c.pair AND f.window_end = c.window_end WHERE f.fires""",
)
def cooldown_alerts(spark, sf_dir):
    return detect.cooled_alerts(roles.adjacent(spark, sf_dir), roles.DETECTION).select("route_id", "direction_id", "vehicle_id_a", "vehicle_id_b", "gap_ft", "window_end")


@query(
    "value_dedupe",
    "SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE n = 1 OR p IS DISTINCT FROM event_type",
)
def value_dedupe(spark, sf_dir):
    return keyed.value_dedupe(roles.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"], ["event_type"]).drop("ts")


@query("latest_per_key", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, sf_dir):
    return keyed.latest_per_key(roles.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "suppression_rate",
    "SELECT event_type, count(*) AS seen, round(avg(CASE WHEN n > 1 AND p IS NOT DISTINCT FROM event_type THEN 1.0 ELSE 0.0 END), 6) AS suppressed FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY event_type",
)
def suppression_rate(spark, sf_dir):
    return messages.suppression(roles.table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type", ["event_type"])


@query(
    "alerts_by_hour",
    f"""WITH {roles.ALERTS_SQL}, days AS (SELECT DISTINCT local_date FROM alerts),
per AS (SELECT CASE WHEN isodow(local_date) < 6 THEN 'weekday' ELSE 'weekend' END AS kind, count(*) AS days FROM days GROUP BY 1),
n AS (SELECT CASE WHEN isodow(local_date) < 6 THEN 'weekday' ELSE 'weekend' END AS kind, local_hour, count(*) AS alerts FROM alerts GROUP BY ALL),
spine AS (SELECT kind, CAST(local_hour AS INTEGER) AS local_hour FROM (VALUES ('weekday'), ('weekend')) k(kind), generate_series(0, 23) h(local_hour))
SELECT kind, local_hour, CASE WHEN coalesce(days, 0) > 0 THEN round(CAST(coalesce(alerts, 0) AS DOUBLE) / days, 2) ELSE 0.0 END AS alerts_per_day FROM spine LEFT JOIN per USING (kind) LEFT JOIN n USING (kind, local_hour)""",
)
def alerts_by_hour(spark, sf_dir):
    a = roles.alerts(spark, sf_dir)
    return marts.alerts_by_hour(a, a.select("local_date").distinct())


@query(
    "route_ranking",
    f"""WITH {roles.ALERTS_SQL} SELECT route_short_name, count(*) AS alerts, round(count(*) / 30.0, 2) AS per_day, round(CAST(count(*) FILTER (local_hour IN (16, 17, 18)) AS DOUBLE) / count(*), 3) AS pm_peak_share,
round(quantile_cont(gap_ft, 0.5), 1) AS median_gap_ft FROM alerts GROUP BY route_short_name ORDER BY alerts DESC, route_short_name NULLS LAST""",
)
def route_ranking(spark, sf_dir):
    return marts.route_ranking(roles.alerts(spark, sf_dir), 30)


@query("top_routes", f"WITH {roles.ALERTS_SQL} SELECT route_short_name, count(*) AS alerts FROM alerts GROUP BY route_short_name ORDER BY alerts DESC, route_short_name NULLS LAST LIMIT 12")
def top_routes(spark, sf_dir):
    return marts.route_ranking(roles.alerts(spark, sf_dir), 30).select("route_short_name", "alerts").orderBy(F.desc("alerts"), F.asc_nulls_last("route_short_name")).limit(12)


@query(
    "health_by_day",
    f"""WITH {roles.HEALTH_SQL} SELECT strftime(minute, '%Y-%m-%d') AS day, count(*) AS minutes, count(*) FILTER (is_silent) AS silent_minutes, round(CAST(count(*) FILTER (NOT is_silent) AS DOUBLE) / count(*), 4) AS live_share,
CAST(sum(positions) AS BIGINT) AS positions, quantile_cont(CAST(median_lag_s AS DOUBLE), 0.5) AS median_lag_s FROM health GROUP BY 1""",
)
def health_by_day(spark, sf_dir):
    return marts.health_by_day(health(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))


@query(
    "kpis",
    f"""WITH {roles.ALERTS_SQL}, {roles.HEALTH_SQL.replace(roles.POSITIONS + ',', '')} SELECT (SELECT count(*) FROM positions) AS positions, (SELECT count(*) FROM alerts) AS alerts, (SELECT count(DISTINCT local_date) FROM alerts) AS days,
(SELECT round(100.0 * count(*) FILTER (NOT is_silent) / count(*), 1) FROM health) AS live_pct""",
)
def kpis(spark, sf_dir):
    alerts, shown = roles.alerts(spark, sf_dir), health(spark, sf_dir)
    one = lambda df, value: df.agg(value).scalar()
    return spark.range(1).select(
        one(roles.positions(spark, sf_dir), F.count("*")).alias("positions"), one(alerts, F.count("*")).alias("alerts"), one(alerts, F.countDistinct("local_date")).alias("days"),
        one(shown, F.round(100.0 * F.count_if(~F.col("is_silent")) / F.count("*"), 1)).alias("live_pct"),
    )


@query("alert_counts", f"WITH {roles.ALERTS_SQL} SELECT route_id, count(*) AS alerts, round(avg(CASE WHEN local_hour BETWEEN 16 AND 18 THEN 1.0 ELSE 0.0 END), 4) AS peak_share FROM alerts GROUP BY route_id")
def alert_counts(spark, sf_dir):
    return roles.alerts(spark, sf_dir).groupBy("route_id").agg(F.count("*").alias("alerts"), F.round(F.avg(F.col("local_hour").between(16, 18).cast("double")), 4).alias("peak_share"))


@query(
    "cadence",
    """WITH gaps AS (SELECT user_id, floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS gap FROM events),
ranked AS (SELECT user_id, CAST(gap AS BIGINT) AS gap, row_number() OVER (PARTITION BY user_id ORDER BY gap) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM gaps WHERE gap IS NOT NULL)
SELECT user_id, min(gap) AS min_s, max(gap) FILTER (k = n // 2) AS median_s, max(gap) AS max_s FROM ranked GROUP BY user_id""",
)
def cadence(spark, sf_dir):
    """The median is the upper of two middle values."""
    e = roles.table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    return messages.cadence(e, ["user_id"], "at", ["event_id"])
