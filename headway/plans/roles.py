"""The driver's tables in the roles of the domain's records, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import Bunching, Warehouse

#: Thresholds that split the driver's tables; the domain's own are in headway.config.
HEALTH = Warehouse(stale_lag_s=400)
DETECTION = Bunching(gap_ft=5000.0, max_age_s=3600, window_s=3600, cooldown_s=21_600, min_consecutive=2, min_progress_ft=100.0, min_stop_sequence=4)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as enriched positions."""
    e = table(spark, sf_dir, "events")
    i, lag = F.col("event_id"), F.floor("value").cast("int")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id", F.col("user_id").cast("string").alias("vehicle_id"), ts.alias("position_timestamp"), F.unix_seconds(ts).alias("position_s"),
        F.concat(F.lit("t"), F.col("user_id") % 7).alias("trip_id"), (F.col("user_id") % 2).cast("string").alias("route_id"), F.lit(0).alias("direction_id"),
        F.date_format(ts, "yyyyMMdd").alias("start_date"), (F.lit(47.5) + (i * 7919) % 1000 / 20000.0).alias("latitude"), (F.lit(-122.3) + (i * 104729) % 1000 / 20000.0).alias("longitude"),
        F.when(F.col("event_type") == "error", "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("current_status"), F.concat(F.lit("s"), i % 50).alias("stop_id"),
        F.when(i % 11 != 0, (i % 30).cast("int")).alias("current_stop_sequence"), F.when(F.col("user_id") % 20 != 19, F.concat(F.lit("R"), F.col("user_id") % 20)).alias("route_short_name"),
        ((i * 631) % 60000).cast("double").alias("shape_dist_traveled"), F.when(i % 13 != 0, lag - 250).alias("schedule_deviation_seconds"),
        F.timestamp_micros(F.unix_micros(ts) + lag.cast("long") * 1_000_000).alias("enriched_at"), lag.alias("lag"),
    )


POSITIONS = """
positions AS (SELECT event_id, CAST(user_id AS VARCHAR) AS vehicle_id, ts AS position_timestamp, CAST(floor(epoch(ts)) AS BIGINT) AS position_s, 't' || (user_id % 7) AS trip_id,
  CAST(user_id % 2 AS VARCHAR) AS route_id, 0 AS direction_id, strftime(ts, '%Y%m%d') AS start_date,
  CAST(47.5 AS DOUBLE) + CAST((event_id * 7919) % 1000 AS DOUBLE) / 20000 AS latitude, CAST(-122.3 AS DOUBLE) + CAST((event_id * 104729) % 1000 AS DOUBLE) / 20000 AS longitude,
  CASE WHEN event_type = 'error' THEN 'STOPPED_AT' ELSE 'IN_TRANSIT_TO' END AS current_status, 's' || (event_id % 50) AS stop_id,
  CASE WHEN event_id % 11 <> 0 THEN event_id % 30 END AS current_stop_sequence, CASE WHEN user_id % 20 <> 19 THEN 'R' || (user_id % 20) END AS route_short_name,
  CAST((event_id * 631) % 60000 AS DOUBLE) AS shape_dist_traveled, CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value) AS INTEGER) - 250 END AS schedule_deviation_seconds,
  CAST(floor(value) AS INTEGER) AS lag FROM events)"""

HEALTH_SQL = (
    POSITIONS
    + """,
fresh AS (SELECT date_trunc('minute', position_timestamp) AS minute, vehicle_id, lag FROM positions WHERE lag <= 400),
seen AS (SELECT minute, count(*) AS positions, count(DISTINCT vehicle_id) AS vehicles, CAST(round_even(quantile_cont(lag, 0.5), 0) AS INTEGER) AS median_lag_s FROM fresh GROUP BY minute),
spine AS (SELECT unnest(generate_series((SELECT min(minute) FROM fresh), (SELECT max(minute) FROM fresh), INTERVAL 1 MINUTE)) AS minute),
grid AS (SELECT spine.minute, coalesce(positions, 0) AS positions, coalesce(vehicles, 0) AS vehicles, median_lag_s, positions IS NULL AS is_silent FROM spine LEFT JOIN seen ON spine.minute = seen.minute),
islands AS (SELECT *, row_number() OVER (ORDER BY minute) - row_number() OVER (PARTITION BY is_silent ORDER BY minute) AS island FROM grid),
health AS (SELECT minute, positions, vehicles, median_lag_s, is_silent, CASE WHEN is_silent THEN count(*) OVER (PARTITION BY is_silent, island) ELSE 0 END AS stall_minutes FROM islands)"""
)


def adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.operators import detect as d

    return d.adjacent_pairs(d.gates(d.latest_in_window(d.parse_records(positions(spark, sf_dir)), DETECTION), DETECTION), DETECTION)


HAVERSINE = "2 * 6371008.8 / 0.3048 * asin(least(1.0, sqrt(pow(sin((radians(b_lat) - radians(a_lat)) / 2), 2) + cos(radians(a_lat)) * cos(radians(b_lat)) * pow(sin((radians(b_lon) - radians(a_lon)) / 2), 2))))"

PAIRS_SQL = (
    POSITIONS
    + f""",
latest AS (SELECT * FROM (SELECT *, CAST(floor(position_s / 3600) AS BIGINT) * 3600 + 3600 AS window_end,
    row_number() OVER (PARTITION BY CAST(floor(position_s / 3600) AS BIGINT), route_id, direction_id, vehicle_id ORDER BY position_timestamp DESC) AS n FROM positions) WHERE n = 1),
moving AS (SELECT * FROM latest WHERE shape_dist_traveled >= 100 AND coalesce(current_stop_sequence, 0) >= 4),
near AS (SELECT window_end, route_id, direction_id, route_short_name, vehicle_id AS vehicle_id_a, trip_id AS trip_id_a, schedule_deviation_seconds AS deviation_a, shape_dist_traveled AS a_dist, latitude AS a_lat, longitude AS a_lon,
    lead(vehicle_id) OVER w AS vehicle_id_b, lead(trip_id) OVER w AS trip_id_b, lead(schedule_deviation_seconds) OVER w AS deviation_b, lead(shape_dist_traveled) OVER w AS b_dist, lead(latitude) OVER w AS b_lat, lead(longitude) OVER w AS b_lon
  FROM moving WINDOW w AS (PARTITION BY window_end, route_id, direction_id ORDER BY shape_dist_traveled, vehicle_id)),
pairs AS (SELECT *, b_dist - a_dist AS gap_ft, {HAVERSINE} AS apart_ft FROM near WHERE vehicle_id_b IS NOT NULL AND b_dist - a_dist < 5000),
confirmed AS (SELECT *, least(vehicle_id_a, vehicle_id_b) || '|' || greatest(vehicle_id_a, vehicle_id_b) AS pair FROM pairs WHERE apart_ft <= greatest(gap_ft, 5000) * 1.25)"""
)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed pairs as alerts, with an id and local calendar columns (UTC)."""
    at = F.timestamp_seconds("window_end")
    return adjacent(spark, sf_dir).withColumns({
        "alert_id": F.concat_ws("/", "vehicle_id_a", "vehicle_id_b", F.col("window_end").cast("string")), "local_date": F.to_date(at), "local_hour": F.hour(at),
    })


ALERTS_SQL = (
    PAIRS_SQL
    + """,
alerts AS (SELECT *, vehicle_id_a || '/' || vehicle_id_b || '/' || window_end AS alert_id, CAST(make_timestamp(window_end * 1000000) AS DATE) AS local_date,
  CAST((window_end // 3600) % 24 AS INTEGER) AS local_hour FROM confirmed)"""
)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as predictions of the user's purchases: key (day, user, 'p')."""
    e = table(spark, sf_dir, "events").filter("event_type = 'click'")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("start_date"), F.col("user_id").cast("string").alias("trip_id"), F.lit("p").alias("stop_id"),
        at.alias("issued_at"), (at + F.floor("value").cast("long") * 9 - 300).alias("predicted_arrival"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as arrivals."""
    e = table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.date_format(ts, "yyyyMMdd").alias("start_date"), F.col("user_id").cast("string").alias("trip_id"), F.lit("p").alias("stop_id"), F.lit("STOPPED_AT").alias("current_status"),
        (F.col("user_id") % 20).cast("string").alias("route_id"), F.concat(F.lit("R"), F.col("user_id") % 20).alias("route_short_name"), F.unix_seconds(ts).alias("observed_at"),
    )


ACCURACY_SQL = """
predictions AS (SELECT strftime(ts, '%Y%m%d') AS service_day, CAST(user_id AS VARCHAR) AS trip_id, CAST(floor(epoch(ts)) AS BIGINT) AS issued_at,
  CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) * 9 - 300 AS predicted_arrival FROM events WHERE event_type = 'click'),
arrivals AS (SELECT strftime(ts, '%Y%m%d') AS service_day, CAST(user_id AS VARCHAR) AS trip_id, min(user_id % 20) AS route, min(CAST(floor(epoch(ts)) AS BIGINT)) AS observed_at FROM events WHERE event_type = 'purchase' GROUP BY ALL),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY service_day, trip_id ORDER BY issued_at DESC, predicted_arrival DESC) AS n FROM predictions JOIN arrivals USING (service_day, trip_id) WHERE issued_at < observed_at) WHERE n <= 120),
accuracy AS (SELECT *, CASE WHEN lead_time_s < 0 THEN 'past' WHEN lead_time_s < 120 THEN '0-2m' WHEN lead_time_s < 300 THEN '2-5m' WHEN lead_time_s < 600 THEN '5-10m' WHEN lead_time_s < 900 THEN '10-15m'
    WHEN lead_time_s < 1200 THEN '15-20m' WHEN lead_time_s < 1800 THEN '20-30m' WHEN lead_time_s < 2700 THEN '30-45m' ELSE '45-60m' END AS lead_bucket, abs(error_s) AS abs_error_s
  FROM (SELECT service_day, trip_id, 'p' AS stop_id, CAST(route AS VARCHAR) AS route_id, 'R' || route AS route_short_name, issued_at, predicted_arrival, observed_at,
      predicted_arrival - issued_at AS lead_time_s, predicted_arrival - observed_at AS error_s FROM newest)
  WHERE lead_time_s <= 3600)"""


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.operators import accuracy as a

    return a.join_arrivals(a.parse_predictions(predictions(spark, sf_dir)), a.parse_observations(observations(spark, sf_dir)))
