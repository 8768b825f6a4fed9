"""Replay reports, exports and remaining checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import wire
from headway.operators import messages
from headway.plans import marts, quality, report, roles
from headway.plans.define import Registry
from headway.plans.queries_core import numbers, with_days
from headway.plans.queries_joins import REPLAY_SQL, live_and_replay
from headway.sources import sinks

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def two_runs(spark, sf_dir):
    """Alerts of two runs: by hour of the day, and some an hour later."""
    a = roles.alerts(spark, sf_dir).select("vehicle_id_a", "vehicle_id_b", "gap_ft", "window_end", "alert_id")
    hour = F.floor(F.col("window_end") / 3600)
    return a.filter(hour % 3 != 0), a.filter(hour % 3 != 1).withColumn("window_end", F.col("window_end") + F.when(hour % 2 == 0, 300).otherwise(7200))


RUNS_SQL = (
    roles.ALERTS_SQL
    + """,
one AS (SELECT * FROM alerts WHERE (window_end // 3600) % 3 <> 0),
two AS (SELECT pair, window_end + CASE WHEN (window_end // 3600) % 2 = 0 THEN 300 ELSE 7200 END AS window_end FROM alerts WHERE (window_end // 3600) % 3 <> 1),
nearby AS (SELECT o.*, EXISTS (SELECT 1 FROM two t WHERE t.pair = o.pair AND abs(t.window_end - o.window_end) <= 600) AS near FROM one o)"""
)


@query("replay_near_alerts", f"WITH {RUNS_SQL} SELECT alert_id, near FROM nearby")
def replay_near_alerts(spark, sf_dir):
    return report.near_other(*two_runs(spark, sf_dir)).select("alert_id", "near")


@query(
    "replay_causes",
    f"""WITH {RUNS_SQL}, s AS (SELECT *, CASE WHEN CAST(vehicle_id_a AS INTEGER) % 7 = 0 THEN NULL ELSE CAST(vehicle_id_a AS INTEGER) % 7 END AS min_sequence FROM nearby),
c AS (SELECT *, CASE WHEN min_sequence IS NULL THEN 'unknown' WHEN min_sequence < 4 THEN 'below gate' ELSE 'above gate' END AS sequence_class FROM s)
SELECT CASE WHEN near THEN 'moved in time' WHEN sequence_class = 'below gate' THEN 'stop gate' ELSE 'other' END AS cause, sequence_class, count(*) AS alerts, round(quantile_cont(gap_ft, 0.5), 1) AS median_gap_ft FROM c GROUP BY ALL""",
)
def replay_causes(spark, sf_dir):
    seq = F.col("vehicle_id_a").cast("int") % 7
    return report.causes(report.near_other(*two_runs(spark, sf_dir)).withColumn("min_sequence", F.when(seq != 0, seq)))


@query("mismatches_by_minute", "SELECT strftime(ts, '%H:%M') AS minute, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def mismatches_by_minute(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    return report.mismatches_by_minute(e, "at", "UTC")


@query("half_open_window", "SELECT event_id FROM events WHERE floor(epoch(ts)) >= 1704672000 AND floor(epoch(ts)) < 1705276800")
def half_open_window(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    return report.in_window(e, "at", 1704672000, 1705276800).select("event_id")


@query("normalized_fields", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, event_type FROM events")
def normalized_fields(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    return report.normalized(e, ("value",))


@query("last_wins", f"WITH {REPLAY_SQL} SELECT l_orderkey, l_linenumber, l_partkey FROM live")
def last_wins(spark, sf_dir):
    return live_and_replay(spark, sf_dir)[0].select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "dq_error_grows",
    f"""WITH {roles.ACCURACY_SQL}, c AS (SELECT lead_bucket, CAST(round_even(quantile_cont(abs_error_s, 0.5), 0) AS DOUBLE) AS m FROM accuracy GROUP BY 1),
p AS (SELECT max(CASE WHEN lead_bucket = '0-2m' THEN m END) AS near, max(CASE WHEN lead_bucket = '45-60m' THEN m END) AS far FROM c) SELECT near, far, pessimistic FROM p, (SELECT count(*) AS pessimistic FROM (SELECT lead_bucket, round_even(avg(error_s), 0) AS e FROM accuracy GROUP BY 1) WHERE lead_bucket <> 'past' AND e <= 0) WHERE near IS NULL OR far IS NULL OR far <= near OR pessimistic > 0""",
)
def dq_error_grows(spark, sf_dir):
    a = with_days(spark, sf_dir)
    return numbers(quality.error_grows_with_lead(marts.prediction_error_by_lead(marts.error_histogram(a), marts.bucket_daily(a))), "near", "far")


@query("dq_histogram_exact", "SELECT event_type AS lead_bucket, count(*) AS rows FROM events WHERE value <> floor(value) GROUP BY 1")
def dq_histogram_exact(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("observed_at"), F.col("event_type").alias("lead_bucket"), F.col("value").alias("abs_error_s"))
    return quality.histogram_is_exact(marts.error_histogram(e)).groupBy("lead_bucket").agg(F.sum("fractional_values").alias("rows"))


@query("dead_letters", """SELECT CAST(event_id AS VARCHAR) AS key, '{"reason":"position_out_of_bounds","detail":"' || event_type || '","entity_key":"' || event_id || '","payload_b64":"' || base64(encode(props)) || '"}' AS value FROM events WHERE value > 100""")
def dead_letters(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").filter("value > 100")
    return sinks.dead_letters(e, F.lit("position_out_of_bounds"), F.col("event_type"), F.col("event_id"), F.col("props"))


@query(
    "reframe",
    "SELECT event_id, event_id % 4 AS kind, CASE WHEN event_id % 4 < 2 THEN '{\"window_end\":' || CAST(floor(epoch(ts)) AS BIGINT) || '}' END AS payload FROM events",
)
def reframe(spark, sf_dir):
    """Messages framed already, bare JSON, float epochs and junk: all come out framed with whole seconds, junk is null."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    whole, kind = F.concat(F.lit('{"window_end":'), at, F.lit("}")), F.col("event_id") % 4
    raw = F.when(kind == 0, wire.frame(whole, F.lit(7))).when(kind == 1, F.concat(F.lit('{"window_end":'), at, F.lit(".0}")).cast("binary")).when(kind == 2, F.lit("junk").cast("binary"))
    m = roles.table(spark, sf_dir, "events").select("event_id", kind.alias("kind"), raw.alias("m"))
    return m.select("event_id", "kind", wire.unframe(messages.reframed(F.col("m"), F.lit(7))).cast("string").alias("payload"))


@query("dq_stall_detected", f"WITH {roles.HEALTH_SQL} SELECT CAST(epoch(minute) AS BIGINT) AS minute, stall_minutes FROM health WHERE stall_minutes >= 20")
def dq_stall_detected(spark, sf_dir):
    from headway.plans.queries_core import health, seconds

    return seconds(health(spark, sf_dir).filter("stall_minutes >= 20"), "minute").select("minute", "stall_minutes")


@query("cast_contract", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def cast_contract(spark, sf_dir):
    from pyspark.sql import types as T

    from headway.schemas import conform

    declared = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    return conform(roles.table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("id")), declared)


@query("merge_partitions", "SELECT CAST(o_orderkey % 100 AS BIGINT) AS k, max(o_orderkey) AS n, CAST(o_orderdate AS VARCHAR) AS day FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS o_orderdate FROM orders) GROUP BY ALL")
def merge_partitions(spark, sf_dir):
    """Two batches into a partitioned table, the second twice."""
    from headway.plans.queries_more import folder

    o = roles.table(spark, sf_dir, "orders")
    rows = o.groupBy((F.col("o_orderkey") % 100).alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("day"), (F.col("o_orderkey") % 2).alias("half")).agg(F.max("o_orderkey").alias("n"))
    path = folder(spark)
    for half in (0, 1, 1):
        sinks.merge_partitions(rows.filter(F.col("half") == half).select("k", "n", "day"), path, ["k", "day"], "n", "day")
    return spark.read.parquet(path).select("k", "n", F.col("day").cast("string").alias("day"))




@query(
    "enriched_round_trip",
    f"""WITH {roles.POSITIONS} SELECT vehicle_id, position_s AS position_timestamp, latitude, trip_id, direction_id, CAST(current_stop_sequence AS DOUBLE) AS current_stop_sequence, route_short_name, shape_dist_traveled,
CAST(schedule_deviation_seconds AS DOUBLE) AS schedule_deviation_seconds FROM positions""",
)
def enriched_round_trip(spark, sf_dir):
    """Encoded, framed and decoded again: presence and negative numbers survive."""
    from headway.sources.enriched import decode_enriched, encode_enriched

    p = roles.positions(spark, sf_dir).withColumn("position_timestamp", F.col("position_s"))
    back = decode_enriched(encode_enriched(p.drop("enriched_at"), 3)).filter("decoded")
    found = back.select("vehicle_id", "position_timestamp", "latitude", "trip_id", "direction_id", "current_stop_sequence", "route_short_name", "shape_dist_traveled", "schedule_deviation_seconds")
    return numbers(found, "current_stop_sequence", "schedule_deviation_seconds")


@query("counters", "SELECT count(*) AS fetched, count(*) FILTER (value <= 400) AS published, count(*) FILTER (value > 400) AS dlq FROM events")
def counters(spark, sf_dir):
    """Counted while the rows pass by, without a second read."""
    from pyspark.sql import Observation

    seen = Observation("counters")
    e = roles.table(spark, sf_dir, "events").select("value").observe(seen, F.count("*").alias("fetched"), F.count_if(F.col("value") <= 400).alias("published"), F.count_if(F.col("value") > 400).alias("dlq"))
    e.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[c] for c in ("fetched", "published", "dlq"))], "fetched long, published long, dlq long")


@query("static_versions", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def static_versions(spark, sf_dir):
    """Published with a manifest that comes last, and read back through it."""
    from headway.plans.queries_more import folder

    path = folder(spark)
    sinks.publish_version({t: roles.table(spark, sf_dir, t) for t in ("nation", "region")}, path, 7, {"feed_etag": "x"})
    manifest = spark.read.schema("version_id long, ready boolean, row_counts map<string, bigint>").json(f"{path}/manifest")
    return manifest.filter("ready").select(F.explode("row_counts").alias("name", "n"))
