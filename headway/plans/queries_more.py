"""Decoders, wire formats, calendars, quality checks, incremental builds and streams over the driver's tables."""

from __future__ import annotations

import re
import struct
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import Bounds
from headway.functions import text, time, wire
from headway.operators import accuracy, census
from headway.plans import incremental, marts, quality, roles
from headway.plans.define import Registry
from headway.plans.queries_core import ORACLES as CORE
from headway.plans.queries_core import health, numbers, seconds, staged
from headway.sources import archive, realtime, sinks
from headway.streaming import jobs

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
table = roles.table
COOLDOWN_SQL = CORE["cooldown_alerts"]


def folder(spark) -> str:
    """A new folder on storage that all executors share; only a local master may leave spark.checkpoint.dir unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = f"file://{tempfile.gettempdir()}"
    return f"{top.rstrip('/')}/headway-{uuid.uuid4().hex}"


# --- wire and decoders ---


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _part(number: int, value) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def payloads(spark, sf_dir) -> DataFrame:
    """Events as encoded position snapshots, one a row, some of them cut off."""
    p = roles.positions(spark, sf_dir).select("event_id", "vehicle_id", "position_s", "trip_id", "start_date", "latitude", "longitude", "current_status", "current_stop_sequence")

    def encode(batches):
        for batch in batches:
            content = []
            for r in batch.to_pylist():
                trip = _part(1, r["trip_id"].encode()) + _part(3, r["start_date"].encode())
                place = _part(1, r["latitude"]) + _part(2, r["longitude"])
                vehicle = _part(1, trip) + _part(2, place) + (_part(3, r["current_stop_sequence"]) if r["current_stop_sequence"] is not None else b"")
                vehicle += (_part(4, 1) if r["current_status"] == "STOPPED_AT" else b"") + _part(5, r["position_s"]) + _part(8, _part(1, r["vehicle_id"].encode()))
                whole = _part(1, _part(1, b"2.0") + _part(3, r["position_s"])) + _part(2, _part(1, b"e") + _part(4, vehicle)) + _part(2, _part(1, b"no vehicle"))
                content.append(whole[:-3] if r["event_id"] % 97 == 0 else whole)
            yield pa.record_batch([pa.array([str(i) for i in batch.column(0).to_pylist()]), pa.array(content, pa.binary())], names=["feed_etag", "content"])

    return p.mapInArrow(encode, "feed_etag string, content binary")


@query(
    "decode_positions",
    f"""WITH {roles.POSITIONS} SELECT CAST(event_id AS VARCHAR) AS feed_etag, CASE WHEN event_id % 97 = 0 THEN 'malformed_payload' WHEN NOT (latitude BETWEEN 47.51502 AND 47.54498) THEN 'position_out_of_bounds' END AS reason,
CASE WHEN event_id % 97 <> 0 THEN vehicle_id END AS vehicle_id, CASE WHEN event_id % 97 <> 0 THEN trip_id END AS trip_id, CASE WHEN event_id % 97 <> 0 THEN current_status END AS current_status,
CASE WHEN event_id % 97 <> 0 THEN CAST(current_stop_sequence AS DOUBLE) END AS current_stop_sequence, CASE WHEN event_id % 97 <> 0 THEN round(CAST(CAST(latitude AS FLOAT) AS DOUBLE), 5) END AS latitude FROM positions""",
)
def decode_positions(spark, sf_dir):
    rows = realtime.decode_positions(payloads(spark, sf_dir), bounds=Bounds(min_lat=47.51502, max_lat=47.54498))
    return numbers(rows.select("feed_etag", "reason", "vehicle_id", "trip_id", "current_status", "current_stop_sequence", F.round("latitude", 5).alias("latitude")), "current_stop_sequence")


@query("frame_round_trip", "SELECT event_id, CAST(event_id % 5 AS BIGINT) AS schema_id, props AS payload, length(props) + 5 AS size, false AS junk FROM events")
def frame_round_trip(spark, sf_dir):
    framed = wire.frame(F.col("props"), F.col("event_id") % 5)
    e = table(spark, sf_dir, "events").select("event_id", framed.alias("m"))
    junk = wire.unframe(F.unhex(F.lit("01000000017B7D"))).isNotNull()
    return e.select("event_id", wire.schema_id(F.col("m")).alias("schema_id"), wire.unframe(F.col("m")).cast("string").alias("payload"), F.octet_length("m").cast("long").alias("size"), junk.alias("junk"))


@query(
    "archive_keys",
    "SELECT event_id, event_id % 10 <> 0 AS readable, CASE WHEN event_id % 10 <> 0 THEN CAST(floor(epoch(ts)) AS DOUBLE) END AS epoch, CASE WHEN event_id % 10 <> 0 THEN 'abc' || event_id END AS etag FROM events",
)
def archive_keys(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    shown = F.when(F.col("event_id") % 10 == 0, ts + F.expr("INTERVAL 1 HOUR")).otherwise(ts)
    path = F.concat(F.lit("s3://x/raw/vehicle_positions/"), F.date_format(shown, "yyyy/MM/dd/HH"), F.lit("/"), F.unix_seconds(ts), F.lit("-abc"), F.col("event_id"), F.lit(".pb"))
    key = table(spark, sf_dir, "events").select("event_id", archive.parse_key(path).alias("k"))
    return key.select("event_id", F.col("k").isNotNull().alias("readable"), F.col("k.epoch").cast("double").alias("epoch"), F.col("k.etag").alias("etag"))


@query(
    "alerts_json",
    "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS alert_id, CASE WHEN conv_id % 3 = 0 THEN role WHEN conv_id % 3 = 1 THEN 'first' END AS header_text, CASE WHEN turn > 0 THEN CAST(turn * 60 AS DOUBLE) END AS start_s FROM conversations WHERE conv_id % 7 <> 0",
)
def alerts_json(spark, sf_dir):
    tr = lambda t, lang: F.struct(t.alias("text"), F.lit(lang).alias("language"))
    words = F.when(F.col("conv_id") % 3 == 0, F.array(tr(F.lit("first"), "fr"), tr(F.col("role"), "en-US"))).when(F.col("conv_id") % 3 == 1, F.array(tr(F.lit("first"), "fr"), tr(F.lit("x"), "de")))
    alert = F.struct(F.struct(words.alias("translation")).alias("header_text"), F.array(F.struct((F.col("turn") * 60).alias("start"))).alias("active_period"))
    ident = F.when(F.col("conv_id") % 7 != 0, F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    body = F.to_json(F.struct(F.array(F.struct(ident.alias("id"), alert.alias("alert"))).alias("entity")))
    made = table(spark, sf_dir, "conversations").select(F.lit("e").alias("feed_etag"), body.alias("content"))
    return realtime.decode_alerts(made).select("alert_id", "header_text", F.unix_seconds("active_period_start").cast("double").alias("start_s"))


# --- scalar functions ---


@query(
    "gtfs_clock_seconds",
    "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN CAST((event_id % 30) * 3600 + (event_id % 60) * 60 + event_id % 59 AS DOUBLE) END AS seconds FROM events",
)
def gtfs_clock_seconds(spark, sf_dir):
    i = F.col("event_id")
    clock = F.when(i % 9 == 0, F.lit("soon")).otherwise(F.format_string("%d:%02d:%02d", i % 30, i % 60, i % 59))
    return table(spark, sf_dir, "events").select("event_id", time.clock_seconds(clock).cast("double").alias("seconds"))


@query("service_day_normalise", "SELECT event_id, CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y%m%d') END AS service_day FROM events")
def service_day_normalise(spark, sf_dir):
    day = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyyMMdd")).when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_id") % 4 == 2, F.date_format("ts", "MM/dd/yyyy"))
    return table(spark, sf_dir, "events").select("event_id", time.service_day(day).alias("service_day"))


@query("epoch_text", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(floor(epoch(ts)) AS DOUBLE) END AS seconds FROM events")
def epoch_text(spark, sf_dir):
    shown = F.when(F.col("event_id") % 3 == 0, F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).otherwise("garbage")
    return table(spark, sf_dir, "events").select("event_id", time.epoch_seconds(shown).cast("double").alias("seconds"))


@query("pair_key", "SELECT DISTINCT least(l_returnflag, l_linestatus) || '|' || greatest(l_returnflag, l_linestatus) AS pair FROM lineitem")
def pair_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(text.pair_key(F.col("l_returnflag"), F.col("l_linestatus")).alias("pair")).distinct()


@query(
    "service_origin",
    "SELECT o_orderkey, CAST(epoch(timezone('America/Los_Angeles', CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP))) AS BIGINT) AS origin_s FROM orders",
)
def service_origin(spark, sf_dir):
    """Local midnight on the Pacific coast, days on which clocks change included."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.unix_seconds(time.service_origin(F.to_date("o_orderdate"))).alias("origin_s"))


@query("day_types", "SELECT CASE dayofweek(o_orderdate) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS day_type, count(*) AS n FROM orders GROUP BY 1")
def day_types(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(time.day_type(F.to_date("o_orderdate")).alias("day_type")).agg(F.count("*").alias("n"))


@query("implausible_deviation", f"WITH {roles.POSITIONS} SELECT event_id, CASE WHEN abs(schedule_deviation_seconds) <= 200 THEN CAST(schedule_deviation_seconds AS DOUBLE) END AS deviation FROM positions")
def implausible_deviation(spark, sf_dir):
    d = F.col("schedule_deviation_seconds")
    return roles.positions(spark, sf_dir).select("event_id", F.when(F.abs(d) <= 200, d).cast("double").alias("deviation"))


# --- census, quality, operations ---


@query(
    "field_census",
    """WITH c AS (SELECT count(*) AS n, count(CASE WHEN event_id % 11 <> 0 THEN event_id % 30 END) AS s, count(CASE WHEN user_id % 20 <> 19 THEN user_id END) AS r FROM events)
SELECT 'current_stop_sequence' AS path, s AS present, round(100.0 * s / n, 2) AS pct FROM c UNION ALL SELECT 'route_short_name', r, round(100.0 * r / n, 2) FROM c UNION ALL SELECT 'trip.trip_id', n, 100.0 FROM c""",
)
def field_census(spark, sf_dir):
    p = roles.positions(spark, sf_dir).select("current_stop_sequence", "route_short_name", F.struct("trip_id").alias("trip"))
    return census.field_census(p).select("path", "present", "pct")


@query("shape_compare", "SELECT * FROM (VALUES ('event_id', 'both'), ('user_id', 'first'), ('conv_id', 'second')) v(path, side)")
def shape_compare(spark, sf_dir):
    a = table(spark, sf_dir, "events").select(F.col("event_id").alias("eventId"), "user_id")
    b = table(spark, sf_dir, "conversations").select(F.col("turn").alias("event_id"), "conv_id")
    return census.shape_compare(a, b)


@query("dlq_reason_verdict", "SELECT event_type AS reason, count(*) AS n, CASE WHEN event_type = 'click' THEN count(*) > 8000 ELSE count(*) > 0 END AS alert FROM events GROUP BY event_type")
def dlq_reason_verdict(spark, sf_dir):
    return quality.dlq_verdict(table(spark, sf_dir, "events").select(F.col("event_type").alias("reason")), {"click": 8000})


@query(
    "source_freshness",
    """WITH m AS (SELECT max(ts) AS newest, max(ts) + INTERVAL 10 MINUTE AS as_of FROM events) SELECT CAST(floor(epoch(newest)) AS BIGINT) AS newest_s, 'warn' AS status FROM m""",
)
def source_freshness(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    as_of = e.agg(F.max("ts")).first()[0]
    return quality.freshness(e, "ts", F.lit(as_of) + F.expr("INTERVAL 10 MINUTES"), 5, 15)


@query("load_sanity", "SELECT o_orderstatus, count(*) AS n, CASE WHEN count(*) <= 500 OR count(*) > 10000 THEN 'warn' ELSE 'ok' END AS status FROM orders GROUP BY o_orderstatus")
def load_sanity(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("status", quality.load_sanity(F.col("n"), F.lit(5000)))


@query("dq_unique_grain", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique_grain(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_accepted_values", "SELECT event_type, count(*) AS rows FROM events WHERE event_type NOT IN ('click', 'purchase') GROUP BY event_type")
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(table(spark, sf_dir, "events"), "event_type", ["click", "purchase"])


@query("dq_not_null", f"WITH {roles.POSITIONS} SELECT event_id FROM positions WHERE current_stop_sequence IS NULL")
def dq_not_null(spark, sf_dir):
    return quality.not_null(roles.positions(spark, sf_dir), "current_stop_sequence").select("event_id")


@query("dq_recent", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
def dq_recent(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return quality.recent(e, "ts", 6, F.lit(e.agg(F.max("ts")).first()[0])).select("event_id")


@query(
    "dq_minutes_covered",
    f"""WITH {roles.HEALTH_SQL}, holed AS (SELECT minute FROM health WHERE CAST(epoch(minute) AS BIGINT) // 60 % 1000 <> 7) SELECT count(*) AS minutes, CAST((epoch(max(minute)) - epoch(min(minute))) / 60 + 1 AS BIGINT) AS expected FROM holed""",
)
def dq_minutes_covered(spark, sf_dir):
    """A mart with holes cut into it must fail; the whole one passes (tests)."""
    return quality.minutes_covered(health(spark, sf_dir).filter(F.floor(F.unix_seconds("minute") / 60) % 1000 != 7))


@query(
    "dq_alert_rowcount",
    f"WITH {roles.ALERTS_SQL} SELECT alert_id, 'missing' AS problem FROM alerts WHERE window_end // 3600 % 5 = 0 UNION ALL SELECT alert_id, 'duplicate' FROM alerts WHERE window_end // 3600 % 5 = 1",
)
def dq_alert_rowcount(spark, sf_dir):
    a = roles.alerts(spark, sf_dir).select("alert_id", F.floor(F.col("window_end") / 3600).alias("h"))
    mart = a.filter("h % 5 <> 0").unionByName(a.filter("h % 5 = 1"))
    return quality.alert_rowcount(a, mart, "alert_id")


@query(
    "dq_route_reconciles",
    f"""WITH {roles.POSITIONS}, ok AS (SELECT * FROM positions WHERE lag <= 400 AND route_short_name IS NOT NULL AND schedule_deviation_seconds IS NOT NULL)
SELECT route_short_name, strftime(position_timestamp, '%Y-%m-%d') AS service_date, count(*) AS expected, CAST(count(*) - 1 AS DOUBLE) AS found FROM ok GROUP BY ALL HAVING route_short_name = 'R3'""",
)
def dq_route_reconciles(spark, sf_dir):
    """A mart with one route's counts off by one."""
    p = staged(spark, sf_dir)
    expected = marts.countable(p).groupBy("route_short_name", F.col("service_date").cast("string").alias("service_date")).agg(F.count("*").alias("n"))
    hourly = marts.route_deviation_hourly(p, roles.HEALTH)
    mart = hourly.groupBy("route_short_name", F.col("service_date").cast("string").alias("service_date")).agg(F.sum("positions").alias("n"))
    mart = mart.withColumn("n", F.col("n") - F.when(F.col("route_short_name") == "R3", 1).otherwise(0))
    return numbers(quality.reconciles(expected, mart, ["route_short_name", "service_date"], "n"), "found")


@query("dq_fixture_loaded", "SELECT 'empty' AS missing")
def dq_fixture_loaded(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return quality.loaded({"events": e, "empty": e.filter("event_id < 0"), "orders": table(spark, sf_dir, "orders")})


@query(
    "dq_alert_located",
    f"""WITH {roles.HEALTH_SQL} SELECT event_id FROM positions JOIN health ON date_trunc('minute', position_timestamp) - INTERVAL 1 MINUTE = minute WHERE NOT is_silent AND NOT (latitude BETWEEN 47.51 AND 47.54)""",
)
def dq_alert_located(spark, sf_dir):
    a = roles.positions(spark, sf_dir).select("event_id", F.col("position_timestamp").alias("window_at"), "latitude", "longitude")
    return quality.alert_located(a, health(spark, sf_dir), Bounds(min_lat=47.51, max_lat=47.54)).select("event_id")


@query("partition_calendar", "SELECT 'p_' || strftime(d, '%Y%m%d') AS partition FROM (SELECT unnest(generate_series(DATE '2024-02-27', DATE '2024-03-06', INTERVAL 1 DAY)) AS d)")
def partition_calendar(spark, sf_dir):
    return sinks.planned_partitions(spark, "2024-03-05")


@query("serialize_records", """SELECT CAST(n_nationkey AS VARCHAR) AS key, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS value FROM nation""")
def serialize_records(spark, sf_dir):
    return sinks.serialize(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")


# --- incremental builds ---


@query("incremental_feed_health", f"WITH {roles.HEALTH_SQL} SELECT CAST(epoch(minute) AS BIGINT) AS minute, positions, vehicles, CAST(median_lag_s AS DOUBLE) AS median_lag_s, is_silent, stall_minutes FROM health")
def incremental_feed_health(spark, sf_dir):
    """Built in two steps, from the first twenty days and then all: equal to a full build."""
    p = staged(spark, sf_dir)
    first = incremental.feed_health(None, p.filter("position_at < timestamp '2024-01-20 12:34:00'"))
    return numbers(seconds(incremental.feed_health(first, p), "minute"), "median_lag_s")


@query("incremental_bucket_daily", f"WITH {roles.ACCURACY_SQL} SELECT strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d') AS observed_day, lead_bucket, count(*) AS predictions, CAST(sum(error_s) AS BIGINT) AS sum_error_s, min(lead_time_s) AS min_lead_time_s FROM accuracy GROUP BY ALL")
def incremental_bucket_daily(spark, sf_dir):
    a = roles.accuracy(spark, sf_dir).withColumn("observed_at", F.timestamp_seconds("observed_at"))
    first = marts.bucket_daily(a.filter("observed_at < timestamp '2024-01-15 10:00:00'"))
    return incremental.by_day(first, marts.bucket_daily, a, "observed_day", F.to_date("observed_at")).withColumn("observed_day", F.col("observed_day").cast("string"))


# --- streams ---


def streamed(spark, df: DataFrame, files: int = 1, order: str = "position_s") -> DataFrame:
    """A file stream over df: files written one after the other in the order of a number, and read one at a time."""
    path = folder(spark)
    if files == 1:
        df.write.parquet(path)
    else:
        cuts = df.approxQuantile(order, [i / files for i in range(1, files)], 0.01)
        part = sum((F.when(F.col(order) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        for i in range(files):
            df.filter(part == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1 if files > 1 else 1000).parquet(path)


@query(
    "stream_tumbling",
    f"""WITH {roles.POSITIONS}, w AS (SELECT CAST(floor(position_s / 3600) AS BIGINT) * 3600 + 3600 AS window_end, route_id, direction_id, vehicle_id FROM positions)
SELECT window_end, route_id, direction_id, count(DISTINCT vehicle_id) AS vehicles, count(*) AS positions FROM w WHERE window_end <= (SELECT max(epoch(position_timestamp)) - 360 FROM positions) GROUP BY ALL""",
)
def stream_tumbling(spark, sf_dir):
    """The windows that the stream itself closes, read in four files in order of time: those that end by its last watermark."""
    p = roles.positions(spark, sf_dir).select("vehicle_id", "position_timestamp", "position_s", "route_id", "direction_id")
    return jobs.run_available(jobs.tumbling_counts(streamed(spark, p, 4), roles.DETECTION), folder(spark))


@query("stream_cooldown", re.sub(r"SELECT c\.route_id.*", "SELECT DISTINCT c.pair, c.window_end, c.gap_ft FROM confirmed c JOIN fold f ON f.pair = c.pair AND f.window_end = c.window_end WHERE f.fires", COOLDOWN_SQL, flags=re.S))
def stream_cooldown(spark, sf_dir):
    """The batch pairs, streamed through the stateful cooldown."""
    pairs = roles.adjacent(spark, sf_dir).select(text.pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("pair"), "window_end", "gap_ft")
    jobs.use_rocksdb(spark)
    return jobs.run_available(jobs.cooled(streamed(spark, pairs), roles.DETECTION), folder(spark)).select("pair", "window_end", "gap_ft")


@query("stream_dedupe", "SELECT CAST(user_id AS VARCHAR) AS key, event_id AS id, event_type AS value FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE n = 1 OR p IS DISTINCT FROM event_type")
def stream_dedupe(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_type").alias("value"))
    jobs.use_rocksdb(spark)
    return jobs.run_available(jobs.value_dedupe(streamed(spark, e), None), folder(spark))


@query(
    "stream_accuracy",
    """WITH p AS (SELECT strftime(ts, '%Y%m%d') AS service_day, CAST(user_id AS VARCHAR) AS trip_id, CAST(floor(epoch(ts)) AS BIGINT) AS issued_at, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) * 9 - 300 AS predicted_arrival FROM events WHERE event_type = 'click'),
o AS (SELECT strftime(ts, '%Y%m%d') AS service_day, CAST(user_id AS VARCHAR) AS trip_id, min(CAST(floor(epoch(ts)) AS BIGINT)) AS observed_at FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT service_day, trip_id, 'p' AS stop_id, issued_at, predicted_arrival, observed_at FROM p JOIN o USING (service_day, trip_id) WHERE issued_at < observed_at AND predicted_arrival - issued_at <= 3600""",
)
def stream_accuracy(spark, sf_dir):
    p, o = accuracy.parse_predictions(roles.predictions(spark, sf_dir)), accuracy.parse_observations(roles.observations(spark, sf_dir))
    null = F.lit(None).cast("long")
    key = ["service_day", "trip_id", "stop_id"]
    tagged = p.select(*key, F.col("issued_at").alias("at"), "issued_at", "predicted_arrival", null.alias("observed_at")).unionByName(o.select(*key, F.col("observed_at").alias("at"), null.alias("issued_at"), null.alias("predicted_arrival"), "observed_at"))
    jobs.use_rocksdb(spark)
    return jobs.run_available(jobs.join_arrivals(streamed(spark, tagged), bounded=True), folder(spark))
