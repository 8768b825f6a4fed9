"""Staging views, intermediates and marts. Every model is a function of DataFrames; times are UTC instants unless named local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.config import LOCAL_ZONE, Warehouse
from headway.functions.rounding import float_to_int, numeric, percent
from headway.functions.time import day_type, local
from headway.operators.enrich import small


def staging_positions(raw: DataFrame, config: Warehouse = Warehouse(), zone: str = LOCAL_ZONE) -> DataFrame:
    lag = float_to_int((F.unix_micros("enriched_at") - F.unix_micros("position_at")) / 1_000_000)
    at = raw.withColumnRenamed("position_timestamp", "position_at")
    return at.withColumns({
        "position_local": local(F.col("position_at"), zone).cast("timestamp_ntz"),
        "service_date": F.try_to_timestamp("start_date", F.lit("yyyyMMdd")).cast("date"),
        "ingest_lag_s": lag, "is_stale_timestamp": lag > config.stale_lag_s,
    })


def staging_alerts(raw: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    wall = local(F.col("window_end"), zone)
    return raw.withColumns({"window_local": wall.cast("timestamp_ntz"), "local_date": F.to_date(wall), "local_hour": F.hour(wall)}).withColumnRenamed("window_end", "window_at")


def staging_accuracy(raw: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    wall = local(F.col("observed_at"), zone)
    return raw.withColumns({"service_date": F.try_to_timestamp("start_date", F.lit("yyyy-MM-dd")).cast("date"), "observed_local": wall.cast("timestamp_ntz"), "local_hour": F.hour(wall)})


def feed_health(positions: DataFrame, since: Column | None = None) -> DataFrame:
    """minute, positions, vehicles, median_lag_s, is_silent, stall_minutes; every minute from the first to the last seen.

    Only one row a minute reaches the global windows, 1,440 a day at any volume of positions.
    """
    fresh = positions.filter(~F.col("is_stale_timestamp"))
    if since is not None:
        fresh = fresh.filter(F.col("position_at") >= since)
    minute = F.date_trunc("minute", "position_at").alias("minute")
    seen = fresh.groupBy(minute).agg(F.count("*").alias("positions"), F.countDistinct("vehicle_id").alias("vehicles"), float_to_int(F.percentile("ingest_lag_s", F.lit(0.5))).alias("median_lag_s"))
    bounds = fresh.agg(F.min(F.date_trunc("minute", "position_at")).alias("first"), F.max(F.date_trunc("minute", "position_at")).alias("last"))
    spine = bounds.filter("first is not null").select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    grid = spine.join(seen, "minute", "left").select("minute", F.coalesce("positions", F.lit(0)).alias("positions"), F.coalesce("vehicles", F.lit(0)).alias("vehicles"), "median_lag_s", F.col("positions").isNull().alias("is_silent"))
    island = F.row_number().over(Window.orderBy("minute")) - F.row_number().over(Window.partitionBy("is_silent").orderBy("minute"))
    run = F.count("*").over(Window.partitionBy("is_silent", "_island"))
    return grid.withColumn("_island", island).withColumn("stall_minutes", F.when(F.col("is_silent"), run).otherwise(0)).drop("_island")


def health_mart(health: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The published form: with the local wall clock of each minute."""
    return health.withColumn("minute_local", local(F.col("minute"), zone).cast("timestamp_ntz"))


def stall_report(health: DataFrame, config: Warehouse = Warehouse()) -> DataFrame:
    """One row always: the longest silent run that ended in the mart's last minutes, and whether it alerts."""
    newest = health.agg(F.max("minute")).scalar()
    recent = health.filter(F.col("minute") > newest - F.expr(f"INTERVAL {config.stall_window_min} MINUTES"))
    island = F.row_number().over(Window.orderBy("minute")) - F.row_number().over(Window.partitionBy("is_silent").orderBy("minute"))
    runs = recent.withColumn("_i", island).filter("is_silent").groupBy("_i").agg(F.min("minute").alias("start"), F.max("minute").alias("end"), F.count("*").alias("minutes"))
    worst = runs.agg(F.max(F.struct("minutes", "start", "end")).alias("w"))
    return worst.select(F.coalesce("w.minutes", F.lit(0)).cast("long").alias("stall_minutes"), F.unix_seconds("w.start").alias("start_s"), F.unix_seconds("w.end").alias("end_s"), (F.coalesce("w.minutes", F.lit(0)) >= config.stall_alert_min).alias("alert"))


def countable(positions: DataFrame) -> DataFrame:
    return positions.filter(~F.col("is_stale_timestamp") & F.col("route_short_name").isNotNull() & F.col("schedule_deviation_seconds").isNotNull())


def route_deviation_hourly(positions: DataFrame, config: Warehouse = Warehouse()) -> DataFrame:
    late = F.count_if(F.col("schedule_deviation_seconds") > config.late_s)
    return countable(positions).groupBy("route_short_name", "service_date", F.hour("position_local").alias("local_hour")).agg(
        F.count("*").alias("positions"), float_to_int(F.percentile("schedule_deviation_seconds", F.lit(0.5))).alias("median_deviation_s"), percent(late, F.count("*")).alias("pct_late")
    )


def bunching_by_route_hour(alerts: DataFrame) -> DataFrame:
    median = lambda c, k: numeric(F.percentile(c, F.lit(0.5)), k)
    return alerts.groupBy("route_short_name", "direction_id", "local_hour").agg(
        F.count("*").alias("alerts"), median("gap_ft", 1).cast("decimal(10,1)").alias("median_gap_ft"),
        median("deviation_a", 0).cast("int").alias("median_deviation_a"), median("deviation_b", 0).cast("int").alias("median_deviation_b"),
    )


def error_histogram(accuracy: DataFrame) -> DataFrame:
    day = F.to_date("observed_at").alias("observed_day")
    return accuracy.groupBy(day, "lead_bucket", F.col("abs_error_s").cast("int").alias("abs_error_s")).agg(F.count("*").alias("predictions"), F.count_if(F.col("abs_error_s") != F.floor("abs_error_s")).alias("fractional_values"))


def bucket_daily(accuracy: DataFrame) -> DataFrame:
    return accuracy.groupBy(F.to_date("observed_at").alias("observed_day"), "lead_bucket").agg(F.count("*").alias("predictions"), F.sum("error_s").alias("sum_error_s"), F.min("lead_time_s").alias("min_lead_time_s"))


def prediction_error_by_lead(histogram: DataFrame, daily: DataFrame) -> DataFrame:
    """The error curve from pre-aggregated counts; the percentiles are those of the single errors."""
    at = lambda p: F.percentile("abs_error_s", F.lit(p), F.col("predictions"))
    shape = histogram.groupBy("lead_bucket").agg(F.rint(at(0.5)).cast("int").alias("median_abs_error_s"), F.rint(at(0.9)).cast("int").alias("p90_abs_error_s"))
    totals = daily.groupBy("lead_bucket").agg(F.sum("predictions").alias("predictions"), F.rint(F.sum("sum_error_s") / F.sum("predictions")).cast("int").alias("mean_error_s"), F.min("min_lead_time_s").alias("bucket_order"))
    return totals.join(shape, "lead_bucket").orderBy("bucket_order")


def histogram_percentile(histogram: DataFrame, groups: list[str], value: str, count: str, p: float) -> DataFrame:
    """The same percentile written out: the values at the ranks on both sides, interpolated. A cross-check of percentile()."""
    w = Window.partitionBy(*groups)
    upto = F.sum(count).over(w.orderBy(value))
    ranked = histogram.groupBy(*groups, value).agg(F.sum(count).alias(count)).withColumn("_upto", upto).withColumn("_rank", F.lit(p) * (F.sum(count).over(w) - 1))
    holds = lambda r: (F.col("_upto") - F.col(count) <= r) & (F.col("_upto") > r)
    low, high = F.max(F.when(holds(F.floor("_rank")), F.col(value))), F.max(F.when(holds(F.ceil("_rank")), F.col(value)))
    return ranked.groupBy(*groups).agg(low.alias("_low"), high.alias("_high"), F.max("_rank").alias("_rank")).select(*groups, (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_rank") - F.floor("_rank"))).alias("value"))


def last_positions(alerts: DataFrame, positions: DataFrame, vehicle: str, trip: str, window_s: int = 60) -> DataFrame:
    """For each alert the vehicle's latest position on the trip in the window before it: an equi-join on minutes, then max_by.

    Times are epoch seconds. A window of one minute touches two minutes, so each alert probes two keys.
    """
    slot = lambda c: F.floor(c / window_s)
    asked = alerts.select(F.col("alert_id"), F.col(vehicle).alias("vehicle_id"), F.col(trip).alias("trip_id"), "window_end")
    asked = asked.withColumn("slot", F.explode(F.array(slot(F.col("window_end") - window_s), slot(F.col("window_end") - 1)))).distinct()
    seen = positions.select("vehicle_id", "trip_id", "position_s", "latitude", "longitude", "stop_id", "current_stop_sequence").withColumn("slot", slot(F.col("position_s")))
    hit = asked.join(seen, ["vehicle_id", "trip_id", "slot"]).filter("position_s >= window_end - %d and position_s < window_end" % window_s)
    return hit.groupBy("alert_id").agg(F.max_by(F.struct("latitude", "longitude", "stop_id", "current_stop_sequence", "position_s"), F.struct("position_s", "stop_id")).alias("p"))


def placed_alerts(alerts: DataFrame, positions: DataFrame, stops: DataFrame, window_s: int = 60) -> DataFrame:
    """Alerts at the midpoint of both vehicles' last positions, named by the stop of the one that is behind."""
    a = last_positions(alerts, positions, "vehicle_id_a", "trip_id_a", window_s).withColumnRenamed("p", "a")
    b = last_positions(alerts, positions, "vehicle_id_b", "trip_id_b", window_s).withColumnRenamed("p", "b")
    joined = alerts.join(a, "alert_id", "left").join(b, "alert_id", "left")
    sa, sb = F.col("a.current_stop_sequence"), F.col("b.current_stop_sequence")
    stop = F.when(sa.isNull() & sb.isNull(), None).when(sb.isNull() | (sa <= sb), F.col("a.stop_id")).otherwise(F.col("b.stop_id"))
    named = latest_stop_names(stops)
    mid = lambda c: (F.col(f"a.{c}") + F.col(f"b.{c}")) / 2
    placed = joined.select(*alerts.columns, mid("latitude").alias("latitude"), mid("longitude").alias("longitude"), stop.alias("stop_id"))
    named = small(named)
    if "local_date" in placed.columns:
        placed = placed.withColumn("day_type", day_type(F.col("local_date")))
    return placed.join(named, "stop_id", "left")


def latest_stop_names(stops: DataFrame) -> DataFrame:
    """One row for each stop id of the schedule: a reference table of bounded size."""
    return stops.groupBy("stop_id").agg(F.max_by("stop_name", "version_id").alias("stop_name"))


def alerts_by_hour(alerts: DataFrame, days: DataFrame) -> DataFrame:
    """Alerts a day for each of 24 hours and kind of day, zeros filled in; days: local_date."""
    kind = F.when(day_type(F.col("local_date")) == "weekday", "weekday").otherwise("weekend").alias("kind")
    per = days.groupBy(kind).agg(F.count("*").alias("days"))
    kinds = alerts.sparkSession.createDataFrame([("weekday",), ("weekend",)], "kind string")
    spine = kinds.select("kind", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("local_hour"))
    counted = alerts.groupBy(kind, "local_hour").agg(F.count("*").alias("alerts"))
    rate = F.when(F.coalesce("days", F.lit(0)) > 0, F.round(F.coalesce("alerts", F.lit(0)) / F.col("days"), 2)).otherwise(0.0)
    return spine.join(per, "kind", "left").join(counted, ["kind", "local_hour"], "left").select("kind", "local_hour", rate.alias("alerts_per_day"))


def route_ranking(alerts: DataFrame, days: int, peak: tuple[int, ...] = Warehouse().peak_hours) -> DataFrame:
    peaks = F.count_if(F.col("local_hour").isin(*peak))
    return alerts.groupBy("route_short_name").agg(
        F.count("*").alias("alerts"), F.round(F.count("*") / F.lit(float(days)), 2).alias("per_day"),
        F.round(peaks / F.count("*"), 3).alias("pm_peak_share"), F.round(F.percentile("gap_ft", F.lit(0.5)), 1).alias("median_gap_ft"),
    ).orderBy(F.desc("alerts"), F.asc_nulls_last("route_short_name"))


def hotspots(alerts: DataFrame, top: int = 3, digits: int = 5, peak: tuple[int, ...] = Warehouse().peak_hours) -> DataFrame:
    """Located alerts by stop, with the routes that have most of them: counted first, so that no list holds single alerts."""
    located = alerts.filter("latitude is not null and longitude is not null")
    sums = located.groupBy("stop_id", "route_short_name").agg(F.count("*").alias("n"), F.sum("longitude").alias("lon"), F.sum("latitude").alias("lat"), F.count_if(F.col("local_hour").isin(*peak)).alias("pm"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("route_short_name").isNull().alias("u"), F.col("route_short_name").alias("r"))))
    return sums.groupBy("stop_id").agg(
        F.sum("n").alias("alerts"), F.round(F.sum("lon") / F.sum("n"), digits).alias("longitude"), F.round(F.sum("lat") / F.sum("n"), digits).alias("latitude"), F.sum("pm").alias("pm_alerts"),
        F.array_join(F.transform(F.slice(order, 1, top), lambda x: F.coalesce(x["r"], F.lit("?"))), ",").alias("top_routes"),
    )


def health_by_day(health: DataFrame) -> DataFrame:
    return health.groupBy(F.to_date("minute").alias("day")).agg(
        F.count("*").alias("minutes"), F.count_if("is_silent").alias("silent_minutes"), F.round(F.count_if(~F.col("is_silent")) / F.count("*"), 4).alias("live_share"),
        F.sum("positions").alias("positions"), F.percentile("median_lag_s", F.lit(0.5)).alias("median_lag_s"),
    )
