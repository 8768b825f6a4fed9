"""Bus bunching: neighbours on one shape within a window, confirmed, then held to a run and a cooldown for each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.config import Bunching
from headway.functions.geo import haversine_ft
from headway.functions.text import pair_key

#: The detector's columns, and those that must not be null.
COLUMNS = ("vehicle_id", "position_timestamp", "trip_id", "route_id", "direction_id", "route_short_name", "latitude", "longitude", "shape_dist_traveled", "schedule_deviation_seconds", "current_stop_sequence")
REQUIRED = ("vehicle_id", "position_timestamp", "route_id", "direction_id", "shape_dist_traveled", "latitude", "longitude")


def parse_records(positions: DataFrame) -> DataFrame:
    return positions.select(*COLUMNS).dropna(subset=list(REQUIRED))


def latest_in_window(positions: DataFrame, config: Bunching = Bunching(), tie: str = "trip_id") -> DataFrame:
    """The latest position of each vehicle in each tumbling window; equal times are decided by the least tie column, null last."""
    window = F.window("position_timestamp", f"{config.window_s} seconds")
    rest = [c for c in positions.columns if c not in ("vehicle_id", "route_id", "direction_id")]
    order = F.struct((-F.unix_micros("position_timestamp")).alias("t"), F.col(tie).isNull().alias("n"), F.col(tie).alias("v"))
    grouped = positions.groupBy(window.alias("_w"), "route_id", "direction_id", "vehicle_id").agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return grouped.select(F.unix_seconds("_w.end").alias("window_end"), "route_id", "direction_id", "vehicle_id", *[F.col("_row")[c].alias(c) for c in rest])


def gates(latest: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """Fresh, under way, and past the first stops."""
    fresh = F.col("window_end") - F.unix_seconds("position_timestamp") <= config.max_age_s
    moving = (F.col("shape_dist_traveled") >= config.min_progress_ft) & (F.coalesce("current_stop_sequence", F.lit(0)) >= config.min_stop_sequence)
    return latest.filter(fresh & moving)


def adjacent_pairs(latest: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """Neighbours by distance within a window, route and direction, closer than the gap; a has the smaller distance."""
    w = Window.partitionBy("window_end", "route_id", "direction_id").orderBy("shape_dist_traveled", "vehicle_id")
    fields = ("vehicle_id", "trip_id", "shape_dist_traveled", "latitude", "longitude", "schedule_deviation_seconds")
    ahead = F.lead(F.struct(*fields)).over(w).alias("b")
    paired = latest.select("window_end", "route_id", "direction_id", "route_short_name", F.struct(*fields).alias("a"), ahead).filter("b is not null")
    gap = F.col("b.shape_dist_traveled") - F.col("a.shape_dist_traveled")
    near = haversine_ft(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")) <= F.greatest(gap, F.lit(config.gap_ft)) * config.proximity_margin
    return paired.filter((gap < config.gap_ft) & near).select(
        "route_id", "direction_id", "route_short_name", F.col("a.vehicle_id").alias("vehicle_id_a"), F.col("b.vehicle_id").alias("vehicle_id_b"),
        F.col("a.trip_id").alias("trip_id_a"), F.col("b.trip_id").alias("trip_id_b"), gap.alias("gap_ft"), "window_end",
        F.col("a.schedule_deviation_seconds").alias("deviation_a"), F.col("b.schedule_deviation_seconds").alias("deviation_b"),
    )


def cooldown_step(consecutive: int, last_window: int | None, last_alert: int | None, window_end: int, config: Bunching = Bunching()):
    """One window of a pair: (alert or not, consecutive, last window, last alert). Shared by batch tests and the stream."""
    consecutive = consecutive + 1 if last_window is not None and window_end - last_window <= config.window_s else 1
    fires = consecutive >= config.min_consecutive and (last_alert is None or window_end - last_alert >= config.cooldown_s)
    return fires, consecutive, window_end, window_end if fires else last_alert


def cooldown_fold(windows: Column, config: Bunching = Bunching()) -> Column:
    """The windows of a sorted array that alert: a run of min_consecutive, and cooldown_s since the last alert."""
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("long").alias("alert"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, w: Column) -> Column:
        n = F.when(w - acc["last"] <= config.window_s, acc["n"] + 1).otherwise(1)
        fires = (n >= config.min_consecutive) & F.coalesce(w - acc["alert"] >= config.cooldown_s, F.lit(True))
        return F.struct(n.alias("n"), w.alias("last"), F.when(fires, w).otherwise(acc["alert"]).alias("alert"), F.when(fires, F.concat(acc["out"], F.array(w))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(windows, start, step, lambda acc: acc["out"])


def cooldown_run(rows: Column, n: Column, last: Column, alert: Column, config: Bunching = Bunching()) -> Column:
    """Struct (n, last, alert, out) after sorted rows (window_end, row) of a pair, from the state before them; out: rows that alert."""
    start = F.struct(F.coalesce(n, F.lit(0)).alias("n"), last.alias("last"), alert.alias("alert"), F.transform(F.filter(rows, lambda r: F.lit(False)), lambda r: r["row"]).alias("out"))

    def step(acc: Column, r: Column) -> Column:
        w = r["window_end"]
        run = F.when(w - acc["last"] <= config.window_s, acc["n"] + 1).otherwise(1)
        fires = (run >= config.min_consecutive) & F.coalesce(w - acc["alert"] >= config.cooldown_s, F.lit(True))
        return F.struct(run.alias("n"), w.alias("last"), F.when(fires, w).otherwise(acc["alert"]).alias("alert"), F.when(fires, F.concat(acc["out"], F.array(r["row"]))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(rows, start, step)


def cooled_alerts(pairs: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """The rows of pairs that alert. A pair's windows fit in an array: one a minute."""
    keyed = pairs.withColumn("pair", pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")))
    fired = keyed.groupBy("pair").agg(F.array_sort(F.collect_set("window_end")).alias("w")).select("pair", F.explode(cooldown_fold(F.col("w"), config)).alias("window_end"))
    return keyed.join(fired, ["pair", "window_end"]).drop("pair").select(*pairs.columns)


def detect(positions: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    return cooled_alerts(adjacent_pairs(gates(latest_in_window(parse_records(positions), config), config), config), config)


def consecutive_runs(pairs: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """pair, window_end, position in its run of windows no more than window_s apart."""
    distinct = pairs.select(pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("pair"), "window_end").distinct()
    w = Window.partitionBy("pair").orderBy("window_end")
    broken = F.when(F.col("window_end") - F.lag("window_end").over(w) <= config.window_s, 0).otherwise(1)
    runs = distinct.withColumn("_break", broken).withColumn("_run", F.sum("_break").over(w))
    return runs.select("pair", "window_end", F.row_number().over(Window.partitionBy("pair", "_run").orderBy("window_end")).cast("long").alias("run_position"))
