"""Replay comparison reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import LOCAL_ZONE, Warehouse
from headway.functions.text import pair_key
from headway.functions.time import local


def normalized(df: DataFrame, ignore: tuple[str, ...] = ("enriched_at",)) -> DataFrame:
    """Instants as epoch seconds, without the columns that a replay can't reproduce."""
    kept = df.drop(*ignore)
    return kept.select(*[F.unix_seconds(c).alias(c) if t == "timestamp" else F.col(c) for c, t in kept.dtypes])


def in_window(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    """Rows from start on, before end."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def near_other(alerts: DataFrame, others: DataFrame, within_s: int = 600) -> DataFrame:
    """alerts with near: another set's alert of the same unordered pair within some seconds. An equi-join on pair and slot."""
    slot = lambda c: F.floor(c / within_s)
    keyed = alerts.withColumn("_pair", pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b"))).withColumn("_slot", slot(F.col("window_end")))
    them = others.select(pair_key(F.col("vehicle_id_a"), F.col("vehicle_id_b")).alias("_pair"), F.col("window_end").alias("_then"))
    them = them.withColumn("_slot", F.explode(F.array(slot(F.col("_then")) - 1, slot(F.col("_then")), slot(F.col("_then")) + 1))).distinct()
    hit = keyed.join(them, ["_pair", "_slot"]).filter(F.abs(F.col("_then") - F.col("window_end")) <= within_s).select("_pair", "window_end").distinct().withColumn("near", F.lit(True))
    return keyed.join(hit, ["_pair", "window_end"], "left").select(*alerts.columns, F.coalesce("near", F.lit(False)).alias("near"))


def causes(alerts: DataFrame, gate: int = 4) -> DataFrame:
    """cause, sequence class and counts of alerts that only one run has: near another, below the stop gate, or other."""
    low = F.when(F.col("min_sequence").isNull(), "unknown").when(F.col("min_sequence") < gate, "below gate").otherwise("above gate")
    cause = F.when(F.col("near"), "moved in time").when(low == "below gate", "stop gate").otherwise("other")
    return alerts.groupBy(cause.alias("cause"), low.alias("sequence_class")).agg(F.count("*").alias("alerts"), F.round(F.percentile("gap_ft", F.lit(0.5)), 1).alias("median_gap_ft"))


def by_route(baseline: DataFrame, variant: DataFrame) -> DataFrame:
    """route_short_name and its alerts in both runs, most alerts first."""
    side = lambda df, n: df.select("route_short_name", F.lit(n).alias("run"))
    both = side(baseline, 0).unionByName(side(variant, 1))
    rows = both.groupBy("route_short_name").agg(F.count_if(F.col("run") == 0).alias("baseline"), F.count_if(F.col("run") == 1).alias("variant"))
    return rows.orderBy(F.desc(F.col("baseline") + F.col("variant")), F.asc_nulls_last("route_short_name"))


def added_by_route(added: DataFrame, routes: int = 8, stops: int = 3) -> DataFrame:
    """Alerts (route_short_name, gap_ft, stop) that only the variant has: the routes with most, their median gap and top stops."""
    totals = added.groupBy("route_short_name").agg(F.count("*").alias("added"), F.percentile("gap_ft", F.lit(0.5)).alias("median_gap_ft"))
    each = added.groupBy("route_short_name", "stop").agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.coalesce("stop", F.lit("?")).alias("s"))))
    top = each.groupBy("route_short_name").agg(F.array_join(F.transform(F.slice(order, 1, stops), lambda x: F.concat(x["s"], F.lit(":"), (-x["k"]).cast("string"))), ",").alias("stops"))
    a, b = totals.alias("a"), top.alias("b")
    joined = a.join(b, F.col("a.route_short_name").eqNullSafe(F.col("b.route_short_name"))).select("a.route_short_name", "added", "median_gap_ft", "stops")
    return joined.orderBy(F.desc("added"), F.asc_nulls_last("route_short_name")).limit(routes)


def peak_share(alerts: DataFrame, peak: tuple[int, ...] = Warehouse().peak_hours, zone: str = LOCAL_ZONE) -> DataFrame:
    """One row: alerts, and the share of them in the local peak hours."""
    hour = F.hour(local(F.timestamp_seconds("window_end"), zone))
    return alerts.agg(F.count("*").alias("alerts"), F.round(F.coalesce(F.count_if(hour.isin(*peak)) / F.count("*"), F.lit(0.0)), 4).alias("peak_share"))


def mismatches_by_minute(df: DataFrame, at: str, zone: str) -> DataFrame:
    """Counts by minute of the local day."""
    return df.groupBy(F.date_format(local(F.timestamp_seconds(at), zone), "HH:mm").alias("minute")).agg(F.count("*").alias("n"))
