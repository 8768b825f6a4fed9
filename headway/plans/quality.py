"""Data quality: every check returns the failing rows; none means it passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.config import Bounds
from headway.functions.geo import in_bounds
from headway.operators.keyed import duplicates


def recent(df: DataFrame, column: str, hours: int | None, as_of: Column) -> DataFrame:
    """Rows of the last hours before as_of; all where hours is None."""
    return df if hours is None else df.filter(F.col(column) >= as_of - F.expr(f"INTERVAL {hours} HOURS"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, grain: list[str]) -> DataFrame:
    return duplicates(df, grain)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values that occur and aren't listed; null passes."""
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("rows"))


def minutes_covered(health: DataFrame) -> DataFrame:
    """The mart must have one row for each minute of its span."""
    span = health.agg(F.count("*").alias("minutes"), ((F.unix_seconds(F.max("minute")) - F.unix_seconds(F.min("minute"))) / 60 + 1).cast("long").alias("expected"))
    return span.filter("minutes <> expected")


def alert_rowcount(staged: DataFrame, mart: DataFrame, key: str) -> DataFrame:
    """Staged alerts that the mart lacks or has twice, and mart rows that nothing staged explains."""
    missing = staged.select(key).join(mart.select(key), key, "left_anti").select(key, F.lit("missing").alias("problem"))
    orphan = mart.select(key).join(staged.select(key), key, "left_anti").select(key, F.lit("orphan").alias("problem"))
    return missing.unionByName(orphan).unionByName(duplicates(mart, [key]).select(key, F.lit("duplicate").alias("problem")))


def alert_located(alerts: DataFrame, health: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Alerts must be placed inside the bounds where the minute before was live; window_at and minute are instants."""
    live = health.filter(~F.col("is_silent")).select("minute")
    before = alerts.withColumn("minute", F.date_trunc("minute", "window_at") - F.expr("INTERVAL 1 MINUTE")).join(live, "minute")
    return before.filter(~in_bounds(F.col("latitude"), F.col("longitude"), bounds)).drop("minute")


def error_grows_with_lead(curve: DataFrame) -> DataFrame:
    """The median error of the longest leads must exceed that of the shortest, and every forward lead must err on the late side."""
    at = lambda b: F.max(F.when(F.col("lead_bucket") == b, F.col("median_abs_error_s")))
    early = F.count_if((F.col("lead_bucket") != "past") & (F.col("mean_error_s") <= 0)).alias("pessimistic")
    return curve.agg(at("0-2m").alias("near"), at("45-60m").alias("far"), early).filter("near is null or far is null or far <= near or pessimistic > 0")


def never_silent(health: DataFrame, first: str, last: str) -> DataFrame:
    """Silent minutes from first to last, local wall clock: thin service is not silence. health has minute_local."""
    return health.filter(F.col("is_silent") & F.col("minute_local").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))


def histogram_is_exact(histogram: DataFrame) -> DataFrame:
    return histogram.filter("fractional_values > 0")


def reconciles(expected: DataFrame, mart: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Keys whose counts differ or that one side lacks."""
    a, b = expected.select(*keys, F.col(column).alias("_a")), mart.select(*keys, F.col(column).alias("_b"))
    return a.join(b, keys, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys, F.col("_a").alias("expected"), F.col("_b").alias("found"))


def loaded(checks: dict[str, DataFrame]) -> DataFrame:
    """Presence checks, so that no other check passes on nothing: name of every table without a row."""
    rows = None
    for name, df in checks.items():
        one = df.limit(1).agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(name).alias("missing"))
        rows = one if rows is None else rows.unionAll(one)
    return rows


def freshness(df: DataFrame, column: str, as_of: Column, warn_min: int, error_min: int, filter_hours: int = 2) -> DataFrame:
    """One row: newest time in seconds, and pass, warn or error; nothing recent is an error."""
    newest = df.filter(F.col(column) >= as_of - F.expr(f"INTERVAL {filter_hours} HOURS")).agg(F.max(column).alias("newest"))
    age = F.unix_seconds(as_of) - F.unix_seconds("newest")
    status = F.when(F.col("newest").isNull() | (age > error_min * 60), "error").when(age > warn_min * 60, "warn").otherwise("pass")
    return newest.select(F.unix_seconds("newest").alias("newest_s"), status.alias("status"))


def dlq_verdict(dlq: DataFrame, chronic: dict[str, int]) -> DataFrame:
    """Reasons with their counts; a chronic reason alerts above its threshold, any other at once."""
    limit = F.coalesce(F.create_map(*[x for k, v in chronic.items() for x in (F.lit(k), F.lit(v))])[F.col("reason")], F.lit(0)) if chronic else F.lit(0)
    return dlq.groupBy("reason").agg(F.count("*").alias("n")).withColumn("alert", F.col("n") > limit)


def load_sanity(loaded_rows: Column, expected: Column) -> Column:
    return F.when((loaded_rows <= expected * 0.1) | (loaded_rows > expected * 2), "warn").otherwise("ok")


def lag_over(lags: DataFrame, limits: DataFrame) -> DataFrame:
    """(grp, lag) and (grp, max_lag) -> groups that are over, dead (no row) or unreadable (null lag)."""
    joined = limits.join(lags, "grp", "left")
    return joined.filter("lag is null or lag > max_lag").select("grp", "lag", "max_lag")
