"""Repairs and rates of message streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import wire


def reframed(message: Column, schema_id: Column) -> Column:
    """Messages that are framed already, or bare JSON, framed alike with whole numbers in place of .0; null for junk."""
    body = F.coalesce(wire.unframe(message), message).cast("string")
    readable = F.try_parse_json(body).isNotNull() | wire.framed(message)
    return wire.frame(F.when(readable, F.regexp_replace(body, r"(\d+)\.0+\b", "$1")), schema_id)


def suppression(rows: DataFrame, keys: list[str], order: list[str], value: str, by: list[str]) -> DataFrame:
    """by, seen, suppressed: the share of rows whose value is that of the row before with the same keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    same = F.when(F.row_number().over(w) > 1, F.lag(value).over(w).eqNullSafe(F.col(value))).otherwise(False)
    return rows.withColumn("_same", same).groupBy(*by).agg(F.count("*").alias("seen"), F.round(F.avg(F.col("_same").cast("double")), 6).alias("suppressed"))


def cadence(rows: DataFrame, keys: list[str], at: str, order: list[str]) -> DataFrame:
    """keys, min_s, median_s, max_s of the seconds between neighbours; the median is the upper of two middle values.

    Gaps are counted by value first, so a key holds its different gaps and not its rows.
    """
    w = Window.partitionBy(*keys).orderBy(at, *order)
    gaps = rows.withColumn("_gap", F.col(at) - F.lag(at).over(w)).filter("_gap is not null").groupBy(*keys, "_gap").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    ranked = gaps.withColumn("_upto", F.sum("_n").over(whole.orderBy("_gap"))).withColumn("_half", F.floor(F.sum("_n").over(whole) / 2))
    upper = F.min(F.when(F.col("_upto") > F.col("_half"), F.col("_gap")))
    return ranked.groupBy(*keys).agg(F.min("_gap").alias("min_s"), upper.alias("median_s"), F.max("_gap").alias("max_s"))
