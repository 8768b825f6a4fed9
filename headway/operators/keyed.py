"""Keyed operators: latest per key, value dedupe, upserts, key and field differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest order for each key, by a partial aggregate: no sort, and a hot key is combined before it moves."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def value_dedupe(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Rows whose values differ, null-safe, from those of the row before with the same key: A, A, B, A keeps A, B, A."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(F.struct(*values)).over(w)
    return df.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.struct(*values))).drop("_before")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last write wins for each key; replaying the same rows changes nothing."""
    old = existing.withColumn("_side", F.lit(0))
    new = incoming.select(*existing.columns).withColumn("_side", F.lit(1))
    return latest_per_key(old.unionByName(new), keys, ["_side", order]).drop("_side")


def diff_keys(live: DataFrame, replay: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct key of either side, null-safe, and which sides have it."""
    a = live.select(*keys).distinct().withColumn("_a", F.lit(True)).alias("a")
    b = replay.select(*keys).distinct().withColumn("_b", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "live").otherwise("replay")
    return a.join(b, same, "full_outer").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], side.alias("side"))


def field_mismatches(live: DataFrame, replay: DataFrame, keys: list[str], ignore: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """field, mismatches over the keys that both sides have.

    The last row of a key by order (by all its fields, if none is given) counts on either side, so repeated keys count once. A
    field that only one side has differs wherever that side has a value.
    """
    fields = [c for c in dict.fromkeys([*live.columns, *replay.columns]) if c not in keys and c not in ignore]
    if not fields:
        return live.sparkSession.createDataFrame([], "field string, mismatches long")

    def last(df: DataFrame) -> DataFrame:
        comparable = [c for c, kind in sorted(df.dtypes) if c not in keys and c not in ignore and "map<" not in kind and "variant" not in kind]
        return latest_per_key(df, keys, order or comparable or keys)

    a, b = last(live).alias("a"), last(replay).alias("b")
    value = lambda side, df, c: F.col(f"{side}.{c}") if c in df.columns else F.lit(None)
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    counts = a.join(b, same).agg(*[F.count_if(~value("a", live, c).eqNullSafe(value("b", replay, c))).alias(c) for c in fields])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("mismatches")) for c in fields])).alias("m")).select("m.*")


def split_by(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that don't): null counts as not passing."""
    flag = F.coalesce(keep, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def duplicates(df: DataFrame, grain: list[str]) -> DataFrame:
    """Grain values with more than one row."""
    return df.groupBy(*grain).agg(F.count("*").alias("rows")).filter("rows > 1")
