"""Sinks: partitioned upserts, day partitions, dead letters, versioned reference data, exports."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.wire import dlq_envelope
from headway.operators.keyed import upsert
from headway.sources.store import delete, exists, get, names, put


def serialize(df: DataFrame, key: str) -> DataFrame:
    """key, value: compact JSON with ISO dates; a null key fails."""
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit("a record without a key"))).otherwise(F.col(key).cast("string"))
    return df.select(checked.alias("key"), F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}).alias("value"))


def dead_letters(df: DataFrame, reason: Column, detail: Column, key: Column, payload: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), dlq_envelope(reason, detail, key.cast("string"), payload).alias("value"))


def merge_partitions(incoming: DataFrame, path: str, keys: list[str], order: str, day: str = "event_date") -> None:
    """Last write wins for each key, only in the day partitions that incoming touches; replays change nothing.

    The new partitions are staged beside the table before they replace the old ones, as the old ones are read to build them.
    """
    spark = incoming.sparkSession
    days = [r[0] for r in incoming.select(day).distinct().collect()]  # days of one batch
    if not days:
        return
    merged = incoming
    if exists(spark, path):
        old = spark.read.parquet(path).select(*incoming.columns).filter(F.col(day).isin(days))
        merged = upsert(old, incoming, keys, order)
    staged = f"{path}.staged"
    merged.write.mode("overwrite").partitionBy(day).parquet(staged)
    again = spark.read.schema(incoming.schema).parquet(staged)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def planned_partitions(spark: SparkSession, as_of: str, back: int = 7, ahead: int = 1) -> DataFrame:
    """The day partitions that should exist on a date."""
    day = F.lit(as_of).cast("date")
    return spark.range(1).select(F.explode(F.sequence(F.date_sub(day, back), F.date_add(day, ahead), F.expr("INTERVAL 1 DAY"))).alias("day")).select(F.date_format("day", "'p_'yyyyMMdd").alias("partition"))


def partitions_to_drop(names: list[str], cutoff: str) -> list[str]:
    """Day partitions (name_YYYYMMDD) strictly before the cutoff (YYYYMMDD); a default partition never."""
    return sorted(n for n in names if (m := re.search(r"_(\d{8})$", n)) and m[1] < cutoff)


def drop_partitions(spark: SparkSession, path: str, cutoff: str, day: str = "event_date") -> list[str]:
    """Delete the day folders (day=YYYY-MM-DD) of a table strictly before the cutoff; their days. Other folders stay."""
    old = [n for n in names(spark, path) if re.fullmatch(rf"{re.escape(day)}=\d{{4}}-\d{{2}}-\d{{2}}", n) and n.partition("=")[2] < cutoff]
    for n in old:
        delete(spark, f"{path}/{n}")
    return [n.partition("=")[2] for n in old]


def write_clustered(df: DataFrame, path: str, day: str, time: str) -> None:
    """Append by day, sorted by time within files, so that a reader's time filter skips row groups by their least and greatest."""
    df.repartition(day).sortWithinPartitions(day, time).write.mode("append").partitionBy(day).parquet(path)


def upsert_alerts(incoming: DataFrame, path: str) -> None:
    """Alerts by pair and window; the newest gap wins, so a replay changes nothing."""
    dated = incoming.withColumn("event_date", F.to_date(F.timestamp_seconds("window_end")))
    merge_partitions(dated, path, ["vehicle_id_a", "vehicle_id_b", "window_end", "event_date"], "gap_ft")


def upsert_accuracy(incoming: DataFrame, path: str) -> None:
    """Joined predictions by service day, trip, stop and time of issue."""
    dated = incoming.withColumn("event_date", F.to_date(F.timestamp_seconds("observed_at")))
    merge_partitions(dated, path, ["service_day", "trip_id", "stop_id", "issued_at", "event_date"], "predicted_arrival")


def publish_version(tables: dict[str, DataFrame], path: str, version_id: int, info: dict) -> None:
    """Write a version of reference data; its manifest comes last, so a version is ready only when whole."""
    spark = next(iter(tables.values())).sparkSession
    counts = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/version_id={version_id}")
        counts[name] = spark.read.parquet(f"{path}/{name}/version_id={version_id}").count()
    row = json.dumps({"version_id": version_id, "ready": True, "retired_at": None, "row_counts": counts, **info}, sort_keys=True)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest/version_id={version_id}")


def export_json(df: DataFrame, window: dict) -> str:
    """A small result with its window, keys sorted: cutting it again gives the same bytes."""
    rows = [r.asDict(recursive=True) for r in df.collect()]  # published results are a few rows
    return json.dumps({"rows": rows, "window": window}, sort_keys=True, default=str, separators=(",", ":"))


def export_geojson(points: DataFrame, window: dict, lon: str = "longitude", lat: str = "latitude") -> str:
    rows = [r.asDict(recursive=True) for r in points.collect()]
    features = [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [r.pop(lon), r.pop(lat)]}, "properties": r} for r in rows]
    return json.dumps({"type": "FeatureCollection", "features": features, "window": window}, sort_keys=True, default=str, separators=(",", ":"))


def fixture_csv(df: DataFrame, path: str, keys: list[str]) -> None:
    """A small ordered slice as one gzipped CSV file, and a manifest of its columns and rows."""
    df.orderBy(*keys).coalesce(1).write.mode("overwrite").csv(path, header=True, compression="gzip")
    put(df.sparkSession, f"{path}.manifest.json", json.dumps({"columns": df.dtypes, "rows": df.count()}, sort_keys=True).encode())


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A slice that fixture_csv wrote, with its types; another number of rows than its manifest says is an error."""
    said = json.loads(get(spark, f"{path}.manifest.json"))
    rows = spark.read.csv(path, header=True)
    out = rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in said["columns"]])
    if (n := out.count()) != said["rows"]:
        raise ValueError(f"{path} has {n} rows, {said['rows']} expected")
    return out
