"""Readers of the versioned schedule: GTFS CSV members and neighborhood GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns that each member of the schedule keeps, with their types.
TABLES = {
    "routes": "route_id string, route_short_name string, route_long_name string, route_type smallint, route_color string, route_text_color string",
    "trips": "trip_id string, route_id string, service_id string, trip_headsign string, direction_id smallint, block_id string, shape_id string",
    "stops": "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, location_type smallint, parent_station string",
    "stop_times": "trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string, shape_dist_traveled double, timepoint smallint",
    "shapes": "shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double, shape_dist_traveled double",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "feed_info": "feed_version string, feed_start_date string, feed_end_date string",
}


def read_member(spark: SparkSession, path: str, name: str, version_id: int) -> DataFrame:
    """A CSV member by column name: empty text is null, a byte order mark is dropped, columns that are missing are null."""
    raw = spark.read.csv(path, header=True, nullValue="", emptyValue="", encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    kept = []
    for column in TABLES[name].split(", "):
        c, kind = column.split()
        kept.append((F.col(c).cast(kind) if c in raw.columns else F.lit(None).cast(kind)).alias(c))
    return raw.select(F.lit(version_id).cast("bigint").alias("version_id"), *kept)


def feed_info(member: DataFrame) -> DataFrame:
    """The first row, or one of nulls."""
    blank = member.sparkSession.range(1).select(*[F.lit(None).cast(kind).alias(c) for c, kind in member.dtypes])
    return member.limit(1).unionByName(blank).limit(1)


def read_neighborhoods(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """GeoJSON features as neigh_num, neighborhood_name, polygons; a Polygon becomes a multi-polygon of one; the count is checked."""
    features = spark.read.json(path, multiLine=True, schema="features array<struct<properties: struct<neigh_num: int, neighborhood_name: string>, geometry: struct<type: string, coordinates: string>>>")
    rows = features.select(F.explode("features").alias("f")).select("f.properties.*", "f.geometry.*")
    ring = "array<array<array<double>>>"
    multi = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", ring))).otherwise(F.from_json("coordinates", f"array<{ring}>"))
    points = F.transform(multi, lambda p: F.transform(p, lambda r: F.transform(r, lambda c: F.struct(c[0].alias("lon"), c[1].alias("lat")))))
    out = rows.select("neigh_num", "neighborhood_name", points.alias("polygons"))
    if expected is not None and (n := out.count()) != expected:
        raise ValueError(f"{n} neighborhoods, {expected} expected")
    return out
