"""Enrichment of positions against one pinned version of the schedule, shapes and neighborhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.config import Enrichment
from headway.functions.geo import grid_cell, polygon_covers, project_on_line
from headway.functions.time import clock_seconds, gtfs_date, service_origin

#: Reference sides up to this size go to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 256 << 20


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast side if a check of its size allows it: of its whole rows, arrays included, as text."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()[0]
    return F.broadcast(df) if (size or 0) <= limit else df


def current_version(versions: DataFrame) -> int | None:
    """The newest version that is ready and not retired."""
    row = versions.filter("ready and retired_at is null").agg(F.max_by("version_id", F.struct("loaded_at", "version_id"))).first()
    return row[0]


def schedules(stop_times: DataFrame) -> DataFrame:
    """trip_id -> points sorted by stop sequence: (dist, seconds), those with both."""
    point = F.struct("stop_sequence", F.col("shape_dist_traveled").alias("dist"), clock_seconds(F.col("arrival_time")).alias("seconds"))
    usable = stop_times.select("trip_id", point.alias("p")).filter("p.dist is not null and p.seconds is not null")
    return usable.groupBy("trip_id").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: F.struct(p["dist"].alias("dist"), p["seconds"].alias("seconds"))).alias("points"))


def shape_lines(shapes: DataFrame) -> DataFrame:
    """shape_id -> line (lon, lat), number of points, greatest distance."""
    point = F.struct("shape_pt_sequence", F.col("shape_pt_lon").alias("lon"), F.col("shape_pt_lat").alias("lat"))
    line = F.transform(F.array_sort(F.collect_list(point)), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    return shapes.groupBy("shape_id").agg(line.alias("line"), F.count("*").alias("n_points"), F.max("shape_dist_traveled").alias("max_dist"))


def interpolate(points: Column, x: Column) -> Column:
    """Seconds at distance x: linear between neighbours, the first of equal distances; null outside or under two points."""
    i = F.size(F.filter(points, lambda p: p["dist"] < x))
    a, b = F.get(points, i - 1), F.get(points, i)
    between = a["seconds"] + (b["seconds"] - a["seconds"]) * (x - a["dist"]) / (b["dist"] - a["dist"])
    inside = (F.size(points) >= 2) & (x >= F.get(points, F.lit(0))["dist"]) & (x <= F.get(points, F.size(points) - 1)["dist"])
    return F.when(inside, F.when(i == 0, F.get(points, F.lit(0))["seconds"].cast("double")).otherwise(between))


def deviation(observed: Column, start_date: Column, offset: Column, config: Enrichment = Enrichment()) -> Column:
    """Whole seconds behind schedule, cut towards zero."""
    origin = service_origin(gtfs_date(start_date), config.zone, config.origin)
    return (F.unix_micros(observed) / 1_000_000 - F.unix_seconds(origin) - offset).cast("int")


def enrich(positions: DataFrame, trips: DataFrame, routes: DataFrame, stop_times: DataFrame, shapes: DataFrame, neighborhoods: DataFrame, config: Enrichment = Enrichment()) -> tuple[DataFrame, DataFrame]:
    """(enriched rows, rows of unknown trips). Reference tables are of one version already."""
    names = trips.join(routes, "route_id").select("trip_id", "route_short_name", "route_long_name", "route_type", "trip_headsign", "block_id", "shape_id", "service_id", F.lit(True).alias("_hit"))
    raw = positions.drop("block_id")
    joined = raw.join(small(names), "trip_id", "left")
    unknown = joined.filter("_hit is null").select(*raw.columns)
    known = joined.filter("_hit").drop("_hit")
    placed = known.join(small(shape_lines(shapes).select("shape_id", "line", "max_dist")), "shape_id", "left")
    along = project_on_line(F.col("longitude"), F.col("latitude"), F.col("line")) * F.col("max_dist")
    placed = placed.withColumn("shape_dist_traveled", along).drop("line", "max_dist")
    timed = placed.join(small(schedules(stop_times)), "trip_id", "left")
    late = deviation(F.col("position_timestamp"), F.col("start_date"), interpolate(F.col("points"), F.col("shape_dist_traveled")), config)
    timed = timed.withColumn("_late", late).withColumn("schedule_deviation_seconds", F.when(F.abs("_late") <= config.max_deviation_s, F.col("_late"))).drop("_late", "points")
    return with_neighborhood(timed, neighborhoods), unknown


def with_neighborhood(points: DataFrame, neighborhoods: DataFrame, size: float = 0.01) -> DataFrame:
    """neighborhood_num and _name of the polygon that covers each point, the least number of several.

    Polygons are dealt into the grid cells of their bounding boxes, so points meet only those of their own cell; different
    points of one cell are looked up once.
    """
    corners = F.flatten(F.transform("polygons", lambda p: p[0]))
    box = neighborhoods.select("*", F.transform(corners, lambda c: c["lon"]).alias("_x"), F.transform(corners, lambda c: c["lat"]).alias("_y"))
    span = lambda c: F.sequence(F.floor(F.array_min(c) / size), F.floor(F.array_max(c) / size))
    celled = box.select("neigh_num", "neighborhood_name", "polygons", F.explode(span("_x")).alias("x"), "_y").select("neigh_num", "neighborhood_name", "polygons", "x", F.explode(span("_y")).alias("y"))
    asked = points.select(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).filter("lon is not null and lat is not null").distinct()
    asked = asked.withColumn("_c", grid_cell(F.col("lon"), F.col("lat"), size)).select("lon", "lat", F.col("_c.x").alias("x"), F.col("_c.y").alias("y"))
    hits = asked.join(small(celled), ["x", "y"]).filter(polygon_covers(F.col("lon"), F.col("lat"), F.col("polygons")))
    best = hits.groupBy("lon", "lat").agg(F.min("neigh_num").alias("neighborhood_num"), F.min_by("neighborhood_name", "neigh_num").alias("neighborhood_name"))
    same = (F.col("longitude") == best["lon"]) & (F.col("latitude") == best["lat"])
    return points.join(best, same, "left").drop("lon", "lat")
