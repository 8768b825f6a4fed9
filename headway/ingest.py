"""From archived payloads to published records: decode, quarantine, dedupe, publish; and enrichment of what was published."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import Enrichment
from headway.operators.enrich import current_version, enrich
from headway.operators.keyed import value_dedupe
from headway.sources import archive, realtime
from headway.sources.sinks import dead_letters


@dataclass(frozen=True)
class Feed:
    """How a feed's records are known, and what makes one new. Fixed values."""

    name: str
    keys: tuple
    values: tuple
    order: tuple


FEEDS = {
    "vehicle_positions": Feed("vehicle_positions", ("vehicle_id",), ("position_timestamp",), ("fetched_s", "position_timestamp")),
    "trip_updates": Feed("trip_updates", ("trip_id", "stop_id", "stop_sequence"), ("arrival_time", "departure_time"), ("fetched_s", "trip_timestamp")),
    "service_alerts": Feed("service_alerts", ("alert_id",), ("last_modified",), ("fetched_s",)),
}


def process(spark: SparkSession, root: str, feed: str, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """(new records, dead letters) of the payloads fetched in [start, end).

    The cache of last values starts cold, so the first value of each key in the window is new.
    """
    return published(feed, archive.scan(spark, root, feed, start, end))


def published(feed: str, payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new records, dead letters) of payloads (feed_etag, fetched_s, content)."""
    spec = FEEDS[feed]
    decoded = realtime.decode(feed, payloads, ("fetched_s",))
    letters = dead_letters(decoded.filter("reason is not null"), F.col("reason"), F.lit(None).cast("string"), F.col(spec.keys[0]), F.col("rejected"))
    good = decoded.filter("reason is null").drop("reason", "rejected")
    return value_dedupe(good, list(spec.keys), list(spec.order), list(spec.values)).drop("fetched_s"), letters


def enrich_current(positions: DataFrame, static: dict[str, DataFrame], neighborhoods: DataFrame, enriched_at, version: int = 2, config: Enrichment = Enrichment()) -> tuple[DataFrame, DataFrame]:
    """Against the newest ready version, pinned once: (enriched, dead letters). Version 1 has no distance, deviation or neighborhood."""
    pinned = current_version(static["feed_version"])
    if pinned is None:
        raise ValueError("no version of the schedule is ready")
    of = lambda name: static[name].filter(F.col("version_id") == pinned).drop("version_id")
    done, unknown = enrich(positions, of("trips"), of("routes"), of("stop_times"), of("shapes"), neighborhoods, config)
    done = done.withColumns({"static_feed_version": F.lit(pinned).cast("bigint"), "enriched_at": enriched_at})
    if version == 1:
        done = done.drop("shape_dist_traveled", "schedule_deviation_seconds", "neighborhood_name", "neighborhood_num")
    letters = dead_letters(unknown, F.lit("unknown_trip_id"), F.col("trip_id"), F.col("vehicle_id"), F.to_json(F.struct("*")))
    return done, letters
