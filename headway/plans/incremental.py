"""Incremental rebuilds: where to restart, and how to put new rows in. An incremental build equals a full one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import Warehouse
from headway.plans import marts


def health_restart(health: DataFrame, config: Warehouse = Warehouse()):
    """The last minute with positions at least the lookback before the newest one: no silent run crosses it. None: rebuild all."""
    newest = health.agg(F.max("minute").alias("m")).first()[0]
    if newest is None:
        return None
    old = health.filter(~F.col("is_silent") & (F.col("minute") <= F.lit(newest) - F.expr(f"INTERVAL {config.health_lookback_h} HOURS")))
    return old.agg(F.max("minute")).first()[0]


def replace_from(existing: DataFrame, fresh: DataFrame, column: str, restart) -> DataFrame:
    """existing before the restart, fresh from it on."""
    return fresh if restart is None else existing.filter(F.col(column) < F.lit(restart)).unionByName(fresh.filter(F.col(column) >= F.lit(restart)))


def feed_health(existing: DataFrame | None, positions: DataFrame, config: Warehouse = Warehouse()) -> DataFrame:
    restart = health_restart(existing, config) if existing is not None else None
    fresh = marts.feed_health(positions, F.lit(restart) if restart is not None else None)
    return fresh if restart is None else replace_from(existing, fresh, "minute", restart)


def placed_alerts(existing: DataFrame | None, alerts: DataFrame, positions: DataFrame, stops: DataFrame, config: Warehouse = Warehouse()) -> DataFrame:
    """The alert mart: the newest minutes are built anew, and windows of recent days with an alert that found no place.

    window_end is in epoch seconds. A window is rebuilt whole, so no alert of it is lost.
    """
    if existing is None or (newest := existing.agg(F.max("window_end")).first()[0]) is None:
        return marts.placed_alerts(alerts, positions, stops)
    recent = F.col("window_end") >= newest - 60 * config.alert_lookback_min
    again = existing.filter(F.col("latitude").isNull() & (F.col("window_end") >= newest - 86_400 * config.unplaced_days)).select("window_end").distinct()
    due = lambda df: df.filter(recent).unionByName(df.filter(~recent).join(again, "window_end", "left_semi"))
    kept = existing.filter(~recent).join(again, "window_end", "left_anti")
    return kept.unionByName(marts.placed_alerts(due(alerts), positions, stops).select(*existing.columns))


def by_day(existing: DataFrame | None, build, source: DataFrame, day: str, source_day) -> DataFrame:
    """For marts with a day in their grain: the newest day but one and later are built anew."""
    if existing is None or (newest := existing.agg(F.max(day)).first()[0]) is None:
        return build(source)
    restart = existing.sparkSession.sql("select date_sub(cast(:d as date), 1)", args={"d": newest}).first()[0]
    return replace_from(existing, build(source.filter(source_day >= F.lit(restart))), day, restart)
