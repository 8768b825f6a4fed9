"""Closed windows of local days for published reports."""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import LOCAL_ZONE
from headway.functions.time import day_type

_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86_400}


def parse_duration(text: str) -> int:
    """Seconds of 30s, 5m, 24h or 7d."""
    if not (m := re.fullmatch(r"(\d+)([smhd])", text.strip())):
        raise ValueError(f"not a duration: {text!r}")
    return int(m[1]) * _UNITS[m[2]]


def closed_last(now: dt.datetime, zone: str = LOCAL_ZONE) -> dt.date:
    """The last local day that is over: yesterday."""
    return now.astimezone(ZoneInfo(zone)).date() - dt.timedelta(days=1)


def closed_window(first: dt.date, last: dt.date | None, now: dt.datetime, zone: str = LOCAL_ZONE) -> tuple[dt.date, dt.date]:
    """(first, last) with last held back to the last closed day; nothing closed is an error."""
    end = min(last or closed_last(now, zone), closed_last(now, zone))
    if end < first:
        raise ValueError(f"no day from {first} on has closed")
    return first, end


def window_days(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("local_date"))


def days_by_type(days: DataFrame) -> DataFrame:
    """day_type, days: a row for each kind of day, zero where the window has none."""
    kinds = days.sparkSession.createDataFrame([("weekday",), ("saturday",), ("sunday",)], "day_type string")
    counted = days.groupBy(day_type(F.col("local_date")).alias("day_type")).agg(F.count("*").alias("days"))
    return kinds.join(counted, "day_type", "left").select("day_type", F.coalesce("days", F.lit(0)).alias("days"))
