"""Local time, service days and schedule clocks. The session's time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.config import LOCAL_ZONE, Accuracy


def local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def instant(wall: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_utc_timestamp(wall, zone)


def unset_to_null(epoch: Column) -> Column:
    """Epoch 0 is "unset"."""
    return F.when(epoch != 0, F.timestamp_seconds(epoch))


def gtfs_date(text: Column) -> Column:
    """YYYYMMDD or ISO to a date; anything else is null."""
    digits = F.regexp_replace(F.trim(text), "-", "")
    return F.when(digits.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd"))).cast("date")


def service_day(value: Column) -> Column:
    """Any form of date to YYYYMMDD: eight digits once hyphens are gone, else null."""
    digits = F.regexp_replace(F.trim(value), "-", "")
    return F.when(digits.rlike(r"^[0-9]{8}$"), digits)


def epoch_seconds(value: Column) -> Column:
    """ISO text to epoch seconds; a string of digits alone says neither unit nor origin and is null."""
    return F.when(~value.rlike(r"^\s*\d+\s*$"), F.unix_seconds(F.try_to_timestamp(value)))


def clock_seconds(clock: Column) -> Column:
    """H:M:S to seconds; hours may pass 24."""
    parts = F.split(F.trim(clock), ":")
    ok = F.trim(clock).rlike(r"^\d+:\d{1,2}:\d{1,2}$")
    return F.when(ok, parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("int"))


def service_origin(date: Column, zone: str = LOCAL_ZONE, origin: str = "midnight") -> Column:
    """The instant from which a service day's clocks count."""
    if origin == "midnight":
        return instant(date.cast("timestamp"), zone)
    return F.timestamp_seconds(F.unix_seconds(instant(F.timestamp_seconds(F.unix_seconds(date.cast("timestamp")) + 43_200), zone)) - 43_200)


def day_type(date: Column) -> Column:
    day = F.dayofweek(date)
    return F.when(day == 1, "sunday").when(day == 7, "saturday").otherwise("weekday")


def lead_bucket(seconds: Column, config: Accuracy = Accuracy()) -> Column:
    """Lower bounds belong to a bucket; negative leads are past."""
    out = F.when(seconds < config.bounds[0], config.labels[0])
    for bound, label in zip(config.bounds[1:], config.labels[1:]):
        out = out.when(seconds < bound, label)
    return out.otherwise(config.labels[-1])


def covers(date: Column, start: Column, end: Column) -> Column:
    """Three-valued: null where a bound is missing and the other doesn't decide."""
    return (start <= date) & (date <= end)
