"""Decoders of the three feeds. Protobuf is read by its public wire format; no generated code or jar is needed."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import Bounds
from headway.functions.geo import in_bounds
from headway.functions.text import empty_to_null, english_text
from headway.functions.time import gtfs_date, unset_to_null

#: Names of enumeration values by number.
STATUS = ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")
OCCUPANCY = ("EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY", "CRUSHED_STANDING_ROOM_ONLY", "FULL", "NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE", "NOT_BOARDABLE")
STOP_RELATIONSHIP = ("SCHEDULED", "SKIPPED", "NO_DATA", "UNSCHEDULED")


class Malformed(ValueError):
    """A payload that isn't protobuf."""


def varint(data: bytes, at: int) -> tuple[int, int]:
    """(value, place after it)"""
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise Malformed("varint")
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value & (1 << 64) - 1, at


def fields(data: bytes):
    """(number, value) of every field: integers, raw 4 or 8 bytes, or length-delimited bytes."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind in (1, 2, 5):
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = varint(data, at)
            if at + size > len(data):
                raise Malformed("length")
            value, at = data[at : at + size], at + size
        else:
            raise Malformed("wire type")
        yield number, value


def message(data: bytes | None) -> dict:
    """The last value of each field; repeated fields need fields()."""
    return dict(fields(data)) if data else {}


def text(value) -> str | None:
    return value.decode("utf-8", "replace") or None if isinstance(value, bytes) else None


def real(value) -> float | None:
    return struct.unpack("<f" if len(value) == 4 else "<d", value)[0] if isinstance(value, bytes) and len(value) in (4, 8) else None


def signed(value: int | None) -> int | None:
    return value - (1 << 64) if isinstance(value, int) and value >= 1 << 63 else value


def name(names: tuple, value: int | None) -> str | None:
    return names[value] if isinstance(value, int) and value < len(names) else None


def positions_of(payload: bytes):
    """One record for each entity with a vehicle; a missing time falls back to the header's."""
    parts = list(fields(payload))
    header = message(next((v for n, v in parts if n == 1), None)).get(3) or None
    for entity in (message(v) for n, v in parts if n == 2):
        if 4 not in entity:
            continue
        vehicle = message(entity[4])
        trip, place, who = (message(vehicle.get(k)) for k in (1, 2, 8))
        yield {
            "vehicle_id": text(who.get(1)), "position_s": vehicle.get(5) or header, "trip_id": text(trip.get(1)), "route_id": text(trip.get(5)), "direction_id": trip.get(6), "start_date": text(trip.get(3)),
            "latitude": real(place.get(1)), "longitude": real(place.get(2)), "bearing": real(place.get(3)), "speed": real(place.get(5)), "current_status": name(STATUS, vehicle.get(4)) or "IN_TRANSIT_TO",
            "current_stop_sequence": vehicle.get(3), "stop_id": text(vehicle.get(7)), "occupancy_status": name(OCCUPANCY, vehicle.get(9)),
        }


def trip_updates_of(payload: bytes):
    """One record for each stop prediction."""
    for entity in (message(v) for n, v in fields(payload) if n == 2):
        if 3 not in entity:
            continue
        update = list(fields(entity[3]))
        head = dict(update)
        trip, who = message(head.get(1)), message(head.get(3))
        for stop in (message(v) for n, v in update if n == 2):
            arrival, departure = message(stop.get(2)), message(stop.get(3))
            yield {
                "trip_id": text(trip.get(1)), "stop_id": text(stop.get(4)), "stop_sequence": stop.get(1), "route_id": text(trip.get(5)), "direction_id": trip.get(6), "start_date": text(trip.get(3)), "vehicle_id": text(who.get(1)),
                "trip_s": head.get(4) or None, "arrival_s": signed(arrival.get(2)) or None, "arrival_delay": signed(arrival.get(1)), "departure_s": signed(departure.get(2)) or None, "departure_delay": signed(departure.get(1)),
                "schedule_relationship": name(STOP_RELATIONSHIP, stop.get(5)),
            }


POSITION_COLUMNS = "vehicle_id string, position_s long, trip_id string, route_id string, direction_id int, start_date string, latitude double, longitude double, bearing double, speed double, current_status string, current_stop_sequence int, stop_id string, occupancy_status string"
UPDATE_COLUMNS = "trip_id string, stop_id string, stop_sequence int, route_id string, direction_id int, start_date string, vehicle_id string, trip_s long, arrival_s long, arrival_delay int, departure_s long, departure_delay int, schedule_relationship string"


def _decoded(payloads: DataFrame, parse, columns: str, unfit, carry: tuple[str, ...]) -> DataFrame:
    """feed_etag, carried columns, error, rejected and records of all payloads.

    A malformed payload is one row with an error and no record. rejected is the payload of rows with an error, and of records
    that unfit says can't be published, so that dead letters need no second look at the payloads.
    """
    names, kinds = zip(*(c.split() for c in columns.split(", ")))
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    extra = [f for f in payloads.schema.fields if f.name in carry]

    def run(batches):
        for batch in batches:
            take, errors, rejected, data = [], [], [], [[] for _ in names]

            def flush():
                kept = [batch.column(c).take(pa.array(take, pa.int64())) for c in range(1 + len(extra))]
                made = [*kept, pa.array(errors, pa.string()), pa.array(rejected, pa.binary()), *(pa.array(d, types[k]) for d, k in zip(data, kinds))]
                out = pa.record_batch(made, names=["feed_etag", *[f.name for f in extra], "error", "rejected", *names])
                for c in (take, errors, rejected, *data):
                    c.clear()
                return out

            for i, content in enumerate(batch.column(1 + len(extra)).to_pylist()):
                try:
                    records, error = list(parse(content or b"")), None
                except Malformed as e:
                    records, error = [{}], str(e)
                for r in records:
                    take.append(i)
                    errors.append(error)
                    rejected.append(content if error or unfit(r) else None)
                    for d, n in zip(data, names):
                        d.append(r.get(n))
                if len(take) >= 4096:
                    yield flush()
            yield flush()

    fixed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return payloads.select("feed_etag", *[f.name for f in extra], "content").mapInArrow(run, f"feed_etag string, {fixed}error string, rejected binary, {columns}")


def decode_positions(payloads: DataFrame, carry: tuple[str, ...] = (), bounds: Bounds = Bounds()) -> DataFrame:
    """Positions with reason: null, malformed_payload, missing_required_field or position_out_of_bounds; nothing is dropped.

    rejected is the payload where there is a reason; carry names further columns of the payloads to keep.
    """
    def unfit(r: dict) -> bool:
        lat, lon = r["latitude"], r["longitude"]
        return r["vehicle_id"] is None or r["position_s"] is None or lat is None or lon is None or not (bounds.min_lat <= lat <= bounds.max_lat and bounds.min_lon <= lon <= bounds.max_lon)

    rows = _decoded(payloads, positions_of, POSITION_COLUMNS, unfit, carry)
    missing = F.col("vehicle_id").isNull() | F.col("position_s").isNull()
    reason = F.when(F.col("error").isNotNull(), "malformed_payload").when(missing, "missing_required_field").when(~in_bounds(F.col("latitude"), F.col("longitude"), bounds), "position_out_of_bounds")
    return rows.withColumn("reason", reason).withColumn("position_timestamp", F.timestamp_seconds("position_s")).withColumn("start_date", gtfs_date(F.col("start_date"))).drop("position_s", "error")


def decode_trip_updates(payloads: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    rows = _decoded(payloads, trip_updates_of, UPDATE_COLUMNS, lambda r: r["trip_id"] is None or r["stop_id"] is None, carry)
    stamps = {f"{c}_time" if c != "trip" else "trip_timestamp": F.timestamp_seconds(f"{c}_s") for c in ("trip", "arrival", "departure")}
    reason = F.when(F.col("error").isNotNull(), "malformed_payload").when(F.col("trip_id").isNull() | F.col("stop_id").isNull(), "missing_required_field")
    return rows.withColumns(stamps).withColumn("start_date", gtfs_date(F.col("start_date"))).withColumn("reason", reason).drop("trip_s", "arrival_s", "departure_s", "error")


ALERTS = """struct<entity: array<struct<id: string, alert: struct<cause: string, effect: string, severity_level: string, header_text: struct<translation: array<struct<text: string, language: string>>>,
description_text: struct<translation: array<struct<text: string, language: string>>>, url: struct<translation: array<struct<text: string, language: string>>>,
active_period: array<struct<start: bigint, end: bigint>>, informed_entity: array<map<string, string>>, last_modified_timestamp: bigint>>>>"""


def decode_alerts(payloads: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(feed_etag, content as JSON text): one row for each alert with an id, its first active period; malformed JSON is one row with a reason."""
    parsed = payloads.select("feed_etag", *carry, F.col("content").cast("binary").alias("_raw"), F.from_json(F.col("content").cast("string"), ALERTS.replace("\n", " ")).alias("p"), F.expr("try_parse_json(cast(content as string)) is null").alias("bad"))
    rows = parsed.select("feed_etag", *carry, "bad", F.when(F.col("bad"), F.col("_raw")).alias("rejected"), F.explode_outer("p.entity").alias("e")).filter("bad or (e.id is not null and e.id <> '' and e.alert is not null)")
    a, period = F.col("e.alert"), F.get(F.col("e.alert.active_period"), F.lit(0))
    return rows.select(
        "feed_etag", *carry, "rejected", F.when(F.col("bad"), "malformed_payload").alias("reason"), F.col("e.id").alias("alert_id"), a["cause"].alias("cause"), a["effect"].alias("effect"), a["severity_level"].alias("severity_level"),
        *[empty_to_null(english_text(a[c]["translation"])).alias(c) for c in ("header_text", "description_text", "url")],
        unset_to_null(period["start"]).alias("active_period_start"), unset_to_null(period["end"]).alias("active_period_end"), a["informed_entity"].alias("informed_entities"), unset_to_null(a["last_modified_timestamp"]).alias("last_modified"),
    )


DECODERS = {"vehicle_positions": decode_positions, "trip_updates": decode_trip_updates, "service_alerts": decode_alerts}


def decode(feed: str, payloads: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return DECODERS[feed](payloads, carry)
