"""Enriched positions on the wire: framed protobuf, by field number."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.sources.realtime import Malformed, fields, signed, varint

#: Number -> (name, kind, has presence). Fields without presence read as 0 or "" when absent.
FIELDS = {
    1: ("vehicle_id", "string", False), 2: ("position_timestamp", "long", False), 3: ("latitude", "double", False), 4: ("longitude", "double", False), 5: ("trip_id", "string", False),
    6: ("route_id", "string", False), 7: ("direction_id", "int", False), 8: ("start_date", "string", False), 10: ("current_status", "string", False), 11: ("occupancy_status", "string", True),
    12: ("stop_id", "string", True), 13: ("current_stop_sequence", "int", True), 14: ("bearing", "double", True), 15: ("speed", "double", True), 20: ("route_short_name", "string", True),
    21: ("route_long_name", "string", True), 22: ("route_type", "int", True), 23: ("trip_headsign", "string", True), 24: ("block_id", "string", True), 25: ("shape_id", "string", True),
    26: ("service_id", "string", True), 30: ("shape_dist_traveled", "double", True), 31: ("schedule_deviation_seconds", "int", True), 32: ("neighborhood_name", "string", True),
    33: ("neighborhood_num", "int", True), 40: ("static_feed_version", "long", False), 41: ("feed_etag", "string", True), 42: ("enriched_at", "long", False), 43: ("gtfs_feed_version", "string", True),
}
COLUMNS = ", ".join(f"{name} {kind}" for name, kind, _ in FIELDS.values())
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
_ABSENT = {"string": "", "long": 0, "int": 0, "double": 0.0}


def strip_framing(raw: bytes) -> bytes:
    """The message after magic, schema id and the message index array (a count and as many indexes; a single 0 for the first message)."""
    if len(raw) < 6 or raw[0] != 0:
        raise Malformed("not framed")
    count, at = varint(raw, 5)
    for _ in range(count):
        _, at = varint(raw, at)
    return raw[at:]


def decoded(raw: bytes | None) -> dict | None:
    """A record, or None for what can't be read."""
    out = {name: None if present else _ABSENT[kind] for name, kind, present in FIELDS.values()}
    try:
        for number, value in fields(strip_framing(raw or b"")):
            if number not in FIELDS:
                continue
            name, kind, _ = FIELDS[number]
            if kind in ("int", "long") and isinstance(value, int):
                out[name] = signed(value)
            elif kind == "double" and isinstance(value, bytes) and len(value) == 8:
                out[name] = struct.unpack("<d", value)[0]
            elif kind == "string" and isinstance(value, bytes):
                out[name] = value.decode("utf-8")
            else:
                return None
    except (Malformed, UnicodeDecodeError):
        return None
    return out


def _varint_of(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def encoded(record: dict, schema_id: int) -> bytes:
    out = bytearray(b"\x00" + struct.pack(">I", schema_id) + b"\x00")
    for number, (name, kind, present) in FIELDS.items():
        value = record.get(name)
        if value is None or not present and value == _ABSENT[kind]:
            continue
        if kind in ("int", "long"):
            out += _varint_of(number << 3) + _varint_of(value)
        elif kind == "double":
            out += _varint_of(number << 3 | 1) + struct.pack("<d", value)
        else:
            data = value.encode()
            out += _varint_of(number << 3 | 2) + _varint_of(len(data)) + data
    return bytes(out)


def decode_enriched(messages: DataFrame) -> DataFrame:
    """(value) -> records, with decoded false and nulls where a message can't be read."""
    schema = pa.schema([("decoded", pa.bool_()), *((n, _ARROW[k]) for n, k, _ in FIELDS.values())])

    def run(batches):
        for batch in batches:
            rows = [decoded(v) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist([{"decoded": r is not None, **(r or {})} for r in rows], schema=schema)

    return messages.select("value").mapInArrow(run, f"decoded boolean, {COLUMNS}")


def encode_enriched(records: DataFrame, schema_id: int) -> DataFrame:
    """Records with some or all of the fields -> (key, value)."""
    kept = [F.col(n).cast(k).alias(n) for n, k, _ in FIELDS.values() if n in records.columns]

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.record_batch([pa.array([r["vehicle_id"] for r in rows], pa.string()), pa.array([encoded(r, schema_id) for r in rows], pa.binary())], names=["key", "value"])

    return records.select(*kept).mapInArrow(run, "key string, value binary")
