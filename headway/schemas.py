"""Declared schemas, conformance to them, and how a change of schema is to be judged."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "binary": T.BinaryType()}


def _declared(columns: str) -> T.StructType:
    """name type, ... without a session."""
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in (c.split() for c in columns.split(", "))])


ENRICHED = _declared(
    "vehicle_id string, position_timestamp timestamp, latitude double, longitude double, trip_id string, route_id string, direction_id int, start_date string, current_status string, occupancy_status string, stop_id string, "
    "current_stop_sequence int, bearing double, speed double, route_short_name string, route_long_name string, route_type int, trip_headsign string, block_id string, shape_id string, service_id string, static_feed_version bigint, "
    "feed_etag string, enriched_at timestamp, gtfs_feed_version string, shape_dist_traveled double, schedule_deviation_seconds int, neighborhood_name string, neighborhood_num int"
)
ALERT = _declared("route_id string, direction_id int, route_short_name string, vehicle_id_a string, vehicle_id_b string, trip_id_a string, trip_id_b string, gap_ft double, window_end bigint, deviation_a int, deviation_b int")
ACCURACY = _declared("lead_time_s double, error_s double, abs_error_s double, lead_bucket string, trip_id string, stop_id string, route_id string, route_short_name string, start_date string, issued_at bigint, predicted_arrival bigint, observed_at bigint")
DLQ = _declared("source_topic string, reason string, detail string, entity_key string, payload binary, occurred_at timestamp")
#: Reasons of the dead letter queue.
REASONS = ("malformed_payload", "missing_required_field", "position_out_of_bounds", "unknown_trip_id", "implausible_timestamp", "implausible_deviation")


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order, cast; a column that is missing or not declared fails."""
    have, want = set(df.columns), set(schema.fieldNames())
    if have != want:
        raise SchemaMismatch(f"missing {sorted(want - have)}, not declared {sorted(have - want)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class Severity(Enum):
    WIRE_INCOMPATIBLE = 3
    SEMANTIC_HAZARD = 2
    BENIGN = 1


#: Types of one wire class can be read for each other.
WIRE_CLASS = {"int32": "varint", "int64": "varint", "uint32": "varint", "uint64": "varint", "bool": "varint", "enum": "varint", "sint32": "zigzag", "sint64": "zigzag", "string": "bytes", "bytes": "bytes", "message": "bytes", "double": "fixed64", "fixed64": "fixed64", "float": "fixed32", "fixed32": "fixed32"}


def schema_diff(old: dict[int, tuple[str, str, bool]], new: dict[int, tuple[str, str, bool]]) -> list[tuple[Severity, int, str]]:
    """Changes between {number: (name, type, optional)}, worst first."""
    out = []
    for number in sorted(old.keys() | new.keys()):
        a, b = old.get(number), new.get(number)
        if a is None:
            moved = next((n for n, f in old.items() if f[0] == b[0] and n != number), None)
            if moved is not None:
                out.append((Severity.WIRE_INCOMPATIBLE, number, f"{b[0]} moved from number {moved}"))
            elif b[2]:
                out.append((Severity.BENIGN, number, f"{b[0]} added"))
            else:
                out.append((Severity.SEMANTIC_HAZARD, number, f"{b[0]} added without presence: absent reads as a default"))
        elif b is None:
            out.append((Severity.SEMANTIC_HAZARD, number, f"{a[0]} removed"))
        else:
            if WIRE_CLASS.get(a[1], a[1]) != WIRE_CLASS.get(b[1], b[1]):
                out.append((Severity.WIRE_INCOMPATIBLE, number, f"{a[0]} from {a[1]} to {b[1]}"))
            elif a[1] != b[1]:
                out.append((Severity.SEMANTIC_HAZARD, number, f"{a[0]} from {a[1]} to {b[1]}"))
            if a[0] != b[0]:
                out.append((Severity.SEMANTIC_HAZARD, number, f"{a[0]} renamed {b[0]}: the number now means something else"))
            if a[2] and not b[2]:
                out.append((Severity.SEMANTIC_HAZARD, number, f"{b[0]} lost presence: null becomes a default"))
            elif b[2] and not a[2]:
                out.append((Severity.BENIGN, number, f"{b[0]} gained presence"))
    return sorted(out, key=lambda x: (-x[0].value, x[1]))
