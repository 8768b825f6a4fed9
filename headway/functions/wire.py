"""Wire formats as binary columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frame(payload: Column, schema_id: Column) -> Column:
    """Magic byte 0, schema id as four big-endian bytes, payload."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")), payload.cast("binary"))


def framed(message: Column) -> Column:
    return F.coalesce((F.octet_length(message) >= 5) & (F.hex(F.substring(message, 1, 1)) == "00"), F.lit(False))


def schema_id(message: Column) -> Column:
    return F.when(framed(message), F.conv(F.hex(F.substring(message, 2, 4)), 16, 10).cast("bigint"))


def unframe(message: Column) -> Column:
    """The payload, null for anything that isn't framed."""
    return F.when(framed(message), F.substr(message, F.lit(6)))


def dlq_envelope(reason: Column, detail: Column, entity_key: Column, payload: Column) -> Column:
    return F.to_json(F.struct(reason.alias("reason"), detail.alias("detail"), entity_key.alias("entity_key"), F.base64(payload.cast("binary")).alias("payload_b64")))
