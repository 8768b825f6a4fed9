"""Rounding as a warehouse does it: floats half to even, decimals half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_to_int(c: Column) -> Column:
    """Half to even; a plain cast would truncate."""
    return F.rint(c).cast("int")


def numeric(c: Column, scale: int) -> Column:
    """Half away from zero, after a cast to decimal."""
    return F.round(c.cast("decimal(38,12)"), scale)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, (100 * part / whole).cast("decimal(5,2)"))
