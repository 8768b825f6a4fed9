"""Text helpers of the decoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def english_text(translations: Column) -> Column:
    """The first translation whose primary subtag is en (its text may be null), else the first of all, else null."""
    english = F.filter(translations, lambda t: F.lower(F.split(F.coalesce(t["language"], F.lit("")), "-")[0]) == "en")
    return F.when(F.size(english) > 0, F.get(english, F.lit(0))["text"]).otherwise(F.get(translations, F.lit(0))["text"])


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.array_sort(F.array(a, b)))


def snake_case(path: Column) -> Column:
    return F.lower(F.regexp_replace(path, r"(?<=[a-z0-9])([A-Z])", r"_$1"))
