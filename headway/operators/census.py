"""Field census: which leaves of nested records are present, how often, with samples; comparison of two shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.text import snake_case


def leaves(schema: T.DataType, prefix: str = "") -> list[str]:
    """Paths of all leaves; a step into the elements of an array is written []."""
    if isinstance(schema, T.ArrayType):
        return leaves(schema.elementType, f"{prefix}[]")
    if not isinstance(schema, T.StructType):
        return [prefix]
    out = []
    for f in schema.fields:
        out += leaves(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    return out


def _values(path: str) -> Column:
    """The values of a path in a row, as an array of text without nulls."""
    values = F.array(F.struct("*"))
    for step in path.split("."):
        name, *into = step.split("[]")
        values = _step(values, name)
        for _ in into:
            values = F.flatten(F.transform(values, lambda v: F.coalesce(v, F.array())))
    return F.array_compact(F.transform(values, lambda v: v.cast("string")))


def _step(values: Column, name: str) -> Column:
    return F.transform(values, lambda v: v.getField(name))


def field_census(df: DataFrame, samples: int = 3) -> DataFrame:
    """path, present, pct, samples: how many rows have a value there, and the least of the different values.

    Each task keeps no more than a few values of a path: a group of a path and a value is one row, and paths are as many as the
    schema has.
    """
    paths, total = leaves(df.schema), df.agg(F.count("*")).scalar()
    parts = [F.struct(F.lit(p).alias("path"), F.array_distinct(_values(p)).alias("values")) for p in paths]
    each = df.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    counts = each.groupBy("path").agg(F.count_if(F.size("values") > 0).alias("present"))
    values = each.select("path", F.explode("values").alias("value")).groupBy("path", "value").agg(F.count("*").alias("_n"))
    least = values.withColumn("k", F.row_number().over(Window.partitionBy("path").orderBy("value"))).filter(F.col("k") <= samples)  # a limit of k for each group
    shown = least.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("samples"))
    out = counts.join(shown, "path", "left")
    return out.select("path", "present", F.round(100.0 * F.col("present") / total, 2).alias("pct"), F.coalesce("samples", F.lit("")).alias("samples"))


def shape_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Paths in snake case, and which of both shapes has them."""
    spark = a.sparkSession
    side = lambda df: spark.createDataFrame([(p,) for p in leaves(df.schema)], "path string").select(snake_case(F.col("path")).alias("path"))
    x, y = side(a), side(b)
    tag = lambda df, t: df.select("path", F.lit(t).alias("side"))
    return tag(x.intersect(y), "both").unionByName(tag(x.subtract(y), "first")).unionByName(tag(y.subtract(x), "second"))
