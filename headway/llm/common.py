"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_top(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local master, where all tasks share one machine, may leave it unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = f"file://{tempfile.gettempdir()}"
    return top.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a copy in the shared folder that the session names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_top(df.sparkSession))
    return df.checkpoint()


#: A key is hot if it has more than one in HOT_KEYS of the rows and more than HOT_ROWS, so there are fewer than HOT_KEYS hot ones.
HOT_KEYS, HOT_ROWS = 10_000, 1000


def hot_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of left and right, which has one row of fixed width for each key and in n how many rows of left have it.

    The fewer than HOT_KEYS hot keys are broadcast, so their rows stay where they are; the rest is a join as Spark plans it.
    Both sides are read twice: they should be written or checkpointed. n is dropped.
    """
    total, most = right.agg(F.sum("n"), F.max("n")).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= limit:
        return left.join(right.drop("n"), key)
    hot = F.col("n") > limit
    some = right.filter(hot).drop("n")
    spread = left.join(F.broadcast(some), key)
    return spread.unionByName(left.join(F.broadcast(some.select(key)), key, "left_anti").join(right.filter(~hot).drop("n"), key))


def shared_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of left and right, which has one row of any width for each key.

    Rows of left that have a hot key are dealt to shares by their hash, and that key's row of right goes to each share, fewer
    than HOT_KEYS copies in all. Of left, only the keys are read twice.
    """
    counts = checkpointed(left.select(key).groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS))
    if not counts.limit(1).count():
        return left.join(right, key)
    limit = max(HOT_ROWS, left.select(key).count() // HOT_KEYS)
    of = F.broadcast(counts.filter(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("_of")))  # fewer than HOT_KEYS rows
    dealt = left.join(of, key, "left").withColumn("_share", F.pmod(F.xxhash64(*left.columns), F.coalesce("_of", F.lit(1))).cast("int")).drop("_of")
    copies = right.join(of, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_of", F.lit(1)) - 1))).drop("_of")
    return dealt.join(copies, [key, "_share"]).drop("_share")


def held_out(doc_id: Column) -> Column:
    """One fifth of the documents, chosen by their id alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(texts, limit: int):
    """Index ranges [i, j) over texts whose summed length stays near limit; at least one text each."""
    i, size = 0, 0
    for j, x in enumerate(texts):
        n = len(x) if x is not None else 0
        if j > i and size + n > limit:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)


class TextSizes:
    """Stands for the texts of a column where only their sizes in bytes matter."""

    def __init__(self, column: pa.Array):
        self.sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))

    def __len__(self):
        return len(self.sizes)

    def __iter__(self):
        return (range(int(n)) for n in self.sizes)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the session names for checkpoints."""
    return f"{shared_top(spark)}/headway-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage with a table in the shared folder: smaller than a checkpoint where rows are many and narrow."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete what written() wrote, when nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
