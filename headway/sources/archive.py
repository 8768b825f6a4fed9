"""The raw archive: immutable payloads under raw/<feed>/YYYY/MM/DD/HH/<epoch>-<etag>.<ext>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources import store

KEY = r"raw/([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})/(\d+)-([^/]+)\.([A-Za-z0-9]+)$"


def parse_key(path: Column) -> Column:
    """(feed, hour, epoch, etag, ext); null for a path that isn't a key, or whose folder is another hour than its epoch's."""
    part = lambda i: F.regexp_extract(path, KEY, i)
    epoch = F.expr("1").cast("long") * part(6).try_cast("long")
    hour = F.concat_ws("/", *[part(i) for i in range(2, 6)])
    agrees = F.date_format(F.timestamp_seconds(epoch), "yyyy/MM/dd/HH") == hour
    return F.when(path.rlike(KEY) & agrees, F.struct(part(1).alias("feed"), hour.alias("hour"), epoch.alias("epoch"), part(7).alias("etag"), part(8).alias("ext")))


def scan(spark: SparkSession, root: str, feed: str, start: int, end: int) -> DataFrame:
    """fetched_s, feed_etag (quoted), content of payloads fetched in [start, end), oldest first; a key that can't be read is an error.

    Only the folders of the hours in question are listed.
    """
    hours = range(start // 3600, -(-end // 3600))
    import datetime

    folders = [f"{root}/raw/{feed}/{datetime.datetime.fromtimestamp(h * 3600, datetime.timezone.utc):%Y/%m/%d/%H}" for h in hours]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = [f for f in folders if path(f).getFileSystem(conf).exists(path(f))]
    if not there:
        return spark.createDataFrame([], "fetched_s long, feed_etag string, content binary")
    files = spark.read.format("binaryFile").load(there).select("path", "content", parse_key(F.col("path")).alias("key"))
    key = F.when(F.col("key").isNull(), F.raise_error(F.concat(F.lit("not an archive key: "), F.col("path")))).otherwise(F.col("key"))
    rows = files.select(key.alias("key"), "content").filter((F.col("key.epoch") >= start) & (F.col("key.epoch") < end))
    return rows.select(F.col("key.epoch").alias("fetched_s"), F.concat(F.lit('"'), F.col("key.etag"), F.lit('"')).alias("feed_etag"), "content").orderBy("fetched_s")


def put(spark: SparkSession, root: str, feed: str, epoch: int, etag: str | None, ext: str, content: bytes) -> str:
    """Archive a payload before anything decodes it; the same fetch again leaves what is there. Its path."""
    tag = (etag or "no-etag").removeprefix("W/").strip('"')
    path = f"{root}/{object_name(feed, epoch, tag, ext)}"
    store.put(spark, path, content, overwrite=False)
    return path


def object_name(feed: str, epoch: int, etag: str, ext: str) -> str:
    import datetime

    return f"raw/{feed}/{datetime.datetime.fromtimestamp(epoch, datetime.timezone.utc):%Y/%m/%d/%H}/{epoch}-{etag.strip(chr(34))}.{ext}"
