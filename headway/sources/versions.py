"""Versions of the schedule: one for each etag, loaded from a zip, ready only when whole, retired by name."""

from __future__ import annotations

import datetime as dt
import io
import json
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources import static, store
from headway.sources.sinks import publish_version

MANIFEST = "version_id long, feed_etag string, feed_version string, feed_start_date string, feed_end_date string, loaded_at string, ready boolean, retired_at string, row_counts map<string, bigint>"
#: Members that a schedule must have; others may be missing.
NEEDED = ("routes", "trips", "stops", "stop_times", "shapes")
ZIP_BYTES = 1 << 30


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each version, whether ready or not."""
    if not store.exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def version_for(spark: SparkSession, path: str, etag: str) -> tuple[int, bool]:
    """(version of an etag, whether it is ready): the one it has, else the next number."""
    rows = manifest(spark, path).select("version_id", "feed_etag", "ready").collect()  # a few rows a year
    for r in rows:
        if r["feed_etag"] == etag:
            return r["version_id"], bool(r["ready"])
    return max((r["version_id"] for r in rows), default=0) + 1, False


def members(content: bytes) -> dict[str, bytes]:
    """The members of a schedule's zip by the name of their table; a member that is needed and missing is an error."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        found = {n.rsplit("/", 1)[-1].removesuffix(".txt"): z.read(n) for n in z.namelist() if n.endswith(".txt")}
    if lost := [n for n in NEEDED if n not in found]:
        raise ValueError(f"the schedule lacks {', '.join(lost)}")
    return {n: found[n] for n in static.TABLES if n in found}


def load(spark: SparkSession, zip_path: str, path: str, etag: str, force: bool = False, now: dt.datetime | None = None) -> int | None:
    """Load a zip as the version of its etag; None where that is ready already. A schedule of some tens of MB passes the driver."""
    version, ready = version_for(spark, path, etag)
    if ready and not force:
        return None
    size = spark.read.format("binaryFile").load(zip_path).select("length").first()[0]
    if size > ZIP_BYTES:
        raise ValueError(f"{zip_path} has {size} bytes, {ZIP_BYTES} at most")
    for name, content in members(store.get(spark, zip_path)).items():
        store.put(spark, f"{path}/members/version_id={version}/{name}.txt", content)
    there = {n.removesuffix(".txt") for n in store.names(spark, f"{path}/members/version_id={version}")}
    tables = {n: static.read_member(spark, f"{path}/members/version_id={version}/{n}.txt", n, version) for n in static.TABLES if n in there}
    info = static.feed_info(tables["feed_info"]).first().asDict() if "feed_info" in tables else {}
    label = {c: info.get(c) for c in ("feed_version", "feed_start_date", "feed_end_date")}
    stamp = (now or dt.datetime.now(dt.timezone.utc)).isoformat(timespec="seconds")
    publish_version(tables, path, version, {"feed_etag": etag, "loaded_at": stamp, **label})
    return version


def retire(spark: SparkSession, path: str, version: int, now: dt.datetime | None = None) -> bool:
    """Mark a version retired; False where there is none or it is retired already."""
    row = manifest(spark, path).filter((F.col("version_id") == version) & F.col("retired_at").isNull()).first()
    if row is None:
        return False
    stamp = (now or dt.datetime.now(dt.timezone.utc)).isoformat(timespec="seconds")
    text = json.dumps(row.asDict(recursive=True) | {"retired_at": stamp}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest/version_id={version}")
    return True


def status(spark: SparkSession, path: str, limit: int = 10) -> DataFrame:
    """The newest versions, and which is current: the newest that is ready and not retired."""
    rows = manifest(spark, path)
    current = rows.filter("ready and retired_at is null").agg(F.max_by("version_id", F.struct("loaded_at", "version_id"))).scalar()
    shown = rows.select(
        "version_id", F.coalesce("feed_version", F.left("feed_etag", F.lit(14))).alias("label"), "loaded_at", "ready",
        F.when(F.col("version_id") == current, "current").when(F.col("retired_at").isNotNull(), "retired").alias("mark"),
        F.col("row_counts")["trips"].alias("trips"), F.col("row_counts")["stop_times"].alias("stop_times"),
    )
    return shown.orderBy(F.desc("loaded_at")).limit(limit)
