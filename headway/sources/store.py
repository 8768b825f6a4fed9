"""Files on the storage that Spark reads, whatever it is: small ones that the driver writes, lists and deletes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where there is no folder."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def put(spark: SparkSession, path: str, content: bytes, overwrite: bool = True) -> bool:
    """Write a file; False where it is there already and is not to be overwritten."""
    p, fs = _at(spark, path)
    if not overwrite and fs.exists(p):
        return False
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return True


def get(spark: SparkSession, path: str) -> bytes:
    """A file of a size that the driver holds."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
