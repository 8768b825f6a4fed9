"""Send the package to the executors of a job that starts from a checkout, so that their Python workers can import it."""

from __future__ import annotations

import io
import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession


def packed() -> bytes:
    """The package's modules as a zip, the same bytes for the same files."""
    top, out = pathlib.Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(f"{top.name}/{f.relative_to(top)}"), f.read_bytes())
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python path; the driver serves the file to every executor."""
    path = pathlib.Path(tempfile.mkdtemp(prefix="headway-")) / "headway.zip"
    path.write_bytes(packed())
    spark.sparkContext.addPyFile(str(path))
