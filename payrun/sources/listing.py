"""Listing stored run outputs by date folder.

Outputs of step 2 land under ``<root>/<date>/...`` or ``<root>/run_date=<date>/...`` (K5). The listing
reads file metadata only (``binaryFile`` with the ``content`` column pruned,
so no file body is read), takes the date from the first folder under the
root (``sin_fecha`` when there is none) and groups per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import dates


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root``: relative path, name, date folder, size."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "length", "modificationTime")
    root_uri = root.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape(root_uri) + "/", "")
    parts = F.split(rel, "/")
    return files.where(~F.col("path").endswith("/")).select(
        rel.alias("path"),
        F.element_at(parts, -1).alias("nombre"),
        F.when(F.size(parts) >= 2, F.regexp_replace(F.get(parts, 0), "^run_date=", ""))
        .otherwise(F.lit(R.NO_DATE_FOLDER)).alias("fecha"),
        F.coalesce(F.col("length"), F.lit(0)).alias("bytes"),
        F.round(F.coalesce(F.col("length"), F.lit(0)) / F.lit(1048576.0), 2).alias("tamano_mb"),
        dates.iso_text(F.col("modificationTime")).alias("actualizado"),
    )


def _escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)


def files_by_date(files: DataFrame) -> DataFrame:
    """A8 + O1: files and size per date folder, newest date first."""
    return (files.groupBy("fecha")
            .agg(F.count("*").alias("total_archivos"),
                 F.round(F.sum("bytes") / F.lit(1048576.0), 2).alias("total_mb"),
                 F.max("actualizado").alias("ultimo"))
            .orderBy(F.desc("fecha")))


def listing_totals(files: DataFrame) -> DataFrame:
    """Number of files and of date folders."""
    return files.agg(F.count("*").alias("total_archivos"),
                     F.count_distinct("fecha").alias("total_fechas"))
