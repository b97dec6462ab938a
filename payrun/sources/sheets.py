"""Reading exported sheets and lookups.

An exported sheet is a CSV file; a directory of them is one run, each file
one batch. The reader keeps every cell as text (no inference), so values
never change type between files.

Row positions: a multi-line CSV file is read whole by one task, in file
order, so ``monotonically_increasing_id`` is consecutive inside a file.
The position of a row is its id minus the smallest id of its file; the
per-file minimum is a partial aggregate (one row per file) joined back.
No window over a whole batch is needed, so a very large batch never has to
fit in one task beyond the one that reads it. Wholly empty lines are
skipped by the CSV reader.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import join_keyed
from ..session import stored
from ..sinks.files import read_folders

SHEET_GLOB = "*.{csv,CSV}"


RECORD = "_record"          # the text of a record whose cell count differs from the schema's
CSV_OPTIONS = {"multiLine": True, "escape": '"', "header": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}


def wide_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*(f"c{i}" for i in range(width)), RECORD]])


def record_width(record: Column) -> Column:
    """Cells of a CSV record: its separators outside quotes, plus one."""
    return F.length(F.regexp_replace(record, '"[^"]*+"|[^,]', "")) + 1


def sheet_width(spark: SparkSession, path: str, glob: str = SHEET_GLOB, recursive: bool = False) -> int:
    """The most cells that any record of these sheets has (one pass, one number back)."""
    raw = spark.read.schema(wide_schema(1)).options(pathGlobFilter=glob, recursiveFileLookup=recursive, **CSV_OPTIONS).csv(path)
    widest = raw.agg(F.max(F.coalesce(record_width(F.col(RECORD)), F.when(F.col("c0").isNotNull(), 1))).alias("n")).first().n
    return widest or 1


def batch_name(path: Column, root: str | None) -> Column:
    """The file's place below ``root`` without extension, so equal names in two folders
    are two batches; the bare file name where the root is not part of the path."""
    name = F.regexp_extract(path, "[^/]*$", 0)
    if root:
        below = urllib.parse.quote(root.split("://")[-1].rstrip("/"), safe="/:@!$&'()*+,;=~") + "/"
        name = F.when(F.locate(below, path) > 0, F.substring_index(path, below, -1)).otherwise(name)
    return F.regexp_replace(name, r"\.[^./]*$", "")


def sheet_rows(raw: DataFrame, width: int, root: str | None = None) -> DataFrame:
    """``batch_id, _path, cells`` of records read with ``wide_schema(width)``; a
    record of more cells is an error, never cut."""
    too_wide = F.concat(F.lit(f"a record has more than {width} cells: "), F.col("_metadata.file_path"))
    return raw.select(
        batch_name(F.col("_metadata.file_path"), root).alias("batch_id"),
        F.col("_metadata.file_path").alias("_path"),
        F.when(record_width(F.col(RECORD)) > width, F.raise_error(too_wide))
        .otherwise(F.array(*[F.col(f"c{i}") for i in range(width)])).alias("cells"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Row positions inside each file.

    Rows get their ids in one evaluation, which is stored: ids rise within a file, and
    the least id of each file, read from the stored table, is its row 0.
    """
    rows = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "sheets")
    first = rows.groupBy("_path").agg(F.min("_id").alias("_first"))
    return join_keyed(rows, first, "_path").select("batch_id", (F.col("_id") - F.col("_first")).alias("row_idx"), "cells")


def read_grid(spark: SparkSession, path: str, glob: str = SHEET_GLOB, recursive: bool = False) -> DataFrame:
    """A directory of exported sheets -> ``grid(batch_id, row_idx, cells)``.

    ``batch_id`` is the file's place below ``path`` without extension; ``glob`` chooses
    which files (and so which sheets) are read (S9), ``recursive`` those in folders below
    too. The widest record decides how many cells each row has.
    """
    width = sheet_width(spark, path, glob, recursive)
    raw = spark.read.schema(wide_schema(width)).options(pathGlobFilter=glob, recursiveFileLookup=recursive, **CSV_OPTIONS).csv(path)
    return numbered(sheet_rows(raw, width, path))


def write_sheet(df: DataFrame, path: str) -> None:
    """Export a table as one CSV sheet per batch (used to land test input)."""
    (df.write.mode("overwrite").partitionBy("batch_id")
     .options(header=True, escape='"').csv(path))


def read_areas(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: the area lookup with a ``pos`` column for last-wins dedupe.

    A parquet lookup must carry ``pos``; a CSV lookup (code, area) gets it
    from file order.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    raw = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    c0, c1 = raw.columns[0], raw.columns[1]
    return stored(raw.select(F.monotonically_increasing_id().alias("pos"),
                             F.col(f"`{c0}`").alias("codigo"), F.col(f"`{c1}`").alias("area")), "areas")


def read_staging(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A processed table written by step 1, read back for step 2 (display names)."""
    return read_folders(spark, path, fmt)
