"""Shared folders for intermediate tables of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    A scratch folder is made only where the setting is unset and the session
    is a single local process (tests); elsewhere an unset folder is an error.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not base:
        master = conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """What runs inside hands Python at most ``rows`` rows at a time (the session's number, if fewer or None)."""
    before = spark.conf.get(ARROW_ROWS)
    if rows and not 0 < int(before) <= rows:
        spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def stage(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts lineage: after a lost executor later steps read the table again
    and recompute nothing above it. Where rows are whole texts or sets, ``batch_rows``
    keeps what Python and the JVM hold of them at once small.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with arrow_rows(spark, batch_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where.getParent(), True)


def hash_sample(df: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows, each text of an id once, chosen by the hash of both; all of a
    smaller table.

    The choice does not depend on partitions or order, and neither null ids, nor one id
    on very many rows, nor many equal rows sway it. Distinct rows are counted before
    (about); the sample itself is one filter, and never has more than twice ``rows``.
    """
    order = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample"))
    total = df.agg(F.approx_count_distinct(order)).first()[0]
    if total > rows:
        df = df.where(F.pmod(order, F.lit(1 << 30)) < int(rows / total * (1 << 30)))
    return bounded(df.dropDuplicates([id_col, text_col]), order, 2 * rows)


def bounded(df: DataFrame, order: Column, rows: int, by: str | None = None) -> DataFrame:
    """At most ``rows`` rows (of each value of ``by``), the first ones in ``order``. One task
    sorts those of a value: for samples, which are small already."""
    place = F.row_number().over(Window.partitionBy(by or F.lit(0)).orderBy(order))
    return df.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")
