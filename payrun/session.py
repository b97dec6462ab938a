"""Spark session helpers for tests, the bench and local runs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "payrun") -> SparkSession:
    """A local session with the settings the package is tested under.

    AQE is on (runtime broadcast/skew handling), the UI is off, the session
    time zone is UTC.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "140")     # plans show longer paths
        .config("spark.driver.memory", os.environ.get("PAYRUN_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only where none is
    configured and the session is one local process (tests, local runs)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        d = tempfile.mkdtemp(prefix="payrun-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{ensure_checkpoint_dir(spark)}/payrun-{uuid.uuid4().hex}/{name}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC = "zstd"              # of the tables that the package writes: about two thirds of the default's bytes


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a DataFrame's write that runs inside go when it has ended. Otherwise
    they stay on the disk, beside what was written, until the driver collects its garbage
    (those of an SQL ``INSERT`` do in any case)."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: what reads it several times
    computes it once, and a lost executor costs no more than the read."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compiled_apart(df: DataFrame) -> DataFrame:
    """The same rows; what reads them is compiled apart from what makes them.

    Spark compiles a chain of projections as one Java method, and the JVM interprets
    methods beyond 8,000 bytecodes, many times slower. Between counted rows (``observe``)
    and their reader a new method begins. Filters above stay above.
    """
    return df.observe(f"rows_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
