"""K1, K2, K3, K5, K6, K7, K8: the files of a run.

Staging holds the processed sheet of each batch, partitioned by ``batch_id``; a run
replaces the partitions of its own batches and touches no other (dynamic overwrite).
The dated output keeps every run: under ``<root>/detail``, ``rates``, ``areas`` and
``records`` by local day, time of the run and batch; the same run written again
replaces itself.

Rows are rebalanced by their folder before a write: Spark joins small pieces and
splits large ones (a batch that holds a third of the rows included), so a folder
has few files of bounded size and no task writes to every folder. Where a run is known
to have few folders, that shuffle would cost more than it saves: the tasks write the
rows that they have, one file a folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators import publish as P
from ..rules import DEFAULT_RULES, PayRules
from ..session import CODEC, shuffles_dropped

FOLDERS = ("run_date", "run_stamp", "batch_id")
PARTS = ("detail", "rates", "areas", "records")
FEW_FOLDERS = 16            # of a run: up to so many, each task writes to all of them


def few_batches(batches: DataFrame) -> bool:
    """Whether a table with one row a batch (the rates, say) has few of them."""
    return batches.limit(FEW_FOLDERS + 1).count() <= FEW_FOLDERS


def write_folders(df: DataFrame, path: str, folders: tuple[str, ...], fmt: str = "parquet", max_rows: int = 5_000_000,
                  reset: str = "own", few: bool = False) -> None:
    """Write a table partitioned by ``folders``; with ``few`` of them, without a shuffle.

    ``reset="own"`` replaces the folders that the rows name, ``"all"`` everything below
    ``path``. A folder for which no row comes any more goes with ``"all"`` only.
    """
    rows = df if few else df.hint("rebalance", *folders)
    writer = (rows.write.mode("overwrite").format(fmt)
              .option("partitionOverwriteMode", {"own": "dynamic", "all": "static"}[reset])
              .option("maxRecordsPerFile", max_rows).partitionBy(*folders))
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    with shuffles_dropped(df.sparkSession):
        writer.save(path)


def read_folders(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read it back; folder names are text (a batch named 007 stays so)."""
    reader = spark.read.options(header=True, multiLine=True, escape='"') if fmt == "csv" else spark.read
    found = reader.format(fmt).load(path).schema
    kept = T.StructType([T.StructField(f.name, T.StringType()) if f.name in FOLDERS else f for f in found])
    return reader.format(fmt).schema(kept).load(path)


def write_staging(sheet: DataFrame, path: str, fmt: str = "parquet", reset: str = "own", few: bool = False) -> None:
    """K1 and K6: the 38 columns of each batch; its older rows go."""
    write_folders(sheet, path, ("batch_id",), fmt, reset=reset, few=few)


def write_run(final: DataFrame, rates: DataFrame, areas: DataFrame, root: str, run_ts: Column,
              rules: PayRules = DEFAULT_RULES, records: bool = False, max_rows: int = 5_000_000) -> None:
    """K5 with what goes beside it: the rows of a run (with ``batch_id``), the rates
    report (K2, K8), the area lookup (K3) and, if asked for, the JSON records (K7)."""
    when = {"run_date": dates.local_date_text(run_ts, rules.business_tz), "run_stamp": dates.local_stamp_text(run_ts, rules.business_tz)}

    few = few_batches(rates)

    def put(df: DataFrame, part: str, folders: tuple[str, ...], fmt: str = "parquet") -> None:
        write_folders(df.withColumns(when), f"{root}/{part}", folders, fmt, max_rows, few=few or folders == FOLDERS[:2])

    put(final, "detail", FOLDERS)
    put(P.rates_report(rates, rules=rules), "rates", FOLDERS[:2])
    put(areas, "areas", FOLDERS[:2])
    if records:
        put(P.json_records(final), "records", FOLDERS, "text")
