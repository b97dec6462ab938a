"""Sheets landing in a folder, processed as they arrive.

The source system processes one uploaded sheet per request. Here the
upload folder is a Structured Streaming file source: every micro-batch
holds the rows of the newly landed sheets, and ``foreachBatch`` runs the
same batch plan on them (grid -> header detection -> step 1) and writes
the result into a table partitioned by batch. The checkpoint (in
``spark.checkpoint.dir`` unless given) records which files were done, so a
restarted query skips no sheet. A write replaces the batches it holds and no
others, so an epoch that is retried, or a sheet that lands again, never repeats rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import header as H
from ..plans import pipeline
from ..rules import DEFAULT_RULES, PayRules
from ..sinks.files import write_folders
from ..sources.sheets import CSV_OPTIONS, SHEET_GLOB, numbered, sheet_rows, wide_schema


def start(spark: SparkSession, inbox: str, out: str, areas: DataFrame, rates: DataFrame,
          width: int = 64, rules: PayRules = DEFAULT_RULES, checkpoint: str | None = None,
          trigger_once: bool = False):
    """Start the stream; returns the ``StreamingQuery``.

    A stream's schema is fixed when it starts: a record of more than ``width``
    cells ends the query with an error.
    """
    raw = spark.readStream.schema(wide_schema(width)).options(pathGlobFilter=SHEET_GLOB, **CSV_OPTIONS).csv(inbox)
    rows = sheet_rows(raw, width, inbox)

    ckpt = checkpoint or os.path.join(spark.conf.get("spark.checkpoint.dir"), "uploads")

    def process(batch: DataFrame, epoch: int) -> None:
        # Promoted rows land in a staging table first (S10): step 1 then
        # reads plain stored columns. A retried epoch overwrites its own
        # staging folder and its own batches in the output.
        grid = numbered(batch)
        staging = os.path.join(ckpt, "staging", f"epoch={epoch}")
        H.promote_header(grid, rules).write.mode("overwrite").parquet(staging)
        named = spark.read.parquet(staging).drop("row_idx")
        derived = pipeline.step1(named, areas, rates, rules)
        write_folders(derived, out, ("batch_id",))

    writer = rows.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
