"""The training-data pipeline: documents through five stages to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given; its
result is written as Parquet and read again as the next stage's documents. All
but the last return the columns of ``documents``. A stage that drops documents
decides on each row by a key of its own: rows with a null doc_id, repeated rows and
several texts under one doc_id are judged each by its own text. Further columns of the
documents are kept as they are, whatever their names: they travel as one struct, and
the names of helper columns give way to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrun.llm import decontam, hamming_dedup, packing, pii, toxicity
from payrun.llm.common import stage as written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(as_struct(docs), model, keep=(DOCUMENT,))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(f"{DOCUMENT}.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (5-word shingles, similarity 0.8) the document of
    the smallest id stays, one without an id only where none has one."""
    rows, row = with_row_key(docs)
    found = hamming_dedup.near_duplicates(rows.select(row, "text"), n=5, id_col=row).select(F.col("doc_id").alias("row"), "component_id")
    placed = written(found.join(rows.select(F.col(row).alias("row"), "doc_id"), "row"), "placed")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return without(rows, row, placed.select("row").join(first.select("first.row"), "row", "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    rows, row = with_row_key(docs)
    found = decontam.contaminated(rows.select(row, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return without(rows, row, found.select(F.col("doc_id").alias("row")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the text by its kind; ``n_chars`` follows the text."""
    found = pii.find_spans(as_struct(docs), pii.fit(docs), keep=(DOCUMENT,))
    changed = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[changed.get(c, F.col(DOCUMENT)[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, in sequences of at most 1024."""
    return packing.pack(docs, with_ids=True)


DOCUMENT = "document"


def as_struct(docs: DataFrame) -> DataFrame:
    """Id, text, and the whole document as one value."""
    return docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias(DOCUMENT))


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key of each row, written so that every later read has the
    same, and the name of its column, which no column of the documents has."""
    row = "pipeline_row"
    while row in docs.columns:
        row += "_"
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def without(rows: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """Documents whose row key is not among ``dropped(row)``; texts are shuffled only
    where the keys are too many for a table in each task."""
    dropped = written(dropped.distinct().select(F.col("row").alias(row)), "dropped", hamming_dedup.BATCH_ROWS)
    if dropped.count() <= hamming_dedup.BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, row, "left_anti").drop(row)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("decontamination", drop_contaminated),
          ("personal_data", redact_personal_data), ("packing", pack)]

#: Trained models decide in the first stage, which SQL cannot express; tests compare each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = written(function(spark, docs, sf_dir), name)
    return docs
