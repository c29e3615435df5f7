"""Incremental versions of extraction and word counts with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.numbers import stride_of
from corpusloom.functions.text import clean_or_null
from corpusloom.operators.stats import marked_word_counts
from corpusloom.streaming.progress import progress_rows


def stream_shards(
    spark: SparkSession, root: str, schema: T.StructType, split: str = "train",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Shards of a split as they arrive; the schema is given, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{root}/{split}-*.parquet")


def clean_stream(rows: DataFrame, text: str = "text", percent: float = 100.0) -> DataFrame:
    """Stripped, non-empty lines; the stride counts rows within each file.

    For one stride and a cap over all files see :func:`corpusloom.streaming.ledger.ordinal_ingest`.
    """
    if percent < 100:
        rows = rows.filter(F.col("_metadata.row_index") % stride_of(percent) == 0)
    return rows.withColumn(text, clean_or_null(F.col(text))).filter(F.col(text).isNotNull())


def incremental_ingest(lines: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append clean lines to parquet, each shard exactly once; stops when all are done."""
    writer = lines.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def incremental_word_counts(
    rows: DataFrame, table: str, checkpoint: str, text: str = "text"
) -> StreamingQuery:
    """Word counts of each micro-batch as one part of a table, replaced if the batch is retried.

    The running table is the sum over the parts; see :func:`word_count_table`. Nothing is kept in
    streaming state, so its size does not depend on the number of distinct words.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        marked_word_counts(batch, text).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def word_count_table(spark: SparkSession, table: str) -> DataFrame:
    """Current totals of the parts written by :func:`incremental_word_counts`."""
    parts = spark.read.schema("word string, n long, batch long").parquet(table)
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def compact_word_counts(spark: SparkSession, table: str, target: str) -> None:
    """Write the totals as the first part of a new table, so that old parts can be dropped."""
    word_count_table(spark, table).write.parquet(f"{target}/batch=-1")


def with_progress(rows: DataFrame, kept: Column, name: str = "progress") -> DataFrame:
    """Count rows read and lines kept while the stream runs."""
    return rows.observe(
        name, F.count(F.lit(1)).alias("rows_read"), F.count(kept).alias("lines_kept")
    )


COUNTERS = "rows_read long, lines_kept long"


def progress_counters(spark: SparkSession, path: str) -> DataFrame:
    """``(query, batch, rows_read, lines_kept)`` of every micro-batch that a :class:`ProgressTable` stored."""
    return progress_rows(spark, path, COUNTERS)
