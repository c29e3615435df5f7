"""Cap and stride over all rows of a stream of files, by a ledger of row numbers kept with each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import clean_or_null
from corpusloom.operators.sampling import cap_rows, stride_sample
from corpusloom.session import broadcast_if_small

LEDGER = "path string, first_ordinal long, rows long, batch long"


def ledger_table(spark: SparkSession, ledger: str) -> DataFrame:
    """``(path, first_ordinal, rows, batch)`` of every file read so far."""
    return spark.read.schema(LEDGER).parquet(ledger)


def rows_before(spark: SparkSession, ledger: str, batch_id: int) -> int:
    """Rows of all files of earlier micro-batches; the batch's own entry, left by a failed try, does not count."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return 0
    earlier = ledger_table(spark, ledger).filter(F.col("batch") < batch_id)
    return earlier.agg(F.max(F.expr("first_ordinal + rows"))).first()[0] or 0


def number_files(files: DataFrame, before: int) -> DataFrame:
    """``(path, first_ordinal, rows)``: the files of one micro-batch in order of name, after ``before`` rows.

    The window sees one row per file of the batch.
    """
    name = F.element_at(F.split("path", "/"), -1)
    order = Window.orderBy(F.regexp_extract("path", r"([^/]*-\d{5}\.parquet)", 1), name, "path")
    until = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return files.select("path", (F.coalesce(until, F.lit(0)) + before).alias("first_ordinal"), "rows")


def ordinal_ingest(
    rows: DataFrame, target: str, ledger: str, checkpoint: str, text: str = "text",
    percent: float = 100.0, max_samples: int | None = None,
) -> StreamingQuery:
    """Clean lines of new shards under one cap and one stride over all files, each shard exactly once.

    Files get their row numbers when they are read: in order of arrival, by name within a micro-batch.
    A micro-batch writes its rows as ``target/batch=id`` and its files' first numbers as
    ``ledger/batch=id``, both replacing what a failed try of the same batch left. The numbers of a batch
    follow from the entries of earlier batches alone, so a retry gives the same rows. ``None`` means no
    cap, 0 no rows; the cap and the stride count rows read, also those that are blank.
    """
    seen = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = rows_before(spark, ledger, batch_id)
        files = batch.groupBy(F.col("_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        number_files(files, before).write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")
        entry = spark.read.schema("path string, first_ordinal long, rows long").parquet(f"{ledger}/batch={batch_id}")
        listed = entry.count()
        numbered = batch.join(broadcast_if_small(entry, listed), F.col("_path") == F.col("path"))
        numbered = numbered.withColumn("ordinal", F.expr("first_ordinal + _at"))
        if max_samples is not None and before >= max_samples:
            numbered = numbered.limit(0)
        kept = stride_sample(cap_rows(numbered, max_samples), percent)
        kept = kept.withColumn(text, clean_or_null(F.col(text))).filter(F.col(text).isNotNull())
        kept = kept.drop("path", "first_ordinal", "rows", "_path", "_at")
        kept.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = seen.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
