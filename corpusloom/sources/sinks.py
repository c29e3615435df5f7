"""Writers: corpus lines, manifests, run and shard records, vocabularies."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import clean_or_null


def write_corpus(df: DataFrame, path: str, text: str = "text", mode: str = "errorifexists") -> None:
    """Stripped, non-empty texts, one per line."""
    lines = df.select(clean_or_null(F.col(text)).alias("value")).filter("value is not null")
    lines.write.mode(mode).text(path)


def write_corpus_if_absent(df: DataFrame, path: str, text: str = "text") -> None:
    """Keep an existing corpus untouched; pass ``mode='overwrite'`` to write_corpus to replace it."""
    write_corpus(df, path, text, mode="ignore")


def write_manifest(df: DataFrame, path: str, mode: str = "errorifexists", rejects: str | None = None) -> None:
    """JSON Lines manifest, nulls kept.

    JSON has no NaN and no infinity. Rows with such a duration are written to ``rejects`` as parquet, as they
    are. Without that folder a NaN becomes 0.0, as a duration that cannot be parsed does, and an infinity
    fails the job.
    """
    endless = F.coalesce(F.abs("duration") == float("inf"), F.lit(False))
    odd = F.coalesce(F.isnan("duration"), F.lit(False)) | endless
    rows = df.select("audio_filepath", "duration", "text")
    if rejects is not None:
        rows.filter(odd).write.mode(mode).parquet(rejects)
        rows = rows.filter(~odd)
    stop = F.raise_error(F.concat(F.lit("duration is no JSON number: "), F.coalesce("audio_filepath", F.lit("null"))))
    number = F.when(endless, stop.cast("double")).when(odd, F.lit(0.0)).otherwise(F.col("duration"))
    rows = rows.withColumn("duration", number)
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def shard_record(inventory: DataFrame, header: dict[str, Any]) -> DataFrame:
    """One row: selection header and the nested list of shards.

    The list has one entry per shard of the inventory, so it is bounded by the file listing.
    """
    entry = F.struct("shard", "path", F.col("rows").cast("long").alias("rows"), "source")
    gathered = inventory.agg(
        F.count(F.lit(1)).cast("int").alias("downloaded_files"),
        F.array_sort(F.collect_list(entry)).alias("files"),
    )
    fields = [F.lit(v).alias(k) for k, v in header.items()]
    return gathered.select(*fields, "downloaded_files", "files")


def write_shard_manifest(inventory: DataFrame, path: str, header: dict[str, Any]) -> None:
    """Record of a shard selection as JSON."""
    record = shard_record(inventory, header)
    record.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# Fields of a run record.
RUN_RECORD = T.StructType([
    T.StructField("profile", T.StringType()),
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("git_commit", T.StringType()),
    T.StructField("repo_root", T.StringType()),
    T.StructField("build_script", T.StringType()),
    T.StructField("build_command", T.ArrayType(T.StringType())),
    T.StructField("output_dir", T.StringType()),
    T.StructField("vocab_size", T.IntegerType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("character_coverage", T.DoubleType()),
    T.StructField("split", T.StringType()),
    T.StructField("percent", T.DoubleType()),
    T.StructField("max_samples", T.LongType()),
    T.StructField("num_files", T.IntegerType()),
    T.StructField("cache_dir", T.StringType()),
    T.StructField("local_data_dir", T.StringType()),
    T.StructField("text_column", T.StringType()),
    T.StructField("num_threads", T.IntegerType()),
])


def write_run_manifest(spark: SparkSession, path: str, run: dict[str, Any]) -> None:
    """Parameters of a run, next to its output."""
    row = tuple(run.get(name) for name in RUN_RECORD.names)
    record = spark.createDataFrame([row], RUN_RECORD)
    record.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """``piece<TAB>score`` lines in id order; a vocabulary is small by construction."""
    ordered = vocab.coalesce(1).sortWithinPartitions("id")
    ordered.select(F.concat_ws("\t", "piece", F.col("score").cast("string"))).write.mode(
        "overwrite"
    ).text(path)


def write_wordpiece_vocab(vocab: DataFrame, path: str) -> None:
    """One piece per line in id order."""
    vocab.coalesce(1).sortWithinPartitions("id").select("piece").write.mode("overwrite").text(path)
