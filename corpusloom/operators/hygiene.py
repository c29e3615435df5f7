"""Fingerprint de-duplication of shards and records, and audio header checks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.files import range_sha1
from corpusloom.functions.wav import wav_header
from corpusloom.session import scratch_path

# Fixed value: bytes of a file that enter its first fingerprint.
PREFIX_BYTES = 1_048_576
SAMPLE_RATE = 16_000


# Bytes of a file that one task hashes at a time.
RANGE_BYTES = 64 << 20


@F.pandas_udf(T.StringType())
def _range_sha1(paths: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([range_sha1(p, a, n) for p, a, n in zip(paths, starts, sizes)])


def _alike(files: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Files whose keys another file shares, and the others. A listing has one short row per file."""
    twins = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return files.join(twins, keys, "left_semi"), files.join(twins, keys, "left_anti")


def dedup_shards(
    files: DataFrame, prefix: int = PREFIX_BYTES, whole: bool = True, range_bytes: int = RANGE_BYTES,
    keep_unreadable: bool = False,
) -> DataFrame:
    """``(path, bytes, sha1)``: the first path, in sort order, of files with equal content.

    ``files`` has ``path`` and ``bytes``. Files are told apart in stages, each over those still alike: by
    size, by the SHA-1 of their first ``prefix`` bytes, then, with ``whole``, by the SHA-1 of all further
    ranges of ``range_bytes``, each read by a task of its own. Without ``whole`` equal size and prefix are
    enough. ``sha1`` is that of the prefix, null for a file alone with its size, which is not read. A file
    that cannot be read fails the job; with ``keep_unreadable`` it stays, whatever it holds.
    """
    spark = files.sparkSession
    sized, alone = _alike(files.select("path", "bytes"), ["bytes"])
    kept = alone.select("path", "bytes", F.lit(None).cast("string").alias("sha1"))
    digest = _range_sha1(F.col("path"), F.lit(0).cast("long"), F.lit(prefix).cast("long"))
    path = scratch_path(spark, "prefixes")
    sized.repartition(spark.sparkContext.defaultParallelism).withColumn("sha1", digest).write.parquet(path)
    hashed = spark.read.schema("path string, bytes long, sha1 string").parquet(path)
    if not keep_unreadable and (lost := hashed.filter("sha1 IS NULL").first()):
        raise OSError(f"cannot read {lost['path']}")
    kept = kept.unionByName(hashed.filter("sha1 IS NULL"))
    hashed = hashed.filter("sha1 IS NOT NULL")
    if not whole:
        return kept.unionByName(hashed.groupBy("bytes", "sha1").agg(F.min("path").alias("path")))
    twins, others = _alike(hashed, ["bytes", "sha1"])
    long = twins.filter(F.col("bytes") > prefix)
    starts = F.sequence(F.lit(prefix).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = long.select("path", F.explode(starts).alias("start"))
    ranges = ranges.repartition("path", "start").select(
        "path", F.struct("start", _range_sha1("path", "start", F.lit(range_bytes).cast("long")).alias("sha1")).alias("part"))
    # One entry per range of a file; a null marks a range that could not be read.
    bodies = ranges.groupBy("path").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        "path", F.exists("parts", lambda p: p["sha1"].isNull()).alias("lost"),
        F.sha1(F.array_join(F.transform("parts", lambda p: p["sha1"]), " ")).alias("body"))
    body_path = scratch_path(spark, "bodies")
    twins.join(bodies, "path", "left").write.parquet(body_path)
    compared = spark.read.schema("path string, bytes long, sha1 string, lost boolean, body string").parquet(body_path)
    if not keep_unreadable and (lost := compared.filter("lost").first()):
        raise OSError(f"cannot read {lost['path']}")
    content = F.when(F.col("lost"), F.concat(F.lit("path "), "path")).otherwise(F.coalesce("body", F.lit("")))
    first = compared.groupBy("bytes", "sha1", content.alias("content")).agg(F.min("path").alias("path"))
    return kept.unionByName(others).unionByName(first.drop("content"))


def record_key(text: Column, prefix: int | None = None) -> list[Column]:
    """Byte length and SHA-1 of the whole text, or of its first bytes."""
    data = F.encode(text, "UTF-8")
    return [
        F.octet_length(text).cast("long").alias("bytes"),
        F.sha1(data if prefix is None else F.substring(data, 1, prefix)).alias("sha1"),
    ]


def dedup_records(df: DataFrame, row_id: str, text: str, prefix: int | None = None) -> DataFrame:
    """Lowest id of every record fingerprint, with the number of copies.

    Only the key and the id are shuffled, after a partial aggregate, so a text with very many
    copies sends one row per task. Rows without a text are no copies of each other: all stay.
    """
    keyed = df.select(F.col(row_id), *record_key(F.col(text), prefix))
    own = F.when(F.col("sha1").isNull(), F.col(row_id)).alias("_own")
    return keyed.groupBy("bytes", "sha1", own).agg(
        F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies")
    ).drop("_own")


def keep_first_records(df: DataFrame, row_id: str, text: str, prefix: int | None = None) -> DataFrame:
    """Full rows of the records :func:`dedup_records` keeps."""
    kept = dedup_records(df, row_id, text, prefix).select(row_id)
    return df.join(kept, row_id, "left_semi")


def audio_probe(df: DataFrame, row_id: str, payload: Column, expected_rate: int = SAMPLE_RATE) -> DataFrame:
    """Header facts of each WAV payload and whether its rate is the declared one; see :func:`wav_header`.

    Payloads stay in the JVM; only their first chunks are looked at.
    """
    probed = df.select(F.col(row_id).alias("id"), wav_header(payload).alias("header")).select("id", "header.*")
    return probed.select(
        "*",
        F.try_divide("frames", "sample_rate").alias("duration"),
        F.coalesce(F.col("sample_rate") == expected_rate, F.lit(False)).alias("rate_ok"),
    )
