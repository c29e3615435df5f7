"""Line, manifest and CSV readers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small
from corpusloom.sources.schema import MANIFEST


def path_list(paths: str | Sequence[str]) -> list[str]:
    """A comma-separated string or a sequence, as a list of paths."""
    return paths.split(",") if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Plain text, one sentence per line, in ``value``."""
    return spark.read.option("lineSep", "\n").text(path_list(paths))


def read_manifest(
    spark: SparkSession, paths: str | Sequence[str], strict: bool = True
) -> DataFrame:
    """JSON Lines manifests with a fixed schema; a malformed line fails the job when strict."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(MANIFEST).option("mode", mode).json(path_list(paths))


_BLOCKS = "path string, block_start long, file_order int, first_mark long, first_position long"


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(value, file_order, manifest, position)``: lines of text files numbered as if read one after the other.

    ``file_order`` is the place in the list. A listed folder holds its files in order of path, and
    ``position`` counts lines from 0 over all of the list. A file may have any number of splits: a first
    scan counts the lines of each split, running sums in order of place, file and split start give where
    each begins, and within a split lines carry rising marks. There is one row per split, so no line is
    sorted or shuffled.
    """
    listed = path_list(paths)
    parts = [
        spark.read.option("lineSep", "\n").text(p).select(
            "value", F.lit(i).alias("file_order"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block_start"))
        for i, p in enumerate(listed)
    ]
    rows = reduce(DataFrame.unionAll, parts).withColumn("_mark", F.monotonically_increasing_id())
    splits = rows.groupBy("file_order", "path", "block_start").agg(
        F.count(F.lit(1)).alias("lines"), F.min("_mark").alias("first_mark")).collect()
    splits.sort(key=lambda r: (r["file_order"], r["path"], r["block_start"]))
    starts = accumulate((r["lines"] for r in splits), initial=0)
    table = [(r["path"], r["block_start"], r["file_order"], r["first_mark"], at) for r, at in zip(splits, starts)]
    offsets = broadcast_if_small(spark.createDataFrame(table, _BLOCKS), len(table))
    names = F.array(*[F.lit(p) for p in listed])
    return rows.join(offsets, ["path", "block_start", "file_order"]).select(
        "value", "file_order", names[F.col("file_order")].alias("manifest"),
        F.expr("first_position + _mark - first_mark").alias("position"))


def union_manifests(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of several manifests with their source, duplicates kept, in the columns of a manifest.

    ``file_order`` and ``position`` restore the order of the list and of the lines; see
    :func:`numbered_lines`. Blank lines are counted and left out; a malformed line fails the job.
    """
    lines = numbered_lines(spark, paths).filter(F.trim("value") != "")
    fields = F.from_json("value", MANIFEST, {"mode": "FAILFAST"})
    return lines.withColumn("fields", fields).select("fields.*", "file_order", "manifest", "position")


def manifest_texts(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corpus lines of a manifest, and the rows whose text is missing."""
    lines = manifest.filter(F.col("text").isNotNull()).select(F.col("text").alias("value"))
    return lines, manifest.filter(F.col("text").isNull())


def read_manifest_csv(spark: SparkSession, path: str, max_items: int) -> DataFrame:
    """First rows of a headed CSV manifest, all columns as strings."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.csv(path).limit(max_items)


def read_corpus(spark: SparkSession, paths: str | Sequence[str], format: str) -> DataFrame:
    """Corpus lines from plain text or from manifests; the format is always explicit."""
    if format == "lines":
        return read_lines(spark, paths)
    if format == "manifest":
        return manifest_texts(read_manifest(spark, paths))[0]
    raise ValueError("format must be 'lines' or 'manifest'")


def sentence_lines(text: Column) -> Column:
    """Lines of a text, as a training reader sees them."""
    return F.split(text, "\n")
