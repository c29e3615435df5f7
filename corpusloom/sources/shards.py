"""Parquet shard scans: inventory, split scan, column fallback, tolerance, discovery."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.files import resolve
from corpusloom.sources.schema import CORPUS_TEXT_ORDER


def shard_name(path: Column, split: str = "train") -> Column:
    """The ``split-00000.parquet`` component of a path (a file or a folder of parts)."""
    return F.regexp_extract(path, rf"({split}-\d{{5}}\.parquet)", 1)


def shard_index(path: Column, split: str = "train") -> Column:
    """Number of the shard a path belongs to."""
    return F.regexp_extract(path, rf"{split}-(\d{{5}})\.parquet", 1).try_cast("int")


def _reader(spark: SparkSession, schema: T.StructType | None, tolerant: bool):
    reader = spark.read.option("ignoreCorruptFiles", str(tolerant).lower())
    return reader.schema(schema) if schema is not None else reader


def scan_split(
    spark: SparkSession, root: str, split: str = "train", num_files: int | None = None,
    columns: Sequence[str] | None = None, schema: T.StructType | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Rows of the first ``num_files`` shards of a split, with their ``shard`` number.

    The bound is a predicate on the file path, so files beyond it are pruned before any read.
    """
    rows = _reader(spark, schema, tolerant).parquet(f"{root}/{split}-*.parquet")
    index = shard_index(F.col("_metadata.file_path"), split)
    wanted = [F.col(c) for c in (columns or rows.columns)]
    if num_files is not None:
        rows = rows.filter(index < num_files)
    return rows.select(*wanted, index.alias("shard"))


def contiguous_shards(spark: SparkSession, root: str, split: str = "train") -> int:
    """How many shards exist before the first missing number."""
    files = _listing(spark, root, split)
    present = files.select("shard").distinct()
    wanted = files.agg(F.max("shard").alias("top")).select(
        F.explode(F.sequence(F.lit(0), F.col("top") + 1)).alias("shard")
    )
    return wanted.join(present, "shard", "left_anti").agg(F.min("shard")).first()[0] or 0


def _listing(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Shard numbers and file names; the content column is pruned, so nothing is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(root)
    )
    index = shard_index(F.col("path"), split)
    return files.select(F.col("path"), F.col("length").alias("bytes"), index.alias("shard")).filter(
        index.isNotNull()
    )


def tolerant_scan(
    spark: SparkSession, root: str, split: str = "train", columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Stop at the first missing shard, skip unreadable files before it."""
    return scan_split(
        spark, root, split, contiguous_shards(spark, root, split), columns, schema, tolerant=True
    )


def _footers(tolerant: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = []
            for path in batch["path"]:
                try:
                    store, inner = resolve(path)
                    names.append(list(pq.read_schema(inner, filesystem=store).names))
                except (OSError, ValueError):
                    if not tolerant:
                        raise
                    names.append(None)
            yield batch.assign(names=names)[["path", "shard", "names"]]

    return run


def text_fallback(
    spark: SparkSession, root: str, split: str = "train", preferred: str | None = None,
    order: Sequence[str] = CORPUS_TEXT_ORDER, keep: Sequence[str] = (),
    num_files: int | None = None, positions: bool = False, tolerant: bool = False,
) -> DataFrame:
    """One ``text`` column over the first shards of a split; see :func:`text_of_files`."""
    listing = _listing(spark, root, split)
    if num_files is not None:
        listing = listing.filter(F.col("shard") < num_files)
    return text_of_files(spark, listing, split, preferred, order, keep, positions, tolerant)


def text_of_files(
    spark: SparkSession, listing: DataFrame, split: str = "train", preferred: str | None = None,
    order: Sequence[str] = CORPUS_TEXT_ORDER, keep: Sequence[str] = (), positions: bool = False,
    tolerant: bool = False,
) -> DataFrame:
    """One ``text`` column: the preferred name where a file has it, else the first of ``order``.

    Presence is decided per file from its footer, read by tasks. Files without any of the names
    are left out. One scan per chosen column name, so each scan reads a single text column.
    ``positions`` adds the file ``path`` and the row number ``at`` in it. A file whose footer cannot be
    read fails the job, or is left out if ``tolerant``.
    """
    footers = listing.select("path", "shard").mapInPandas(
        _footers(tolerant), "path string, shard int, names array<string>"
    )
    names = [preferred or order[0], *[c for c in order if c != (preferred or order[0])]]
    choice = F.coalesce(*[F.when(F.array_contains("names", c), F.lit(c)) for c in names])
    # One row per file: bounded by the listing the driver holds for any scan.
    chosen = footers.select("path", choice.alias("column")).filter("column is not null").collect()
    index = shard_index(F.col("_metadata.file_path"), split)
    place = (F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"))
    scans = []
    for name in names:
        paths = sorted(r["path"] for r in chosen if r["column"] == name)
        if paths:
            scans.append(spark.read.parquet(*paths).select(
                *keep, F.col(name).alias("text"), index.alias("shard"), *(place if positions else ())
            ))
    if not scans:
        raise ValueError(f"no listed file has one of {names}")
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out


def shard_inventory(rows: DataFrame) -> DataFrame:
    """Rows and bytes per file of a scan; reads no columns."""
    meta = F.col("_metadata")
    return rows.groupBy(
        meta["file_path"].alias("path"), meta["file_size"].alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def find_shards(spark: SparkSession, roots: Sequence[str], split: str = "train") -> DataFrame:
    """Every shard file below several roots: unique paths in path order."""
    listings = [_listing(spark, root, split) for root in roots]
    out = listings[0]
    for listing in listings[1:]:
        out = out.unionByName(listing)
    return out.dropDuplicates(["path"]).orderBy("path")


def ordered_shards(inventory: DataFrame, split: str = "train") -> DataFrame:
    """Inventory rows in shard order."""
    return inventory.orderBy(shard_index(F.col("path"), split), "path")
