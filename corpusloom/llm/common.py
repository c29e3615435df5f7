"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch_path, ship_package

# Rows per Arrow batch, and the bytes of it that a function gets at a time: bound a Python worker's memory also
# where texts are long.
BATCH_ROWS = 512
SLICE_BYTES = 1 << 19


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and keep Arrow batches small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it from there: a cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches, of about ``SLICE_BYTES`` each; none of an empty batch."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` from one Arrow batch to one batch (or table), over every partition.

    It gets the ``slices`` of the batches.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield function(batch)

    return df.mapInArrow(run, schema)


def held_out(doc_id: str, modulus: int, remainder: int):
    """True for the rows that the crc32 fold keeps away from training; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus)) == remainder


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(a, b)`` of longs.

    Alternating large-star and small-star rounds; the component is its smallest node. A round joins
    edges to one row per node, so a hub's edges may be split over tasks. Every round is a stored
    table. Edges with a null end and loops are ignored.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = store(edges.distinct(), "edges")
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).union(
            edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = edges.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).distinct()
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.filter("a <> b").union(least.select("u", "m")).distinct()
        edges = store(small, "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
