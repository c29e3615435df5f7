"""Row numbers across files, and the sampling and capping rules built on them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.numbers import head_target, shards_to_take, stride_of
from corpusloom.session import broadcast_if_small
from corpusloom.sources.shards import shard_index, shard_inventory

_OFFSETS = "path string, first_ordinal long"
_HISTOGRAM_BITS = 16


class OrderedCorpus:
    """A set of files whose rows are numbered 0, 1, 2, ... in path order.

    Row counts per file come from one scan that reads no columns. They are as many as the files
    the driver lists for any scan, so the offsets are small. Rows are never sorted or shuffled.
    """

    def __init__(
        self, spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
    ):
        self._spark = spark
        self._reader = spark.read if schema is None else spark.read.schema(schema)
        listed = [paths] if isinstance(paths, str) else list(paths)
        counts = shard_inventory(self._reader.parquet(*listed)).collect()
        self.files = sorted((r["path"], r["rows"]) for r in counts)
        self.total = sum(rows for _, rows in self.files)

    @property
    def estimated_total(self) -> int:
        """Rows of the first file times the number of files."""
        return self.files[0][1] * len(self.files) if self.files else 0

    def rows(self, columns: Sequence[str] | None = None, cap: int | None = None) -> DataFrame:
        """Rows with ``ordinal``; with a cap only the files that hold a kept row are read."""
        offsets = self._offsets(cap)
        scan = self._reader.parquet(*[path for path, _ in offsets])
        picked = scan.select(
            *(columns or scan.columns),
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"),
        )
        return cap_rows(self._number(picked, offsets), cap)

    def number(self, rows: DataFrame) -> DataFrame:
        """``ordinal`` of rows of these files that carry ``path`` and ``at``."""
        return self._number(rows, self._offsets(None))

    def files_below(self, cap: int | None) -> list[str]:
        """Files that hold a row before the cap; the first file at least."""
        return [path for path, _ in self._offsets(cap)]

    def _offsets(self, cap: int | None) -> list[tuple[str, int]]:
        starts = accumulate((rows for _, rows in self.files), initial=0)
        numbered = [(path, start) for (path, _), start in zip(self.files, starts)]
        return [(p, at) for i, (p, at) in enumerate(numbered) if cap is None or at < cap or i == 0]

    def _number(self, rows: DataFrame, offsets: list[tuple[str, int]]) -> DataFrame:
        table = broadcast_if_small(self._spark.createDataFrame(offsets, _OFFSETS), len(offsets))
        numbered = rows.join(table, "path").withColumn("ordinal", F.expr("first_ordinal + at"))
        return numbered.drop("path", "at", "first_ordinal")

    def head_percent(
        self, percent: float, total: str = "exact", columns: Sequence[str] | None = None
    ) -> DataFrame:
        """The leading share of the rows, of the exact or of the estimated total."""
        if total not in ("exact", "first_shard"):
            raise ValueError("total must be 'exact' or 'first_shard'")
        rows = self.total if total == "exact" else self.estimated_total
        return self.rows(columns, None if percent >= 100 or rows == 0 else head_target(rows, percent))


def cap_rows(df: DataFrame, max_samples: int | None) -> DataFrame:
    """Rows read before the cap, counting those a later step drops; ``None`` keeps all."""
    return df if max_samples is None else df.filter(F.col("ordinal") < max_samples)


def stride_sample(df: DataFrame, percent: float) -> DataFrame:
    """Every ``int(100/percent)``-th row."""
    if percent >= 100:
        return df
    return df.filter(F.col("ordinal") % stride_of(percent) == 0)


def limit_samples(df: DataFrame, num_samples: int = -1) -> DataFrame:
    """First rows of a manifest; -1 keeps all."""
    return df if num_samples < 0 else df.filter(F.col("ordinal") < num_samples)


def select_shards(inventory: DataFrame, percent: float, total: int, split: str = "train") -> DataFrame:
    """Inventory rows of the first shards that cover a percentage of all shards."""
    return inventory.filter(shard_index(F.col("path"), split) < shards_to_take(total, percent))


def shuffle_key(columns: Sequence[str], seed: int):
    """Reproducible pseudo-random sort key of a row."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def seeded_shuffle(
    df: DataFrame, key: Sequence[str], seed: int, buffer: int | None = None
) -> DataFrame:
    """The same order for the same seed: over everything, or within buffers of ``ordinal``."""
    order = [shuffle_key(key, seed), *[F.col(c) for c in key]]
    if buffer is None:
        return df.orderBy(*order)
    return df.orderBy(F.expr(f"ordinal div {buffer}"), *order)


def sample_sentences(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` pseudo-random rows: those with the smallest hash of the unique ``key``.

    A histogram over the leading hash bits, reading the key columns only, finds where the ``n``-th
    hash lies; one bucket of it gives the exact bound. The rows themselves are only filtered, so
    neither a sort nor a shuffle moves a text, however large ``n`` is.
    """
    if n <= 0:
        return df
    place = F.struct(shuffle_key(key, seed).alias("h"), *[F.col(c) for c in key])
    bucket = F.shiftright(shuffle_key(key, seed), 64 - _HISTOGRAM_BITS)
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    seen = 0
    for row in sorted(counts.collect(), key=lambda r: r["bucket"]):
        if seen + row["rows"] >= n:
            inside = df.filter(bucket == row["bucket"]).select(place.alias("place"))
            last = inside.orderBy("place").limit(n - seen).agg(F.max("place").alias("last"))
            return _not_after(df, key, seed, last.first()["last"])
        seen += row["rows"]
    return df


def _not_after(df: DataFrame, key: Sequence[str], seed: int, last) -> DataFrame:
    hashed = shuffle_key(key, seed)
    bound = [F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in key]
    tie = F.struct(*[F.col(c) for c in key]) <= F.struct(*bound)
    return df.filter((hashed < last["h"]) | ((hashed == last["h"]) & tie))


def group_positions(df: DataFrame, group: Sequence[str], block_rows: int = 65_536) -> DataFrame:
    """0-based ``position`` of each row in its group, in ``ordinal`` order.

    Rows are numbered inside blocks of consecutive ordinals, so no window holds more than
    ``block_rows`` rows even if one group has most of the corpus. The base of a block is a running
    sum over the block counts, a table ``block_rows`` times smaller than the corpus.
    """
    if not group:
        return df.withColumn("position", F.col("ordinal"))
    blocks = df.withColumn("_block", F.expr(f"ordinal div {block_rows}"))
    counts = blocks.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        *group, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*group, "_block").orderBy("ordinal")
    numbered = blocks.withColumn("_at", F.row_number().over(inside) - 1)
    named = bases.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_block").alias("_in"), "_base")
    # Null is a group like any other.
    same = F.col("_block") == F.col("_in")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    joined = numbered.join(named, same).withColumn("position", F.expr("_base + _at"))
    return joined.select(*df.columns, "position")
