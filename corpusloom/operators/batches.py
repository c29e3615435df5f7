"""Batches, padding, frames, chunks and training steps."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.sampling import group_positions

# Feature window and stride, encoder subsampling, and the chunk base in seconds.
WINDOW_MS = 25
STRIDE_MS = 10
SUBSAMPLING = 8
CHUNK_BASE_MS = 80
RIGHT_CONTEXTS = (0, 1, 6, 13)


def training_step_plan(
    df: DataFrame, split: str, batch_size: int, epochs: int, max_steps: int | None = None
) -> DataFrame:
    """Optimizer steps per split; a positive ``max_steps`` stands as given."""
    counted = df.groupBy(split).agg(F.count(F.lit(1)).alias("samples"))
    per_epoch = F.greatest(F.lit(1), F.ceil(F.col("samples") / batch_size)).cast("long")
    steps = F.lit(max_steps).cast("long") if (max_steps or 0) > 0 else F.col("steps_per_epoch") * epochs
    return counted.withColumn("steps_per_epoch", per_epoch).withColumn("max_steps", steps)


def pad_batches(
    df: DataFrame, group: Sequence[str], batch_size: int, length: str = "duration"
) -> DataFrame:
    """Padding of consecutive batches: longest row, padded sum and wasted share.

    Batches are numbered in ``ordinal`` order inside each group; see ``group_positions``.
    """
    numbered = group_positions(df, group).withColumn(
        "batch", F.expr(f"position div {batch_size}")
    )
    padded = numbered.groupBy(*group, "batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(length).alias("pad_length"),
        F.sum(length).alias("used"),
    )
    room = F.col("rows") * F.col("pad_length")
    return padded.withColumn("wasted_share", F.when(room == 0, F.lit(0.0)).otherwise(1 - F.col("used") / room))


def bucket_edges(df: DataFrame, buckets: int, length: str = "duration") -> list[float]:
    """Inner edges that split the rows into about equal buckets."""
    points = [i / buckets for i in range(1, buckets)]
    edges = df.agg(F.percentile_approx(length, F.array(*map(F.lit, points)), F.lit(10000))).first()[0]
    return sorted(set(edges or []))


# Lengths whose ratio is below this share a bin of the sketch; lengths below the least one share the first.
BIN_RATIO, LEAST_LENGTH = 1.002, 1e-3


def length_sketch(df: DataFrame, length: str = "duration", ratio: float = BIN_RATIO) -> DataFrame:
    """``(bin, rows, used, longest)``: lengths in bins of equal ratio.

    Sketches of parts of a corpus merge by :func:`merge_sketches`. Null, NaN and negative lengths are left
    out. The number of bins follows from the ratio and the range of lengths, not from the rows.
    """
    value = F.col(length).cast("double")
    place = F.floor(F.log(F.greatest(value, F.lit(LEAST_LENGTH)) / LEAST_LENGTH) / math.log(ratio)).cast("int")
    kept = df.filter((value >= 0) & ~F.isnan(value) & (value < float("inf")))
    return kept.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(value).alias("used"), F.max(value).alias("longest"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One sketch of several."""
    return reduce(DataFrame.unionAll, sketches).groupBy("bin").agg(
        F.sum("rows").alias("rows"), F.sum("used").alias("used"), F.max("longest").alias("longest"))


def least_padding(rows: np.ndarray, longest: np.ndarray, buckets: int) -> list[int]:
    """Ends of at most ``buckets`` runs of bins with the least sum of rows times their run's longest.

    Dynamic programming over the bins; the best cut of a prefix never moves back as the prefix grows, so
    each layer is filled by halving.
    """
    size = len(rows)
    count = np.concatenate(([0], np.cumsum(rows, dtype=np.float64)))
    best = np.concatenate(([0.0], count[1:] * longest))
    cuts = []
    for _ in range(min(buckets, size) - 1):
        layer, cut = best.copy(), np.full(size + 1, -1)
        work = [(1, size, 0, size - 1)]
        while work:
            low, high, first, last = work.pop()
            if low > high:
                continue
            middle = (low + high) // 2
            begin = np.arange(first, min(last, middle - 1) + 1)
            cost = best[begin] + (count[middle] - count[begin]) * longest[middle - 1]
            at = int(np.argmin(cost))
            if cost[at] < layer[middle]:
                layer[middle], cut[middle] = cost[at], begin[at]
            work += [(low, middle - 1, first, int(begin[at])), (middle + 1, high, int(begin[at]), last)]
        cuts.append(cut)
        best = layer
    ends, at = [size], size
    for cut in reversed(cuts):
        if cut[at] > 0:
            at = int(cut[at])
            ends.append(at)
    return ends[::-1]


def padding_edges(sketch: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, upper, rows, used, padded)``: the buckets of least padding that a length sketch allows.

    ``upper`` is the longest length of a bucket, where it ends. A sketch has some ten thousand bins at most.
    """
    bins = sketch.orderBy("bin").toPandas()
    rows, used, longest = (bins[c].to_numpy(np.float64) for c in ("rows", "used", "longest"))
    ends = least_padding(rows, longest, buckets) if len(bins) else []
    out = []
    for k, (a, b) in enumerate(zip([0, *ends], ends)):
        n, top = int(rows[a:b].sum()), float(longest[b - 1])
        out.append((k, top, n, float(used[a:b].sum()), n * top))
    return sketch.sparkSession.createDataFrame(out, "bucket long, upper double, rows long, used double, padded double")


def inner_edges(edges: DataFrame) -> list[float]:
    """Bounds for :func:`bucket_batches` from the buckets of :func:`padding_edges`: the next length after each upper one."""
    uppers = [r["upper"] for r in edges.orderBy("bucket").collect()]
    return [math.nextafter(u, math.inf) for u in uppers[:-1]]


def bucket_batches(
    df: DataFrame, edges: Sequence[float], batch_size: int, length: str = "duration"
) -> DataFrame:
    """Batches made inside duration buckets, so rows of like length share a batch."""
    bucket = F.lit(0)
    for edge in edges:
        bucket = bucket + F.when(F.col(length) >= edge, F.lit(1)).otherwise(F.lit(0))
    return pad_batches(df.withColumn("bucket", bucket), ["bucket"], batch_size, length)


def frame_budget(df: DataFrame, duration: str = "duration") -> DataFrame:
    """Feature frames and encoder steps of each row."""
    ms = F.round(F.col(duration) * 1000).cast("long")
    frames = F.greatest(F.lit(0), F.floor((ms - WINDOW_MS) / STRIDE_MS) + 1).cast("long")
    steps = F.ceil(F.col("frames") / SUBSAMPLING).cast("long")
    return df.withColumn("frames", frames).withColumn("encoder_steps", steps)


def chunk_ms(right_context: int) -> int:
    """Length of a streaming chunk for a right context."""
    return (right_context + 1) * CHUNK_BASE_MS


def chunk_plan(df: DataFrame, row_id: str, right_context: int, duration: str = "duration") -> DataFrame:
    """Chunks of each utterance; the last one may be shorter, a zero duration has none."""
    size = chunk_ms(right_context)
    total = F.round(F.col(duration) * 1000).cast("long")
    last = F.ceil(F.col("total_ms") / size).cast("long") - 1
    rows = df.select(row_id, total.alias("total_ms")).filter("total_ms > 0")
    chunks = rows.select(row_id, "total_ms", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
    start = F.col("chunk") * size
    return chunks.select(
        row_id, "chunk", start.alias("start_ms"),
        F.least(F.lit(size), F.col("total_ms") - start).cast("long").alias("length_ms"),
    )
