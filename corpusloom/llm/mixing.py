"""Mixing sources to target weights by capped water-filling and seeded repetitions; Spark SQL only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import store, table

MAX_EPOCHS = 3
# A table of sources above this size is refused: it is ranked in one task.
MAX_SOURCES = 1_000_000
SEED = "corpusloom-mix"
# The first digits of a document's seeded key: 65,536 buckets of about equal size per source.
_BUCKET_DIGITS = 4
WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """``(source, weight)``: the weights repeat over the distinct sources by code point, null last."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    array = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select("source").distinct().select(
        "source", F.get(array, F.pmod(rank, F.lit(len(weights)))).alias("weight"))


def water_fill(sizes: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size, weight)``, one row per source.

    The targets share the sum of all sizes by weight; none exceeds ``max_epochs`` times its source,
    and what a clamped source leaves is shared by the others by weight, until none is above. In the
    order of cap over weight the clamped sources come first, so the water level follows from running
    sums: a source is clamped if the level computed without those before it would exceed its cap.
    Sources of size 0, and of weight 0 or null, get 0. If all are clamped, less than the sum is used.
    """
    weight = F.coalesce("weight", F.lit(0.0))
    cap = F.col("source_size") * float(max_epochs)
    rows = sizes.select("source", "source_size", weight.alias("weight"), cap.alias("cap"))
    order = W.orderBy((F.col("cap") / F.expr("nullif(weight, 0)")).asc_nulls_last(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(W.partitionBy())
    left = total - F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("cap"))).over(before), F.lit(0.0))
    share = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    rows = rows.select("*", left.alias("left"), share.alias("share"), F.row_number().over(order).alias("place"))
    open_ = F.expr("weight > 0 AND cap * share >= left * weight")
    # The first source that is not clamped fixes the level of all after it.
    level = F.min_by(F.when(open_, F.col("left") / F.col("share")), F.when(open_, F.col("place"))).over(W.partitionBy())
    target = F.when(F.col("weight") <= 0, F.lit(0.0)).otherwise(
        F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED, carry: list[str] = (),
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every document.

    A source with target ``t`` and size ``s`` takes each document ``floor(t / s)`` times whole. The
    rest of ``round(t)`` is filled with documents in the order of a seeded MD5 key; the last of them
    gives only the words still missing, so a source takes exactly its rounded target and no document
    more than ``max_epochs`` times its size. Reruns agree, whatever the partitions.

    Running sums are taken over 65,536 key buckets per source, and over single documents only inside
    the one bucket where the rest ends, so that a source with most of the corpus is still spread.
    ``weights`` are ``(source, weight)``; None means 5, 2, 1 repeating. Sources missing there take
    nothing. A null source is a source. Null and empty texts have size 0 and take 0. Rows with equal
    key and source follow by size; equal rows are interchangeable. Extra columns are ignored,
    but for those named in ``carry``, which come back in a struct ``row`` and also settle ties.
    """
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    extra = [F.struct(*carry).alias("row")] if carry else []
    docs = store(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"), *extra), "sizes")
    docs = docs.withColumn("bucket", F.substring("key", 1, _BUCKET_DIGITS))
    buckets = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sizes = store(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), "sources")
    if sizes.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    weights = cycled_weights(sizes) if weights is None else weights.groupBy("source").agg(F.max("weight").alias("weight"))
    named = weights.select(F.col("source").alias("w_source"), "weight")
    weighed = sizes.join(named, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    plan = water_fill(weighed, max_epochs).withColumn(
        "whole", F.expr("CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END"))
    plan = plan.withColumn("rest", F.expr("cast(round(target) AS bigint) - whole * source_size"))
    # One row per source, counted above, so these joins are broadcast.
    plan = store(plan.withColumnRenamed("source", "p_source"), "mix-plan")
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = buckets.withColumn("before", F.sum("bucket_size").over(upto) - F.col("bucket_size"))
    met = filled.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source")))
    # The bucket in which the rest of a source ends, and the words taken before it.
    ends = met.filter("before < rest AND before + bucket_size >= rest").groupBy("p_source").agg(
        F.min_by("bucket", "before").alias("end"), F.min("before").alias("before"))
    ends = ends.withColumnRenamed("p_source", "e_source")
    plan = plan.join(F.broadcast(ends), F.col("p_source").eqNullSafe(F.col("e_source")), "left").drop("e_source")
    rows = docs.join(F.broadcast(store(plan, "mix-ends")), F.col("source").eqNullSafe(F.col("p_source")))
    at_end = F.expr("end IS NOT NULL AND bucket = end")
    below = F.expr("CASE WHEN bucket < end THEN size ELSE 0 END")
    outside = rows.filter(~at_end).withColumn("extra", below)
    order = W.partitionBy("source").orderBy("key", "size", *(["row"] if carry else [])).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = rows.filter(at_end).withColumn("upto", F.sum("size").over(order) + F.col("before") - F.col("size"))
    inside = inside.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("upto"))))
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken")
    return outside.union(inside.drop("upto")).select("doc_id", "source", "size", "source_size", "target", taken, *(["row"] if carry else []))


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    A row that gives ``taken`` words of its ``size`` comes ``taken / size`` times whole and once more
    with its first ``taken % size`` words, white space between them kept. Rows ride along in the mix,
    so texts are shuffled only in the one bucket per source where its rest ends.
    """
    taken = mix(docs, carry=docs.columns).filter("taken > 0")
    taken = taken.select("row", "size", "taken", F.explode(F.expr("sequence(1, cast(ceil(taken / size) AS int))")).alias("copy"))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")
    text = F.when(left < F.col("size"), part).otherwise(F.col("row.text"))
    return taken.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def mix_sql(docs: str, select: str) -> str:
    """DuckDB SQL for ``select`` over the columns of ``mix`` on the relation ``docs``."""
    return f"""
WITH sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM {docs}),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    source_size * {MAX_EPOCHS}.0::DOUBLE AS cap
  FROM sizes),
ranked AS (
  SELECT *, sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER before, 0) AS left_over,
    sum(weight) OVER after AS share, row_number() OVER in_order AS place
  FROM weighed
  WINDOW in_order AS (ORDER BY cap / weight, source NULLS LAST),
    before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
plan AS (
  SELECT source, source_size, least(cap, coalesce(weight * (
    SELECT left_over / share FROM ranked WHERE cap * share >= left_over * weight ORDER BY place LIMIT 1), cap)) AS target
  FROM ranked),
repeats AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM plan),
queued AS (
  SELECT d.*, source_size, target, whole, round(target)::BIGINT - whole * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN repeats r ON d.source IS NOT DISTINCT FROM r.source),
mixed AS (
  SELECT *, (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM queued)
SELECT {select} FROM mixed
"""


SQL = mix_sql("documents", "doc_id, size, source_size, target, taken")
