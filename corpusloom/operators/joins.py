"""A left lookup that never gathers the rows of a hot key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most frequent keys are looked up by broadcast. Every other key then holds at most one
# ``HOT_KEYS``-th of all rows, so a shuffle on it is even enough.
HOT_KEYS = 10_000
_SALTS = 65_536


def hot_keys(counts: DataFrame, key: str, count: str) -> DataFrame:
    """The most frequent keys of a count table; at most ``HOT_KEYS`` rows."""
    return counts.orderBy(F.desc(count), key).limit(HOT_KEYS).select(key)


def left_lookup(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join of ``rows`` with ``lookup`` (one row per key), skew-safe for the ``hot`` keys.

    Rows of hot keys meet the broadcast part of the lookup; in the shuffle join they carry a salt
    instead of their key and so spread evenly.
    """
    values = [c for c in lookup.columns if c != key]
    known = F.broadcast(hot.select(key).distinct())
    marked = known.withColumn("_hot", F.lit(True))
    hot_part = F.broadcast(lookup.join(known, key, "left_semi")).select(
        key, *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    cold_part = lookup.join(known, key, "left_anti").select(
        F.col(key).alias("_key"), *[F.col(v).alias(f"_cold_{v}") for v in values]
    )
    salt = F.concat(F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("string"))
    keyed = rows.join(marked, key, "left").withColumn(
        "_key", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(F.col(key))
    )
    joined = keyed.join(hot_part, key, "left").join(cold_part, "_key", "left")
    found = [F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values]
    return joined.select(*rows.columns, *found)
