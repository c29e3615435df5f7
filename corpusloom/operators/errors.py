"""Word and character error rates over (reference, hypothesis) rows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import split_words

_COUNTS = T.StructType([
    T.StructField(name, T.IntegerType()) for name in ("substitutions", "insertions", "deletions")
])


def edit_distance(reference: Sequence, hypothesis: Sequence) -> int:
    """Edit distance with one column of the table per step as bits of whole numbers.

    The differences of a column lie in two bit vectors of one bit per reference item, kept in machine
    words by Python's integers, so memory is linear and a step costs one operation per word of bits.
    """
    if not reference or not hypothesis:
        return len(reference) + len(hypothesis)
    places: dict = defaultdict(list)
    for at, item in enumerate(reference):
        places[item].append(at)
    size = len(reference)
    every, top = (1 << size) - 1, 1 << (size - 1)
    equal: dict = {}
    more, less, distance = every, 0, size
    for item in hypothesis:
        here = equal.get(item)
        if here is None:
            here = equal[item] = _bits(places.get(item, ()), size)
        carry = here | less
        zero = (((carry & more) + more) ^ more) | carry
        rise = less | (every & ~(zero | more))
        fall = more & zero
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise = (rise << 1) | 1
        more = every & ((fall << 1) | ~(zero | rise))
        less = every & rise & zero
    return distance


def _bits(places: Sequence[int], size: int) -> int:
    """A number with ones at the places."""
    if len(places) < 8:
        return sum(1 << at for at in places)
    flags = np.zeros(size, np.uint8)
    flags[list(places)] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def align_counts(reference: list, hypothesis: list) -> tuple[int, int, int]:
    """Substitutions, insertions and deletions of one cheapest alignment.

    Among alignments of equal cost the one with most substitutions is counted. The distance, found
    first, bounds how far a cheapest alignment strays from the diagonal; only that band of the table is
    walked, one row at a time. A cell packs cost and indels into one number, so one minimum decides both.
    """
    distance = edit_distance(reference, hypothesis)
    surplus = len(hypothesis) - len(reference)
    if not distance:
        return 0, 0, 0
    codes = {w: i for i, w in enumerate(dict.fromkeys([*reference, *hypothesis]))}
    hyp = np.array([codes[w] for w in hypothesis], dtype=np.int64)
    scale = len(reference) + len(hypothesis) + 1
    indel, swap = scale + 1, scale
    # A way through diagonal d has at least |d| + |surplus - d| indels.
    spare = (distance - abs(surplus)) // 2
    low, high = min(0, surplus) - spare, max(0, surplus) + spare
    far = np.iinfo(np.int64).max // 4
    ramp = np.arange(high - low + 1, dtype=np.int64) * indel
    # The cell of diagonal d in row i is column i + d, at place d - low of the band.
    column = np.arange(low, high + 1)
    at = np.where((column >= 0) & (column <= len(hyp)), column * indel, far)
    padded = np.concatenate((np.full(max(0, -low) + 1, -1), hyp, np.full(max(0, high) + len(reference) + 1, -1)))
    begin = max(0, -low) + 1
    for row, word in enumerate(reference, 1):
        best = at + np.where(padded[begin + row + low - 1 : begin + row + high] == codes[word], 0, swap)
        best[:-1] = np.minimum(best[:-1], at[1:] + indel)
        # Columns outside the table stay out of reach; column 0 is entered from above only.
        column += 1
        best[(column < 0) | (column > len(hyp))] = far
        if (zero := -row - low) >= 0 and zero < len(best):
            best[zero] = min(far, row * indel)
        # An insertion chain adds a constant per step: a running minimum of the offsets.
        at = np.minimum(np.minimum.accumulate(best - ramp) + ramp, far)
        at[column > len(hyp)] = far
    cost, indels = divmod(int(at[surplus - low]), scale)
    insertions = (indels + surplus) // 2
    return cost - indels, insertions, indels - insertions


@F.pandas_udf(_COUNTS)
def _word_edits(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    rows = [align_counts(list(r), list(h)) for r, h in zip(reference, hypothesis)]
    return pd.DataFrame(rows, columns=["substitutions", "insertions", "deletions"])


# Texts whose table has more cells than this are compared by bits.
LARGE_TABLE = 4_000_000


@F.pandas_udf(T.IntegerType())
def _long_edits(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    pairs = zip(reference, hypothesis)
    return pd.Series([None if r is None or h is None else edit_distance(r, h) for r, h in pairs], dtype="Int32")


def char_edits(reference: Column, hypothesis: Column) -> Column:
    """Edit distance of code points: the built-in expression, but for long texts bit vectors."""
    large = F.length(reference).cast("long") * F.length(hypothesis) > LARGE_TABLE
    by_bits = _long_edits(F.when(large, reference), F.when(large, hypothesis))
    return F.when(large, by_bits).otherwise(F.levenshtein(F.when(~large, reference), hypothesis))


def row_errors(df: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """Word and character edit counts of each row."""
    ref, hyp = F.col(reference), F.col(hypothesis)
    edits = _word_edits(split_words(ref), split_words(hyp))
    return df.select(
        "*",
        F.size(split_words(ref)).alias("ref_words"),
        F.length(ref).alias("ref_chars"),
        edits.alias("_edits"),
        char_edits(ref, hyp).alias("char_edits"),
    ).select(
        "*", "_edits.substitutions", "_edits.insertions", "_edits.deletions"
    ).drop("_edits")


def _rate(edits: Column, size: Column) -> Column:
    return F.when(size == 0, F.when(edits == 0, 0.0).otherwise(1.0)).otherwise(edits / size)


def error_rates(df: DataFrame, reference: str, hypothesis: str, key: str | None = None) -> DataFrame:
    """Corpus error rates: edits summed over rows, divided by the reference size."""
    rows = row_errors(df, reference, hypothesis)
    grouped = rows.groupBy(key) if key else rows.groupBy()
    names = ("ref_words", "substitutions", "insertions", "deletions", "ref_chars", "char_edits")
    totals = grouped.agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(n).cast("long").alias(n) for n in names]
    )
    word_edits = F.col("substitutions") + F.col("insertions") + F.col("deletions")
    return totals.withColumn("word_edits", word_edits).select(
        "*",
        F.round(_rate(F.col("word_edits"), F.col("ref_words")), 6).alias("wer"),
        F.round(_rate(F.col("char_edits"), F.col("ref_chars")), 6).alias("cer"),
    )


def character_error_rates(df: DataFrame, reference: str, hypothesis: str, key: str) -> DataFrame:
    """Character error rate per key; a row with a null text counts, its edits do not."""
    ref, hyp = F.col(reference), F.col(hypothesis)
    totals = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length(ref)).alias("ref_chars"),
        F.sum(char_edits(ref, hyp)).alias("char_edits"),
    )
    return totals.withColumn("cer", F.round(_rate(F.col("char_edits"), F.col("ref_chars")), 6))
