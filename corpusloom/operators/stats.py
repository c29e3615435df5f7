"""Counters and statistics over corpora, words, characters and vocabulary runs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    WORD_MARK, bert_normalize, bert_words, clean_or_null, cut_word,
)

# Distinct words a task sums up before it passes them on.
WORDS_PER_BATCH = 300_000


def extraction_counters(df: DataFrame, text: str = "text", source: str = "shard") -> DataFrame:
    """Files seen, rows read and lines kept, in one pass."""
    kept = clean_or_null(F.col(text))
    return df.agg(
        F.count_distinct(source).alias("files_processed"),
        F.count(F.lit(1)).alias("rows_read"),
        F.count(kept).alias("lines_kept"),
    )


def corpus_stats(lines: DataFrame, text: str = "value") -> DataFrame:
    """Rows, lines and bytes a text file of these rows would have."""
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.size(F.split(text, "\n"))), F.lit(0)).cast("long").alias("lines"),
        F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0)).cast("long").alias("bytes"),
    ).withColumn("megabytes", F.round(F.col("bytes") / 1048576, 6))


def manifest_counts(df: DataFrame, source: Column) -> DataFrame:
    """Sentences per manifest and, under a null name, in total."""
    return df.select(source.alias("manifest")).rollup("manifest").agg(
        F.count(F.lit(1)).alias("sentences")
    )


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Word frequency table; counts are summed per task before the shuffle."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def _counted(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            words.update((text.as_py() or "").split())
            if len(words) >= WORDS_PER_BATCH:
                yield _counted(words)
                words.clear()
    if words:
        yield _counted(words)


def split_word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Frequency of the whitespace-separated words of a text column.

    A task sums up its words, of which only the distinct ones leave it; ``str.split`` cuts at the code points
    that :func:`corpusloom.functions.text.split_words` cuts at.
    """
    words = df.select(text).mapInArrow(_count_words, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def marked_word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Frequency of marked words, the input of every trainer."""
    return split_word_counts(df, text).select(F.concat(F.lit(WORD_MARK), "word").alias("word"), "n")


def recount(words: DataFrame, parts: Column) -> DataFrame:
    """Frequency of the parts of each word, cut once per distinct word."""
    return words.select(F.explode(parts).alias("word"), "n").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def segment_counts(
    df: DataFrame, text: str = "text", split_digits: bool = False, split_scripts: bool = True,
    symbols: Sequence[str] = (),
) -> DataFrame:
    """Frequency of word segments, as the subword trainers see them."""
    words = marked_word_counts(df, text)
    return recount(words, cut_word(F.col("word"), split_digits, split_scripts, symbols))


def bert_word_counts(df: DataFrame, text: str = "text", lowercase: bool = True) -> DataFrame:
    """Frequency of normalised words and punctuation signs."""
    words = split_word_counts(df, text)
    return recount(words, bert_words(bert_normalize(F.col("word"), lowercase)))


def char_counts(words: DataFrame) -> DataFrame:
    """Character frequencies of a word table, the word mark included."""
    return words.select(F.explode(F.split("word", "")).alias("ch"), "n").groupBy("ch").agg(
        F.sum("n").alias("n")
    )


def char_coverage(words: DataFrame, coverage: float = 0.9995) -> DataFrame:
    """Characters by frequency with the running share, and whether the coverage needs them.

    The un-partitioned window runs over distinct characters only; Unicode bounds them.
    """
    counts = char_counts(words)
    every = Window.partitionBy()
    by_rank = Window.orderBy(F.desc("n"), "ch")
    before = by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select(
        "ch", "n", F.row_number().over(by_rank).alias("rank"),
        F.sum("n").over(before).alias("running"), F.sum("n").over(every).alias("total"),
    )
    share = F.col("running") / F.col("total")
    needed = (F.col("running") - F.col("n")) < F.lit(coverage) * F.col("total")
    return ranked.select("ch", "n", "rank", F.round(share, 9).alias("share"), needed.alias("covered"))


def dataset_hours(df: DataFrame, key: str, duration: str = "duration") -> DataFrame:
    """Rows and hours per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), (F.sum(duration) / 3600).alias("hours")
    )


def best_k_runs(df: DataFrame, group: str, metric: str, tie: str, k: int = 3) -> DataFrame:
    """The ``k`` lowest metrics per group.

    Spark's window group limit drops rows beyond rank ``k`` in each task before the shuffle, so a
    hot group sends at most ``k`` rows per task.
    """
    order = Window.partitionBy(group).orderBy(F.col(metric), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def token_length_stats(encoded: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """Distribution of encoded lengths per key."""
    length = F.size(ids)
    return encoded.groupBy(key).agg(
        F.count(F.lit(1)).alias("texts"),
        F.sum(length).alias("tokens"),
        F.min(length).alias("shortest"),
        F.max(length).alias("longest"),
        F.round(F.avg(length), 6).alias("average"),
        F.percentile_approx(length, F.lit(0.5), F.lit(10000)).alias("median"),
    )

