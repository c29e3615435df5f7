"""Character and word vocabularies: one aggregation each, no training loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.stats import char_coverage
from corpusloom.operators.vocab.table import check_size, head_rows, vocabulary
from corpusloom.session import stored_words


def char_scores(words: DataFrame, coverage: float = 1.0) -> DataFrame:
    """Covered characters by frequency, scored with the log of their share of all characters."""
    table = char_coverage(words, coverage)
    total = F.sum("n").over(Window.partitionBy())
    return table.withColumn("score", F.log(F.col("n") / total)).filter("covered").select(
        "rank", F.col("ch").alias("piece"), "n", "score"
    )


def word_scores(words: DataFrame, room: int) -> DataFrame:
    """The ``room`` most frequent words, scored with the log of their share of all words.

    The total is one aggregate row; the ranking window sees only the top-k.
    """
    total = words.agg(F.sum("n").alias("total")).first()["total"] or 1
    top = words.orderBy(F.desc("n"), "word").limit(room)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "word"))
    return top.select(
        rank.alias("rank"), F.col("word").alias("piece"), "n",
        F.log(F.col("n") / F.lit(total)).alias("score"),
    )


def _assemble(
    spark: SparkSession, scored: DataFrame, vocab_size: int, head: list, strict: bool
) -> DataFrame:
    room = vocab_size - len(head)
    rows = scored.filter(F.col("rank") <= room).orderBy("rank").collect()
    if strict and len(rows) < room:
        raise ValueError(f"the corpus supports {len(rows) + len(head)} pieces, not {vocab_size}")
    known = {piece for piece, _, _ in head}
    learned = [(r["piece"], r["score"], "learned") for r in rows if r["piece"] not in known]
    return vocabulary(spark, [*head, *learned])


def train_char(
    spark: SparkSession, words: DataFrame, vocab_size: int, coverage: float = 1.0,
    control: Sequence[str] = (), user: Sequence[str] = (), byte_fallback: bool = False,
) -> DataFrame:
    """Character vocabulary; holds fewer pieces when there are fewer characters."""
    check_size(vocab_size)
    head = head_rows(control, user, byte_fallback)
    return _assemble(spark, char_scores(words, coverage), vocab_size, head, strict=False)


def train_word(
    spark: SparkSession, words: DataFrame, vocab_size: int, strict: bool = False,
    control: Sequence[str] = (), user: Sequence[str] = (), byte_fallback: bool = False,
) -> DataFrame:
    """Word vocabulary."""
    check_size(vocab_size)
    head = head_rows(control, user, byte_fallback)
    with stored_words(spark, words) as stored:
        scored = word_scores(stored, vocab_size - len(head))
        return _assemble(spark, scored, vocab_size, head, strict)
