"""Byte-pair and WordPiece vocabularies on top of the merge rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.vocab.merges import MergeOptions, learn_merges
from corpusloom.operators.vocab.table import (
    WORDPIECE_SPECIAL, check_size, code_points, covered_characters, head_rows, vocabulary,
)
from corpusloom.session import stored_words

# Fixed value: longest piece when none is asked for.
DEFAULT_MAX_LENGTH = 16


def train_bpe(
    spark: SparkSession, words: DataFrame, vocab_size: int = 8000, coverage: float = 0.9995,
    max_piece_length: int = DEFAULT_MAX_LENGTH, strict: bool = False,
    control: Sequence[str] = (), user: Sequence[str] = (), byte_fallback: bool = False,
) -> DataFrame:
    """BPE vocabulary: reserved rows, merges by rank, then the covered characters by frequency.

    ``words`` is a word-count table (word, n). Fewer merges than asked for give a smaller
    vocabulary, or an error when ``strict``.
    """
    check_size(vocab_size)
    head = head_rows(control, user, byte_fallback)
    options = MergeOptions(max_length=max_piece_length if max_piece_length > 0 else DEFAULT_MAX_LENGTH)
    with stored_words(spark, words) as stored:
        characters = covered_characters(stored, coverage)
        room = vocab_size - len(head) - len(characters)
        if room < 0:
            raise ValueError(f"vocab_size must be at least {vocab_size - room} for this alphabet")
        covered = code_points(c for c, _ in characters)
        merges = learn_merges(spark, stored, room, options, covered)
    if strict and len(merges) < room:
        raise ValueError(f"the corpus supports {vocab_size - room + len(merges)} pieces")
    pieces = [p for p, _ in merges] + [c for c, _ in characters]
    return vocabulary(spark, [*head, *((p, -float(i), "learned") for i, p in enumerate(pieces))])


def train_wordpiece(
    spark: SparkSession, words: DataFrame, vocab_size: int = 1024, min_count: int = 2,
    alphabet_limit: int = 1000,
) -> DataFrame:
    """WordPiece vocabulary with ``##`` continuation pieces, over unmarked normalised words.

    Special pieces come first, then single characters, then merges seen ``min_count`` times or
    more. Words keep only characters of the alphabet, as for the coverage of BPE.
    """
    check_size(vocab_size)
    options = MergeOptions(
        max_length=1 << 20, min_count=min_count, skip_known_pieces=False, inner_mark="##"
    )
    head = [(p, 0.0, "control") for p in WORDPIECE_SPECIAL]
    with stored_words(spark, words) as stored:
        characters = covered_characters(stored, 1.0)[:alphabet_limit]
        alphabet = sorted(c for c, _ in characters)
        inside = {r["ch"] for r in _inner_characters(stored).collect()}
        inner = [f"##{c}" for c in alphabet if c in inside]
        room = vocab_size - len(head) - len(alphabet) - len(inner)
        merges = learn_merges(spark, stored, max(0, room), options, code_points(alphabet))
    pieces = dict.fromkeys([*alphabet, *inner, *(p for p, _ in merges)])
    return vocabulary(spark, [*head, *((p, 0.0, "learned") for p in pieces)])


def _inner_characters(words: DataFrame) -> DataFrame:
    """Characters seen after the first place of a word."""
    return words.selectExpr("explode(split(substring(word, 2), '')) AS ch").filter("ch <> ''").distinct()
