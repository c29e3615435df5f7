"""Vocabulary tables: reserved rows, byte pieces, assembly, comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.stats import char_coverage
from corpusloom.session import SMALL_TABLE_ROWS
from corpusloom.sources.schema import VOCABULARY

# Pieces with ids 0 to 3, and the special pieces of WordPiece.
RESERVED = ("<unk>", "<s>", "</s>", "<pad>")
WORDPIECE_SPECIAL = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
_RESERVED_KINDS = ("unknown", "control", "control", "control")


def byte_pieces() -> list[str]:
    """The 256 pieces that stand for single bytes."""
    return [f"<0x{value:02X}>" for value in range(256)]


def head_rows(
    control: Sequence[str] = (), user: Sequence[str] = (), byte_fallback: bool = False
) -> list[tuple[str, float, str]]:
    """Rows in front of the learned pieces: reserved, control, user, then bytes."""
    rows = [(p, 0.0, k) for p, k in zip(RESERVED, _RESERVED_KINDS)]
    rows += [(p, 0.0, "control") for p in control if p not in RESERVED]
    rows += [(p, 0.0, "user") for p in user]
    if byte_fallback:
        rows += [(p, 0.0, "byte") for p in byte_pieces()]
    return rows


def check_size(vocab_size: int) -> None:
    """A vocabulary is held by the driver and broadcast, so its size is bounded."""
    if not 0 < vocab_size <= SMALL_TABLE_ROWS:
        raise ValueError(f"vocab_size must lie in 1..{SMALL_TABLE_ROWS}")


def vocabulary(spark: SparkSession, rows: Iterable[tuple[str, float, str]]) -> DataFrame:
    """Vocabulary table from (piece, score, kind) rows in id order."""
    numbered = [(i, p, float(s), k) for i, (p, s, k) in enumerate(rows)]
    return spark.createDataFrame(numbered, VOCABULARY)


def covered_characters(words: DataFrame, coverage: float) -> list[tuple[str, int]]:
    """Characters the coverage needs with their counts, most frequent first.

    Bounded by the number of Unicode characters.
    """
    table = char_coverage(words, coverage).filter("covered").orderBy("rank")
    return [(r["ch"], r["n"]) for r in table.select("ch", "n").collect()]


def code_points(characters: Iterable[str]) -> np.ndarray:
    """Sorted code points of single characters."""
    return np.array(sorted(map(ord, characters)), np.int64)


def vocab_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every piece of two vocabularies and whether it was kept, moved, added or removed."""
    before = old.select("piece", F.col("id").alias("old_id"))
    after = new.select("piece", F.col("id").alias("new_id"))
    status = (
        F.when(F.col("old_id").isNull(), "added").when(F.col("new_id").isNull(), "removed")
        .when(F.col("old_id") == F.col("new_id"), "kept").otherwise("moved")
    )
    return before.join(after, "piece", "full_outer").withColumn("status", status)


def needs_new_decoder(old: DataFrame, new: DataFrame) -> bool:
    """Whether a model with the old vocabulary has to be re-sized for the new one."""
    return old.count() != new.count()
