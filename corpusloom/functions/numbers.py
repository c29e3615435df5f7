"""Numeric rules shared by sampling and planning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def stride_of(percent: float) -> int:
    """Whole-number stride of a percentage; 60 % gives 1, so it keeps every row."""
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in (0, 100]")
    return int(100 / percent)


def head_target(total: int, percent: float) -> int:
    """Rows in the leading share of a corpus, at least one."""
    return total if percent >= 100 else max(1, int(total * (percent / 100.0)))


def shards_to_take(total: int, percent: float) -> int:
    """Leading shards that cover a percentage, at least one."""
    return max(1, math.ceil(total * (min(100.0, max(0.0, percent)) / 100.0)))


def coerce_duration(raw: Column) -> Column:
    """Seconds as double; 0.0 where the value is missing or cannot be parsed."""
    return F.coalesce(raw.try_cast("double"), F.lit(0.0))


def run_name(
    kind: str, vocab_size: int, model_type: str | None = None, max_length: int = -1,
    pad: bool = False, bos: bool = False, eos: bool = False,
) -> str:
    """Folder name of a trained vocabulary, from its options."""
    if kind == "wpe":
        return f"tokenizer_{kind}_v{vocab_size}"
    name = f"tokenizer_{kind}_{model_type}_v{vocab_size}"
    if max_length > 0:
        name += f"_max_{max_length}"
    for on, tag in ((pad, "pad"), (bos, "bos"), (eos, "eos")):
        name += f"_{tag}" if on else ""
    return name
