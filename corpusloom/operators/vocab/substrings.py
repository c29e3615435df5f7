"""Weights of all maximal substrings of a word table, from sorted suffixes."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Suffixes a task sums up before it passes them on.
SUFFIXES_PER_BATCH = 200_000

_SUFFIXES = "suffix string, n long"
_NODES = "piece string, n long, low string, high string, ends boolean"


def _suffixes(longest: int, covered: str | None):
    cut = re.compile(f"[^{re.escape(covered)}]+") if covered else None

    def rows(sums: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["suffix", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = defaultdict(int)
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for part in cut.split(word) if cut else (word,):
                    for start in range(len(part)):
                        sums[part[start : start + longest]] += n
                        if len(sums) >= SUFFIXES_PER_BATCH:
                            yield rows(sums)
                            sums.clear()
        if sums:
            yield rows(sums)

    return run


def _common(a: str, b: str) -> int:
    for k, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return k
    return min(len(a), len(b))


class _Node:
    """An interval of neighbouring suffixes with a common prefix: its depth, weight, and least and greatest next character."""

    __slots__ = ("depth", "n", "low", "high", "ends")

    def __init__(self, depth: int, n: int, ends: bool):
        self.depth, self.n, self.low, self.high, self.ends = depth, n, None, None, ends

    def add(self, n: int, following: str) -> None:
        self.n += n
        self.low = following if self.low is None else min(self.low, following)
        self.high = following if self.high is None else max(self.high, following)


def _intervals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The maximal prefixes of a partition's sorted suffixes.

    Prefixes of the first and of the last suffix may go on in a neighbouring partition, so all of them
    are given, with what is known of them here.
    """
    out: list[tuple] = []
    stack = [_Node(0, 0, False)]
    before = None

    def close(depth: int, at_end: bool) -> None:
        """Close the intervals deeper than ``depth``."""
        while stack[-1].depth > depth:
            node = stack.pop()
            out.append((before[: node.depth], node.n, node.low, node.high, node.ends))
            if stack[-1].depth < depth:
                stack.append(_Node(depth, 0, False))
            parent = stack[-1]
            parent.add(node.n, before[parent.depth])
            if at_end:
                for size in range(parent.depth + 1, node.depth):
                    out.append((before[:size], node.n, before[size], before[size], False))

    def rows() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["piece", "n", "low", "high", "ends"])

    for batch in batches:
        for suffix, n in zip(batch.column("suffix").to_pylist(), batch.column("n").to_pylist()):
            if before is None:
                stack += [_Node(depth, 0, False) for depth in range(1, len(suffix))]
            else:
                close(_common(before, suffix), False)
            stack.append(_Node(len(suffix), n, True))
            before = suffix
        yield rows()
        out.clear()
    if before is not None:
        close(0, True)
        yield rows()


def maximal_substrings(words: DataFrame, longest: int, covered: str | None = None) -> DataFrame:
    """``(piece, n)``: the weight of every maximal substring of two to ``longest`` characters.

    A substring is maximal if no longer one that starts with it has the same weight; a shorter one says
    nothing that the longer one does not. Every place of every word gives one suffix, cut to ``longest``
    characters and, with ``covered``, at characters outside it. Equal suffixes are summed, all are sorted
    by range, and each partition walks its neighbours' common prefixes with one stack. A word of any
    length costs one suffix per character.
    """
    suffixes = words.select("word", "n").mapInArrow(_suffixes(longest, covered), _SUFFIXES)
    suffixes = suffixes.groupBy("suffix").agg(F.sum("n").alias("n"))
    nodes = suffixes.repartitionByRange("suffix").sortWithinPartitions("suffix").mapInArrow(_intervals, _NODES)
    whole = nodes.filter(F.length("piece") > 1).groupBy("piece").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("ends").alias("ends"))
    return whole.filter("n > 1 AND (ends OR low < high)").select("piece", "n")
