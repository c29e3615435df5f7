"""Greedy pair merging as rounds of Spark jobs over a word table.

The word table stays on the cluster, in blocks with an inverted index from pairs to words. The driver
holds counts of the first ``TRACKED_PAIRS`` pairs in rank order and picks in each round a batch of
merges that gives the same result as one merge at a time. One job per round applies the batch to the
words that hold its pairs, returns the change of the pair counts and which of the next candidates
share a symbol somewhere.

Blocks are files of the shared folder where that is a mounted file system, and tasks read only the words
they look up; on other stores they are cached rows. The index is that of the last rewrite of the table.
A pair with a symbol learned since then can only be in words that held the pair this symbol came from, so
these are looked up; merges since the rewrite are applied to the words found, never to the others.

Pairs beyond the tracked ones rank after the last of them by count, length and piece, also where
counts are tied, and never move up; when the tracked ones are used up they are counted again.

Why a batch is exact. Merging (a, b) changes only pairs that share the middle symbol of an actual
``x a b`` or ``a b y``. New pairs made there never occur more often than the old pair they replace.
So candidates may be taken in rank order until one truly overlaps a pair already taken. Between old
symbols an overlap never appears later, so "no overlap" measured in an earlier round still holds.
Pairs not measured together count as overlapping when their symbols allow it. Among equal counts a
new pair could still win on length; such candidates wait for the next round.
"""

from __future__ import annotations

import heapq
import os
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.vocab.symbols import (
    CODE_POINTS, Batch, IndexedBlock, advance, in_one, indexed, pack, records, spell, summed, unpack,
)
from corpusloom.session import drop_path, local_path, scratch_path, shared_dir, spread_words

TRACKED_PAIRS = 200_000
# Pairs that are compared for overlaps, and how many where the first ones are tied beyond that. Ties
# wider still are merged one pair a round.
WATCHED_PAIRS, WATCHED_TIES = 384, 4096
ROUNDS_PER_TABLE = 64
# The table is rewritten sooner when the words looked up since are so many times its words.
LOOKED_UP = 1
WORDS_PER_PARTITION = 100_000
# Up to this many tasks send their sums to the driver without a shuffle in between.
FEW_TASKS = 32

_STATE = "symbols array<int>, n long"
_CHANGES = "kind int, first int, second int, value long"
_DELTA, _OVERLAP, _LOOKED = 0, 1, 2


@dataclass
class MergeOptions:
    """Rules of a merge run."""

    max_length: int = 16
    min_count: int = 1
    skip_known_pieces: bool = True
    inner_mark: str = ""


@dataclass
class _Ranking:
    """Tracked pair counts on the driver, ranked by count, piece length and piece."""

    options: MergeOptions
    names: dict[int, str] = field(default_factory=dict)
    counts: dict[int, int] = field(default_factory=dict)
    heap: list = field(default_factory=list)
    known: set[str] = field(default_factory=set)
    # Count, length and piece of the last tracked pair; None if all pairs are tracked.
    floor: tuple[int, int, str] | None = None

    def name(self, symbol: int) -> str:
        known = self.names.get(symbol)
        if known is not None:
            return known
        inner = symbol >= CODE_POINTS
        return (self.options.inner_mark if inner else "") + chr(symbol % CODE_POINTS)

    def piece(self, code: int) -> str:
        left, right = unpack(code)
        return self.name(left) + self.name(right).removeprefix(self.options.inner_mark)

    def length(self, piece: str) -> int:
        return len(piece.removeprefix(self.options.inner_mark))

    def set_count(self, code: int, count: int) -> None:
        self.counts[code] = count
        piece = self.piece(code)
        if count >= self.options.min_count and self.length(piece) <= self.options.max_length:
            heapq.heappush(self.heap, (-count, self.length(piece), piece, code))

    def best(self, n: int) -> list[tuple]:
        """Up to ``n`` current entries in rank order; they stay in the ranking."""
        found = []
        while self.heap and len(found) < n:
            entry = heapq.heappop(self.heap)
            current = self.counts.get(entry[3]) == -entry[0]
            if current and not (found and found[-1] == entry):
                found.append(entry)
        for entry in found:
            heapq.heappush(self.heap, entry)
        return found

    def watched(self) -> tuple[list[tuple], bool]:
        """The entries to compare, and whether they are all there are."""
        found = self.best(WATCHED_PAIRS)
        if len(found) < WATCHED_PAIRS or found[0][0] != found[-1][0]:
            return found, len(found) < WATCHED_PAIRS
        found = self.best(WATCHED_TIES)
        return found, len(found) < WATCHED_TIES


class _Chosen:
    """Merges of one batch and the test whether a further pair overlaps one of them."""

    def __init__(self, measured: set[int], overlapping: set[tuple[int, int]]):
        self.measured, self.overlapping = measured, overlapping
        self.by_left, self.by_right = defaultdict(list), defaultdict(list)

    def add(self, code: int) -> None:
        left, right = unpack(code)
        self.by_left[left].append(code)
        self.by_right[right].append(code)

    def _touch(self, first: int, second: int) -> bool:
        if first in self.measured and second in self.measured:
            return (first, second) in self.overlapping
        return True

    def met_by(self, code: int) -> list[int]:
        """Chosen pairs that may share a symbol with ``code`` in some word."""
        left, right = unpack(code)
        after = [c for c in self.by_left.get(right, ()) if c != code and self._touch(code, c)]
        before = [c for c in self.by_right.get(left, ()) if c != code and self._touch(c, code)]
        return after + before


def _select(ranking: _Ranking, want: int, measured: set[int], overlapping: set) -> list[tuple]:
    """The longest safe batch of merges, in rank order."""
    options = ranking.options
    found, complete = ranking.watched()
    edge = 0 if complete else -found[-1][0]
    chosen = _Chosen(measured, overlapping)
    batch, pieces, blocked = [], set(), []
    for entry in found:
        count, code = -entry[0], entry[3]
        if ranking.floor and entry[:3] > ranking.floor:
            break
        if chosen.met_by(code):
            break
        if options.skip_known_pieces and (entry[2] in ranking.known or entry[2] in pieces):
            blocked.append(code)
            continue
        batch.append(entry)
        pieces.add(entry[2])
        chosen.add(code)
        # Merging a pair of equal symbols makes a pair of the same count in runs of three.
        equal = code >> 32 == code & 0xFFFFFFFF
        if equal or len(batch) >= want or any(chosen.met_by(b) for b in blocked):
            break
    # Equal counts: the shortest piece that an overlapped pair of that count could turn into.
    born: dict[int, int] = {}
    for entry in found:
        met = chosen.met_by(entry[3])
        if met:
            start, end = unpack(entry[3])
            for other in met:
                left, right = unpack(other)
                added = [right] * (left == end) + [left] * (right == start)
                size = entry[1] + min(ranking.length(ranking.name(s)) for s in added)
                if size <= options.max_length:
                    born[-entry[0]] = min(size, born.get(-entry[0], size))
    safe = []
    for entry in batch:
        count = -entry[0]
        if safe and (count <= edge or entry[1] >= born.get(count, 1 << 30)):
            break
        safe.append(entry)
    return safe


class MergeTrainer:
    """Learns merges over a table (word string, n bigint)."""

    def __init__(
        self, spark: SparkSession, words: DataFrame, options: MergeOptions,
        covered: np.ndarray | None = None,
    ):
        self.spark, self.options = spark, options
        self.ranking = _Ranking(options)
        self.merges: list[tuple[str, int]] = []
        self.rounds = 0
        self._pending: list[Batch] = []
        self._origin: dict[int, int] = {}
        self._next = 2 * CODE_POINTS
        self._path: str | None = None
        self._files: list[str] = []
        self._in_files = local_path(spark, shared_dir(spark)) is not None
        self._rows = self._tasks = self._looked = 0
        self._state: DataFrame | None = None
        inner = CODE_POINTS if options.inner_mark else 0

        def spelled(batches):
            for batch in batches:
                if batch.num_rows:
                    words = np.array(batch.column("word").to_pylist(), dtype=object)
                    weight = batch.column("n").to_numpy(zero_copy_only=False)
                    yield spell(words, weight, covered, inner).to_arrow()

        self._store(words.select("word", "n").mapInArrow(spelled, _STATE))

    def _store(self, state: DataFrame) -> None:
        """Write the word table to the shared folder and index it in blocks of about equal size."""
        path = scratch_path(self.spark, "merge-state")
        state.write.parquet(path)
        stored = self.spark.read.schema(_STATE).parquet(path)
        self._rows = self._rows or stored.count()
        stored = spread_words(stored, self._rows, WORDS_PER_PARTITION)
        make = indexed(2 * WORDS_PER_PARTITION)
        if self._in_files:
            self._write(stored, make)
            drop_path(self.spark, path)
            return

        def rows(batches):
            for block in make(batches):
                yield block.to_arrow()

        # A lost executor makes its blocks again.
        blocks = stored.mapInArrow(rows, IndexedBlock.SCHEMA).persist()
        blocks.count()
        self._tasks = -(-self._rows // WORDS_PER_PARTITION)
        self._replace(blocks, path, [])

    def _write(self, rows: DataFrame, make: Callable) -> None:
        """Keep the blocks made of some rows as files, which tasks map instead of receiving them."""
        path = scratch_path(self.spark, "merge-blocks")
        folder = local_path(self.spark, path)

        def written(batches):
            os.makedirs(folder, exist_ok=True)
            for block in make(batches):
                file = f"{folder}/{uuid.uuid4().hex}"
                block.save(file)
                yield pa.RecordBatch.from_arrays([pa.array([file])], ["file"])

        files = rows.mapInArrow(written, "file string").toArrow().column("file").to_pylist()
        # A round looks up little in each block, so a task takes all blocks of its core.
        self._tasks = max(1, min(len(files), self.spark.sparkContext.defaultParallelism))
        self._replace(self.spark.range(0, len(files), 1, self._tasks), path, files)

    def _replace(self, state: DataFrame, path: str, files: list[str]) -> None:
        if self._state is not None:
            self._free()
        self._state, self._path, self._files = state, path, files
        self._pending, self._origin, self._looked = [], {}, 0

    def _free(self) -> None:
        if not self._in_files:
            self._state.unpersist()
        drop_path(self.spark, self._path)

    def _reader(self) -> Callable:
        """A function from batches of the state to its blocks."""
        if not self._in_files:
            return IndexedBlock.read
        files = self._files

        def run(batches):
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    yield IndexedBlock.load(files[k])

        return run

    def _restore(self) -> None:
        """Fold the merges since the last write into a new table."""
        pending, read = self._pending, self._reader()

        def apply(batches):
            for block in read(batches):
                yield advance(block.whole(), pending)

        def rows(batches):
            for block in apply(batches):
                yield block.to_arrow()

        if self._in_files:
            self._write(self._state, lambda batches: map(IndexedBlock.of, apply(batches)))
        else:
            self._store(self._state.mapInArrow(rows, _STATE))

    def _indexed_pair(self, code: int) -> int:
        """A pair of the index that every word with this pair held when the index was made."""
        left, right = unpack(code)
        return self._origin.get(left, self._origin.get(right, code))

    def _count_pairs(self) -> None:
        """Track the first pairs in rank order, of those that may be merged, from a full count."""
        longest, ranking = self.options.max_length, self.ranking
        names = {s: ranking.names[s] for s in range(2 * CODE_POINTS, self._next)}
        sizes = np.array([1, *map(ranking.length, names.values())], np.int64)
        known = ranking.known if self.options.skip_known_pieces else set()
        ranker = _Ranking(self.options, names)

        def size(symbols):
            return sizes[np.maximum(symbols - 2 * CODE_POINTS + 1, 0)]

        read = self._reader()

        def count(batches):
            codes, values = in_one([block.whole().pair_weights() for block in read(batches)])
            short = size(codes >> 32) + size(codes & 0xFFFFFFFF) <= longest
            yield records(_DELTA, codes[short], values[short])

        def named(batches):
            for batch in batches:
                pairs = zip(batch.column("first").to_pylist(), batch.column("second").to_pylist())
                pieces = [ranker.piece(pack(*pair)) for pair in pairs]
                new = pa.array([p not in known for p in pieces])
                lengths = pa.array([ranker.length(p) for p in pieces], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, lengths, pa.array(pieces, pa.string()), new],
                    ["first", "second", "value", "length", "piece", "new"])

        totals = self._state.mapInArrow(count, _CHANGES).groupBy("first", "second").agg(F.sum("value").alias("value"))
        totals = totals.filter(F.col("value") >= self.options.min_count)
        path = scratch_path(self.spark, "pair-counts")
        totals.write.parquet(path)
        totals = self.spark.read.schema("first int, second int, value long").parquet(path)
        every, wide, rows = totals.count(), TRACKED_PAIRS, []
        while not rows and every:
            # Only pairs as frequent as the last one that may be tracked need names to be ranked.
            edge = totals.orderBy(F.desc("value")).limit(wide).agg(F.min("value")).first()[0] if every > wide else 0
            ranked = totals.filter(F.col("value") >= edge).mapInArrow(
                named, "first int, second int, value long, length int, piece string, new boolean")
            ranked = ranked.filter("new").orderBy(F.desc("value"), "length", "piece").limit(TRACKED_PAIRS)
            rows = ranked.select("first", "second", "value", "length", "piece").toArrow().to_pylist()
            if every <= wide:
                break
            wide *= 4  # all of these spell pieces that are known
        drop_path(self.spark, path)
        ranking.counts, ranking.heap, ranking.floor = {}, [], None
        if len(rows) == TRACKED_PAIRS:
            ranking.floor = -rows[-1]["value"], rows[-1]["length"], rows[-1]["piece"]
        elif every and edge:
            ranking.floor = -edge, 1 << 30, ""
        for row in rows:
            ranking.set_count(pack(row["first"], row["second"]), row["value"])

    def _run_round(self, watched: np.ndarray, fresh: np.ndarray) -> tuple[tuple, set[tuple[int, int]]]:
        """Apply the newest batch on the cluster; pair count changes, and overlaps of ``fresh`` watched pairs with others."""
        earlier, newest = self._pending[:-1], self._pending[-1]
        changed, looked_at = (
            np.unique(np.array([self._indexed_pair(c) for c in codes.tolist()], np.int64)) for codes in (newest[0], fresh))
        read = self._reader()

        def step(batches):
            changes, shared, looked = [], [], 0
            for block in read(batches):
                held, seen = block.holding(changed), block.holding(looked_at)
                looked += len(held) + len(seen)
                before = advance(block.take(held), earlier)
                after, touched = before.merged(newest)
                if touched.any():
                    gained, lost = after.only(touched).pair_weights(), before.only(touched).pair_weights()
                    changes += [gained, (lost[0], -lost[1])]
                near = advance(block.take(seen), [*earlier, newest])
                shared.append(near.overlaps(watched))
            codes, values = in_one(changes)
            yield records(_DELTA, codes[values != 0], values[values != 0])
            pairs = np.unique(np.concatenate(shared)) if shared else np.empty(0, np.int64)
            yield records(_OVERLAP, pairs, np.ones(len(pairs)))
            yield records(_LOOKED, np.zeros(1, np.int64), np.array([looked]))

        found = self._state.mapInArrow(step, _CHANGES)
        if self._tasks > FEW_TASKS:
            found = found.groupBy("kind", "first", "second").agg(F.sum("value").alias("value"))
        # Bounded by the vocabulary: pairs with a symbol of the batch, and pairs of watched pairs.
        table = found.toArrow()
        kind, first, second, value = (
            table.column(c).to_numpy().astype(np.int64) for c in ("kind", "first", "second", "value")
        )
        delta, shared = kind == _DELTA, kind == _OVERLAP
        changes = summed((first[delta] << 32) | second[delta], value[delta])
        overlapping = set(zip(watched[first[shared]].tolist(), watched[second[shared]].tolist()))
        self._looked += int(value[kind == _LOOKED].sum())
        return changes, overlapping

    def run(self, wanted: int) -> list[tuple[str, int]]:
        """Learn up to ``wanted`` merges: (piece, count) in order; fewer when pairs run out."""
        ranking = self.ranking
        if wanted > 0:
            self._count_pairs()
        measured: set[int] = set()
        overlapping: set[tuple[int, int]] = set()
        while len(self.merges) < wanted:
            batch = _select(ranking, wanted - len(self.merges), measured, overlapping)
            if not batch:
                if not ranking.floor:
                    break
                self._restore()
                self._count_pairs()
                if not ranking.heap:
                    break
                continue
            first_new = self._next
            for entry in batch:
                ranking.names[self._next] = entry[2]
                ranking.known.add(entry[2])
                self.merges.append((entry[2], -entry[0]))
                self._next += 1
            codes = np.array([e[3] for e in batch], np.int64)
            for symbol, code in zip(range(first_new, self._next), codes.tolist()):
                self._origin[symbol] = self._indexed_pair(code)
            order = np.argsort(codes)
            self._pending.append((codes[order], np.arange(first_new, self._next)[order]))
            if len(self.merges) >= wanted:
                break
            done = set(codes.tolist())
            for code in done:
                ranking.counts.pop(code, None)
            watched = np.sort(np.array(
                [e[3] for e in ranking.watched()[0] if e[3] not in done], np.int64
            ))
            # Of pairs measured before, no new overlap can arise. Some may be gone: seen once per rewrite.
            again = self.rounds % ROUNDS_PER_TABLE == 0
            fresh = watched if again else np.array([c for c in watched.tolist() if c not in measured], np.int64)
            changes, found = self._run_round(watched, fresh)
            measured = set(watched.tolist())
            overlapping = found if again else found | {o for o in overlapping if o[0] in measured and o[1] in measured}
            for code, value in zip(changes[0].tolist(), changes[1].tolist()):
                left, right = unpack(code)
                if code in done:
                    continue
                newborn = left >= first_new or right >= first_new
                if newborn and value > 0 and (not ranking.floor or value >= -ranking.floor[0]):
                    ranking.set_count(code, value)
                elif not newborn and code in ranking.counts:
                    ranking.set_count(code, ranking.counts[code] + value)
            self.rounds += 1
            if len(self._pending) >= ROUNDS_PER_TABLE or self._looked > LOOKED_UP * self._rows:
                self._restore()
        return self.merges

    def close(self) -> None:
        """Free the cached word table and remove it from the shared folder."""
        if self._state is not None:
            self._free()
            self._state = None


def learn_merges(
    spark: SparkSession, words: DataFrame, wanted: int, options: MergeOptions,
    covered: np.ndarray | None = None,
) -> list[tuple[str, int]]:
    """Merges of a word table, as (piece, count) in order."""
    trainer = MergeTrainer(spark, words, options, covered)
    try:
        return trainer.run(wanted)
    finally:
        trainer.close()
