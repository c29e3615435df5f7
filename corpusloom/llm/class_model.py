"""Brown class-based bigrams: exchange clustering, class transitions, word emissions, text scores."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import as_bytes, held_out, mapped, slices, store, table
from corpusloom.llm.shingles import SPACE, mix, words_and_endings

FOLDS, HELD_OUT_FOLD = 7, 2
CLASSES = 48
ROUNDS = 3
# A word with at least one in 2**20 of all training tokens is a unit of its own in the exchange, so
# there are at most 2**20 such words. Rarer words with the same ending are exchanged together, in
# 2**14 cells of endings. Counts and emissions are kept for every word, however rare.
UNIT_SHARE = 1 << 20
ENDINGS = 1 << 14
# Pseudo-counts a class transition takes from the class shares.
TRANSITION_STRENGTH = 20.0
# The token after each text's last word, and its class, in which it is alone.
END = np.uint64(0x0E4D0E4D0E4D0E4D)
END_CLASS = 0
# Units that choose at once, units per task of a round, and the most tasks.
_TOGETHER, UNITS_PER_TASK, MOST_TASKS = 8, 20_000, 64
# Units whose counts are sent as one row, their slots, and the numbers of a row: below 2**16.
UNITS_PER_BLOCK, _SLOTS = 64, 2 * CLASSES
_BLOCK = UNITS_PER_BLOCK * _SLOTS
# Neighbours a task counts together, as 32-bit numbers.
_FLUSH_NEIGHBOURS = 1 << 23
# Bytes of texts whose words are cut and hashed together.
_CHUNK_BYTES = 1 << 20


def _chunks(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    """Texts in lists of about a megabyte; a longer text is alone."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > _CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def tokens(texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and ending cells of all texts, each closed by ``END``, and the texts' token counts."""
    words, endings, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    for chunk in _chunks(texts):
        joined = b"\n".join(chunk)  # no word crosses a line end
        hashes, ending = words_and_endings(joined)
        inside = ~SPACE[np.frombuffer(joined, np.uint8)]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        if len(inside) and inside[0]:
            starts = np.concatenate(([0], starts))
        bounds = np.cumsum([0, *(len(text) + 1 for text in chunk)])
        size = np.diff(np.searchsorted(starts, bounds)) + 1
        closed = np.full(len(hashes) + len(chunk), END)
        cells = np.zeros(len(closed), np.int32)
        at = np.arange(len(hashes)) + np.repeat(np.arange(len(chunk)), size - 1)
        closed[at] = hashes
        cells[at] = mix(ending.astype(np.uint64)) % np.uint64(ENDINGS)
        words.append(closed)
        endings.append(cells)
        sizes.append(size)
    return np.concatenate(words), np.concatenate(endings), np.concatenate(sizes)


@dataclass
class Units:
    """The units of the exchange and their classes. Unit ``k`` is frequent word ``k``, those after are endings."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray

    def of(self, words: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit of every token, and whether it is a frequent word's."""
        n = len(self.words)
        at = np.minimum(np.searchsorted(self.words, words), max(n - 1, 0))
        known = self.words[at] == words if n else np.zeros(len(words), bool)
        return np.where(known, at, n + endings), known

    def class_of(self, words: np.ndarray, units: np.ndarray) -> np.ndarray:
        return np.where(words == END, END_CLASS, self.classes[units])


def count_words(train: DataFrame) -> DataFrame:
    """``(word, ending, n)``: every distinct token of all texts by its hash, with its ending cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, endings, _ = tokens(as_bytes(batch.column("text")))
            words, first, n = np.unique(words, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(endings[first]), pa.array(n)], ["word", "ending", "n"])

    counted = train.select("text").mapInArrow(run, "word long, ending int, n long")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each two consecutive bounds: the bytes of ``values`` between them."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all binary values in a row."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _bounds(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each distinct key begins, and the end."""
    return np.concatenate((np.flatnonzero(np.diff(sorted_keys, prepend=sorted_keys[:1] - 1)), [len(sorted_keys)]))


def unit_texts(train: DataFrame, units: Broadcast) -> DataFrame:
    """``units``, stored: the unit of every token of a text as 32-bit integers, the end as -1.

    Units stay when classes change, so texts are cut into words once for all rounds.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, endings, sizes = tokens(as_bytes(batch.column("text")))
        unit = np.where(words == END, -1, units.value.of(words, endings)[0]).astype("<i4")
        return pa.RecordBatch.from_arrays([_binaries(unit, np.concatenate(([0], np.cumsum(sizes))))], ["units"])

    return store(mapped(train.select("text"), run, "units binary"), "units")


def context_counts(texts: DataFrame, units: Broadcast) -> DataFrame:
    """``(unit, slots, counts)``: how often each unit of ``unit_texts`` stands after (``slot``) and before (``CLASSES + slot``) a class.

    One row per unit; slots are packed as 16-bit and counts as 64-bit integers. Unit -1 holds the class
    transitions, in slot ``CLASSES * before + after``. The ``END`` of a text also stands before its first
    word. Tasks count apart and send one row for each ``UNITS_PER_BLOCK`` units, which are added up
    block by block, so neither side holds more than its own counts or one block.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = units.value.classes
        waiting, size = [], 0
        moves = np.zeros(CLASSES * CLASSES, np.int64)

        def rows():
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            blocks = keys // _BLOCK
            bounds = _bounds(blocks)
            return slices([pa.RecordBatch.from_arrays(
                [pa.array(blocks[bounds[:-1]].astype(np.int64)), _binaries((keys % _BLOCK).astype("<u2"), bounds), _binaries(n.astype("<i8"), bounds)],
                ["block", "slots", "counts"])])

        for batch in slices(batches):
            unit = _values(batch.column("units"), "<i4")
            real = unit >= 0
            own = np.where(real, classes[unit], END_CLASS)
            # Texts follow each other: before a first word stands the end of another text, or of the last.
            before, after = np.roll(own, 1), np.roll(own, -1)
            moves += np.bincount(CLASSES * before + own, minlength=len(moves))
            placed = unit[real] * np.int32(_SLOTS)
            waiting += [placed + before[real], placed + CLASSES + after[real]]
            size += 2 * len(placed)
            if size >= _FLUSH_NEIGHBOURS:
                yield from rows()
                waiting, size = [], 0
        if size:
            yield from rows()
        found = np.flatnonzero(moves)
        if len(found):
            ends = np.array([0, len(found)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int64()), _binaries(found.astype("<u2"), ends), _binaries(moves[found].astype("<i8"), ends)],
                ["block", "slots", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, np.zeros(_BLOCK, np.int64)

        def rows():
            found = np.flatnonzero(held)
            unit, slot = (block * UNITS_PER_BLOCK + found // _SLOTS, found % _SLOTS) if block >= 0 else (np.full(len(found), -1), found)
            bounds = _bounds(unit)
            return pa.RecordBatch.from_arrays(
                [pa.array(unit[bounds[:-1]].astype(np.int64)), _binaries(slot.astype("<u2"), bounds), _binaries(held[found].astype("<i8"), bounds)],
                ["unit", "slots", "counts"])

        for batch in batches:
            for key, slot, n in zip(*(column.to_pylist() for column in batch.columns)):
                if key != block:
                    if block is not None:
                        yield rows()
                    block = key
                    held[:] = 0
                held[np.frombuffer(slot, "<u2")] += np.frombuffer(n, "<i8")  # slots of a row are distinct
        if block is not None:
            yield rows()

    sent = texts.mapInArrow(count, "block long, slots binary, counts binary")
    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(add, "unit long, slots binary, counts binary")


def _matrix(counts: DataFrame) -> np.ndarray:
    """Class transitions from the row of unit -1: ``CLASSES`` squared at the most."""
    out = np.zeros(CLASSES * CLASSES)
    for row in counts.filter("unit = -1").collect():
        out[np.frombuffer(row["slots"], "<u2")] = np.frombuffer(row["counts"], "<i8")
    return out.reshape(CLASSES, CLASSES)


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(first: np.ndarray, slot: np.ndarray, n: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For every unit the class in which it makes the class bigrams likeliest.

    Unit ``k`` has the entries from ``first[k]`` on: ``n`` neighbours in ``slot`` (a class before it, or
    ``CLASSES`` and a class after it). It is taken out of its class ``own[k]`` and put into each class
    in turn. Ties go to the smaller class; class 0 is never taken.
    """
    around = np.vstack((pairs, pairs.T))
    sizes = np.diff(np.append(first, len(slot)))
    every = np.arange(CLASSES)
    rest = around[slot] - np.where(every == np.repeat(own, sizes)[:, None], n[:, None], 0.0)
    rest = np.maximum(rest, 0.0)
    gain = np.add.reduceat(_plogp(rest + n[:, None]) - _plogp(rest), first)
    count = np.add.reduceat(np.where(slot < CLASSES, n, 0.0), first)[:, None]
    for total in (pairs.sum(1), pairs.sum(0)):
        rest = np.maximum(total - np.where(every == own[:, None], count, 0.0), 0.0)
        gain -= _plogp(rest + count) - _plogp(rest)
    gain[:, END_CLASS] = -np.inf
    return gain.argmax(1)


def smoothed(pairs: np.ndarray, left_out: float = 0.0) -> np.ndarray:
    """Class transition probabilities, drawn to the class shares; ``left_out`` is taken off every count first."""
    shares = (pairs.sum(0) + 1.0) / (pairs.sum() + CLASSES)
    counts = np.maximum(pairs - left_out, 0.0) + TRANSITION_STRENGTH * shares
    return counts / (np.maximum(pairs.sum(1, keepdims=True) - left_out, 0.0) + TRANSITION_STRENGTH)


def likelihood(pairs: np.ndarray) -> float:
    """What the classes add to the log-likelihood of the corpus, every token predicted without itself."""
    columns = pairs.sum(0)
    return float((pairs * np.log(smoothed(pairs, 1.0))).sum() - (columns * np.log(columns + 1.0)).sum())


def exchange(counts: DataFrame, units: Broadcast, pairs: Broadcast, half: int | None) -> DataFrame:
    """``(unit, class)`` after every unit, or those of one half by a hash, chose its best class once.

    A task takes its units a few at a time and moves their counts in its own copy of the class
    bigrams before the next few choose, so that units alike gather in one class instead of all
    leaving at once. Tasks do not see each other's moves; their number grows with the units.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = pairs.value.copy()
        for batch in batches:
            unit = batch.column("unit").to_numpy()
            begin = np.cumsum([0, *(len(value) // 2 for value in batch.column("slots").to_pylist())])
            slot, n = _values(batch.column("slots"), "<u2").astype(np.int64), _values(batch.column("counts"), "<i8").astype(float)
            own, chosen = units.value.classes[unit], np.empty(len(unit), np.int32)
            for k in range(0, len(unit), _TOGETHER):
                few = slice(k, min(k + _TOGETHER, len(unit)))
                low, high = begin[few.start], begin[few.stop]
                first = begin[few] - low
                chosen[few] = best_classes(first, slot[low:high], n[low:high], own[few], matrix)
                sizes = np.diff(np.append(first, high - low))
                side, at = slot[low:high] < CLASSES, slot[low:high] % CLASSES
                for classes, sign in ((own[few], -1), (chosen[few], 1)):
                    its = np.repeat(classes, sizes)
                    np.add.at(matrix, (np.where(side, at, its), np.where(side, its, at)), sign * n[low:high])
                np.maximum(matrix, 0.0, out=matrix)
            yield pa.RecordBatch.from_arrays([batch.column("unit"), pa.array(chosen)], ["unit", "class"])

    # One row of at most twice ``CLASSES`` entries for each unit.
    grouped = counts.filter("unit >= 0")
    if half is not None:
        grouped = grouped.filter(F.pmod(F.xxhash64("unit"), F.lit(2)) == half)
    tasks = min(MOST_TASKS, len(units.value.classes) // UNITS_PER_TASK + 1)
    placed = grouped.repartition(tasks, "unit").sortWithinPartitions("unit")
    return placed.mapInArrow(run, "unit long, class int")


@dataclass
class ClassModel:
    """What scoring needs beyond the word counts; its size is bounded by ``UNIT_SHARE`` and ``ENDINGS``."""

    units: Units
    transition: np.ndarray
    emission: np.ndarray
    ends: int


def fit(train: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, int, int, Broadcast]:
    """Word counts (stored), their sum N, their number V, and the class model, from all rows of ``train``.

    Units start in classes by rank. Each round counts neighbours over the whole corpus and moves
    every unit (later rounds: every other one) to its best class. Tasks move units unseen by each
    other, so a round can lose: the classes of the likeliest round are kept.
    """
    spark = train.sparkSession
    words = store(count_words(train), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = words.filter((F.col("n") * UNIT_SHARE >= total) & (F.col("word") != int(END))).select("word", "n").toPandas()
    hashes, n = head["word"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((hashes, -n))] = np.arange(len(n))
    classes = 1 + np.concatenate((rank, np.arange(ENDINGS))) % (CLASSES - 1)
    units = Units(hashes, n, classes.astype(np.int32))
    best = None
    shared = spark.sparkContext.broadcast(units)
    texts = unit_texts(train, shared)
    for k in range(rounds + 1):
        counts = store(context_counts(texts, shared), "contexts")
        pairs = _matrix(counts)
        value = likelihood(pairs)
        if best is None or value > best[0]:
            best = value, shared, pairs
        if k == rounds:
            break
        moved = exchange(counts, shared, spark.sparkContext.broadcast(pairs), None if k == 0 else k % 2).toPandas()
        classes = units.classes.copy()
        classes[moved["unit"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int32)
        units = Units(hashes, n, classes)
        shared = spark.sparkContext.broadcast(units)
    _, shared, pairs = best
    sizes = class_sizes(words, shared)
    emission = pairs.sum(0) + sizes + 1.0
    emission[END_CLASS] = pairs.sum(0)[END_CLASS] + 1.0
    ends = words.filter(F.col("word") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    model = ClassModel(shared.value, np.log10(smoothed(pairs)), np.log10(emission), ends)
    return words, total, distinct, spark.sparkContext.broadcast(model)


def class_sizes(words: DataFrame, units: Broadcast) -> np.ndarray:
    """Number of distinct words of each class."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = batch.column("word").to_numpy().view(np.uint64)
        own = units.value.class_of(hashes, units.value.of(hashes, batch.column("ending").to_numpy())[0])
        n = np.bincount(own, minlength=CLASSES)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(n.astype(np.int64))], ["class", "n"])

    out = np.zeros(CLASSES)
    for row in mapped(words.select("word", "ending"), run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        out[row["class"]] = row["n"]
    return out


def score(docs: DataFrame, words: DataFrame, total: int, distinct: int, model: Broadcast) -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity`` to all columns but text.

    A text's log10 probability is the sum over its tokens of the smoothed class transition and the
    add-one emission of the word in its class. The map scores transitions, frequent words and the end; a
    text's rarer words meet the full count table by their hash in a join. Null and empty texts are
    the end token alone. Repeated rows and null ids are answered row by row; an empty table gives
    none; without training tokens every count is 0. Two words with one 64-bit hash would count as one.
    """
    keep = [c for c in docs.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model.value
        hashes, endings, sizes = tokens(as_bytes(batch.column("text")))
        unit, frequent = m.units.of(hashes, endings)
        own = m.units.class_of(hashes, unit)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        before = np.roll(own, 1)
        before[begin] = END_CLASS
        counts = np.zeros(len(hashes), np.int64)
        if len(m.units.counts):
            counts[frequent] = m.units.counts[unit[frequent]]
        # Every text has one end: its count is one number, not a key for the join.
        over = hashes == END
        counts[over] = m.ends
        logs = np.log10(counts + 1.0)
        rare = ~(frequent | over)
        known = frequent | (over & (m.ends > 0))
        path = np.add.reduceat(m.transition[before, own] - m.emission[own], begin)
        row = np.repeat(np.arange(len(sizes)), sizes)[rare]
        bounds = np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep] + [
                pa.array(sizes), pa.array(path), pa.array(np.add.reduceat(logs, begin)),
                pa.array(np.add.reduceat(known.astype(np.int64), begin)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes[rare].view(np.int64)))],
            [*keep, "n_tokens", "_path", "_logs", "_frequent", "_rare"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep]
    rows = mapped(docs, run, ", ".join(
        [*types, "n_tokens long", "_path double", "_logs double", "_frequent long", "_rare array<long>"]))
    # Numbered once and stored: the numbers stay when a task runs again.
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("_row", F.explode("_rare").alias("_word")).groupBy("_row", "_word").agg(F.count("*").alias("_times"))
    met = rare.join(words.select("word", "n"), F.col("_word") == F.col("word"))
    met = met.groupBy("_row").agg(
        F.sum(F.col("_times") * F.log10(F.col("n") + 1.0)).alias("_more"), F.sum("_times").alias("_found"))
    out = rows.drop("_rare").join(met.withColumnRenamed("_row", "_met"), F.col("_row") == F.col("_met"), "left")
    logs = F.col("_logs") + F.coalesce("_more", F.lit(0.0))
    result = F.col("_path") + logs
    return out.select(
        *keep, "n_tokens", (F.col("_frequent") + F.coalesce("_found", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"),
        result.alias("score"), F.pow(F.lit(10.0), -result / F.col("n_tokens")).alias("perplexity"))


def op2_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out"), "text")
    return score(docs, *fit(docs.filter("NOT held_out")))
