"""Unigram language-model vocabulary: EM with pruning over a word table (Kudo, 2018)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.segment import UNKNOWN_PENALTY
from corpusloom.operators.vocab.lattice import Arcs, PieceTrie, arcs_of, best, best_counts, code_points_of, expected
from corpusloom.operators.vocab.substrings import maximal_substrings
from corpusloom.operators.vocab.table import (
    check_size, covered_characters, head_rows, vocabulary,
)
from corpusloom.session import SMALL_TABLE_ROWS, spread_words, stored_words

# Share kept by one pruning step, EM steps between them, margin over the target,
# least expected count, and the seed size.
SHRINK = 0.75
EM_STEPS = 2
MARGIN = 1.1
LEAST_COUNT = 0.5
SEED_SIZE = 1_000_000

# A task gives one sum per piece that it meets, so large tasks shuffle less.
WORDS_PER_TASK = 100_000
# Characters whose ways are held at a time in a task; one longer word is held alone.
CHARACTERS_PER_CHUNK = 200_000

_SUMS = "piece int, value double"


def _digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log-gamma, by recurrence and the asymptotic series."""
    x = np.array(x, np.float64)
    shift = np.zeros_like(x)
    while (low := x < 7).any():
        shift[low] -= 1 / x[low]
        x[low] += 1
    inv = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - inv * (1 / 12 - inv * (1 / 120 - inv / 252))


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words and weights of a task, so many that array steps pay off."""
    words, weights, size = [], [], 0
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            words.append(word)
            weights.append(n)
            size += len(word)
            if size >= CHARACTERS_PER_CHUNK:
                yield words, np.array(weights, np.float64)
                words, weights, size = [], [], 0
    if words:
        yield words, np.array(weights, np.float64)


class _Model:
    """Pieces and scores, in arrays of at most the seed size; broadcast to the tasks of one pass."""

    def __init__(self, pieces: list[str], scores: np.ndarray, required: np.ndarray):
        self.pieces, self.scores, self.required = pieces, scores, required
        self.trie = PieceTrie(pieces)
        self.unknown = float(scores.min()) - UNKNOWN_PENALTY

    def arcs(self, texts: list[str], whole: bool = True) -> Arcs:
        return arcs_of(*code_points_of(texts), self.trie, self.scores, self.unknown, whole)

    def only(self, keep: np.ndarray, scores: np.ndarray) -> _Model:
        at = np.flatnonzero(keep)
        return _Model([self.pieces[k] for k in at], scores[at], self.required[at])

    def __getstate__(self) -> dict:
        return {"trie": self.trie, "scores": self.scores, "unknown": self.unknown}


class _Trainer:
    def __init__(self, spark: SparkSession, words: DataFrame, longest: int):
        self.spark, self.longest = spark, longest
        self.words = spread_words(words.filter("word <> ''"), words.count(), WORDS_PER_TASK).persist()

    def close(self) -> None:
        self.words.unpersist()

    def _sums(self, model: _Model, count: Callable[[Arcs, np.ndarray, int], np.ndarray]) -> np.ndarray:
        """A count of each piece over the word table: summed per task, then per piece on the cluster."""
        shared = self.spark.sparkContext.broadcast(model)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            sums = np.zeros(len(held.scores))
            for words, weight in _chunks(batches):
                sums += count(held.arcs(words), weight, len(sums))
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["piece", "value"])

        totals = self.words.mapInArrow(run, _SUMS).groupBy("piece").agg(F.sum("value").alias("value")).toArrow()
        shared.destroy()
        sums = np.zeros(len(model.pieces))
        sums[totals.column("piece").to_numpy()] = totals.column("value").to_numpy()
        return sums

    def em_step(self, model: _Model) -> _Model:
        sums = self._sums(model, lambda *given: expected(*given)[0])
        keep = (sums >= LEAST_COUNT) | model.required
        floor = _digamma(np.array([max(sums[keep].sum(), LEAST_COUNT)]))[0]
        scores = _digamma(np.maximum(sums, LEAST_COUNT)) - floor
        unseen = keep & (sums == 0)
        if unseen.any() and not unseen[keep].all():
            scores[unseen] = scores[keep & ~unseen].min()
        return model.only(keep, scores)

    def prune(self, model: _Model, target: int) -> _Model:
        """Keep the pieces whose removal would cost the most likelihood."""
        counts = self._sums(model, best_counts)
        total = max(float(counts.sum()), 1.0)
        shared = self.spark.sparkContext.broadcast(model)
        at = np.flatnonzero(~model.required)
        table = pa.table({
            "id": pa.array(at.astype(np.int32)), "piece": pa.array([model.pieces[k] for k in at]),
            "n": pa.array(counts[at])})

        def losses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch in batches:
                arcs = held.arcs(batch.column("piece").to_pylist(), whole=False)
                other = np.zeros(batch.num_rows)
                np.add.at(other, arcs.word, best(arcs)[0][arcs.first + arcs.length])
                own = held.scores[batch.column("id").to_numpy()]
                loss = batch.column("n").to_numpy() / total * (own - other)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("piece"), pa.array(loss)], ["id", "piece", "loss"])

        room = max(0, max(target, int(SHRINK * len(model.pieces))) - int(model.required.sum()))
        rows = self.spark.createDataFrame(table).repartition(self.spark.sparkContext.defaultParallelism)
        ranked = rows.mapInArrow(losses, "id int, piece string, loss double")
        kept = ranked.orderBy(F.desc("loss"), "piece").limit(room).select("id").toArrow()
        shared.destroy()
        keep = model.required.copy()
        keep[kept.column("id").to_numpy()] = True
        return model.only(keep, model.scores)

    def seed(self, required: dict[str, int], seed_size: int) -> _Model:
        """The characters and the maximal substrings of the greatest weight times length."""
        gain = (F.col("n") * F.length("piece")).alias("gain")
        found = maximal_substrings(self.words, self.longest, "".join(required)).select("piece", gain)
        top = found.orderBy(F.desc("gain"), "piece").limit(seed_size).toArrow()
        pieces = [*required, *top.column("piece").to_pylist()]
        weights = np.concatenate((np.array(list(required.values()), np.float64), top.column("gain").to_numpy()))
        needed = np.arange(len(pieces)) < len(required)
        return _Model(pieces, np.log(weights) - math.log(weights.sum()), needed)

    def run(self, required: dict[str, int], seed_size: int, target: int) -> dict[str, float]:
        """Seed, then alternate EM and pruning down to the target."""
        model = self.seed(required, seed_size)
        while True:
            for _ in range(EM_STEPS):
                model = self.em_step(model)
            if len(model.pieces) <= target:
                return dict(zip(model.pieces, model.scores.tolist()))
            model = self.prune(model, target)


def train_unigram(
    spark: SparkSession, words: DataFrame, vocab_size: int = 8000, coverage: float = 0.9995,
    max_piece_length: int = 16, seed_size: int = SEED_SIZE, strict: bool = False,
    control: Sequence[str] = (), user: Sequence[str] = (), byte_fallback: bool = False,
) -> DataFrame:
    """Unigram vocabulary; every covered character keeps a piece.

    Seeds are the maximal substrings of the words, at most ``seed_size`` of them. Sums run on the cluster;
    only arrays of one number per piece reach the driver, bounded by the seed size. Words may have any
    length. A word table without words gives the reserved pieces alone.
    """
    check_size(vocab_size)
    if not 0 < seed_size <= SMALL_TABLE_ROWS:
        raise ValueError(f"seed_size must lie in 1..{SMALL_TABLE_ROWS}")
    head = head_rows(control, user, byte_fallback)
    room = vocab_size - len(head)
    with stored_words(spark, words) as stored:
        required = dict(covered_characters(stored, coverage))
        if room < len(required):
            raise ValueError(f"vocab_size must be at least {len(head) + len(required)} for this alphabet")
        if not required:
            return vocabulary(spark, head)
        trainer = _Trainer(spark, stored, max_piece_length)
        try:
            scores = trainer.run(required, seed_size, max(int(MARGIN * room), len(required)))
        finally:
            trainer.close()
    if strict and len(scores) < room:
        raise ValueError(f"the corpus supports {len(scores) + len(head)} pieces, not {vocab_size}")
    ranked = sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))
    singles = [kv for kv in ranked if kv[0] in required]
    others = [kv for kv in ranked if kv[0] not in required][: room - len(singles)]
    learned = sorted([*singles, *others], key=lambda kv: (-kv[1], kv[0]))
    return vocabulary(spark, [*head, *((p, s, "learned") for p, s in learned)])
