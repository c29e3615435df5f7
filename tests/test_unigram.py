"""Unigram training: maximal substrings and lattice passes against plain versions, full-size runs."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.operators.segment import _arcs, _expected_by_logs, best_path, prefix_table
from corpusloom.operators.vocab import lattice, substrings
from corpusloom.operators.vocab.lattice import PieceTrie, arcs_of, best_counts, code_points_of, expected
from corpusloom.operators.vocab.unigram import _digamma, train_unigram


def plain_maximal(words, longest, covered=None):
    counts = Counter()
    ended = set()
    for word, n in words:
        parts, part = [], ""
        for c in word:
            if covered and c not in covered:
                parts.append(part)
                part = ""
            else:
                part += c
        for part in [*parts, part]:
            for a in range(len(part)):
                for b in range(a + 1, min(len(part), a + longest) + 1):
                    counts[part[a:b]] += n
                ended.add(part[a : a + longest])
    longer = {}
    for piece, n in counts.items():
        longer[piece[:-1]] = max(n, longer.get(piece[:-1], 0))
    return {p: n for p, n in counts.items()
            if len(p) > 1 and n > 1 and (p in ended or longer.get(p, 0) < n)}


@pytest.mark.parametrize("longest,covered", [(16, None), (4, None), (3, "abc"), (16, "ab-]^\\")])
def test_maximal_substrings(spark, longest, covered, monkeypatch):
    monkeypatch.setattr(substrings, "SUFFIXES_PER_BATCH", 500)
    rng = random.Random(longest)
    words = {"".join(rng.choices("aaabbc-]\\é😀", k=rng.randrange(0, 12))): rng.randrange(1, 4) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["piece"]: r["n"] for r in substrings.maximal_substrings(df, longest, covered).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_maximal(words.items(), longest, covered)
    assert substrings.maximal_substrings(df.limit(0), 5).count() == 0


@pytest.mark.parametrize("long_segment", [1000, 2])
def test_lattice(long_segment, monkeypatch):
    monkeypatch.setattr(lattice, "LONG_SEGMENT", long_segment)
    rng = random.Random(3)
    scores = {"".join(rng.choices("abcd", k=rng.randrange(1, 6))): -rng.random() * 5 - 1 for _ in range(60)}
    scores |= {c: -4.0 - ord(c) / 100 for c in "abc"}
    scores.pop("d", None)
    pieces = list(scores)
    trie, values = PieceTrie(pieces), np.array(list(scores.values()))
    words = ["".join(rng.choices("abcde", k=rng.randrange(1, 30))) for _ in range(200)] + ["a", "z"]
    weight = np.array([rng.randrange(1, 9) for _ in words], float)
    unknown = values.min() - 10
    codes, sizes = code_points_of(words)
    arcs = arcs_of(codes, sizes, trie, values, unknown)
    sums, likelihood = expected(arcs, weight, len(pieces))
    table = prefix_table(scores)
    by_hand, best_by_hand = Counter(), Counter()
    for word, n in zip(words, weight):
        ways = [[(e, math.exp(s)) for e, s in _arcs(word, i, table, unknown)] for i in range(len(word))]
        for piece, share in _expected_by_logs(word, ways):
            by_hand[piece] += n * share
        for piece in best_path(word, table, unknown):
            best_by_hand[piece] += n
    assert all(abs(by_hand[p] - v) < 1e-9 for p, v in zip(pieces, sums))
    assert likelihood < 0
    got = best_counts(arcs, weight, len(pieces))
    assert {p: v for p, v in zip(pieces, got) if v} == {p: v for p, v in best_by_hand.items() if p in scores}
    for piece in pieces:
        codes, sizes = code_points_of([piece])
        whole = arcs_of(codes, sizes, trie, values, unknown, whole=False)
        other = best_path(piece, table, unknown, whole=False)
        cost = sum(scores.get(o, unknown) for o in other)
        assert abs(sum(lattice.best(whole)[0][whole.first + whole.length]) - cost) < 1e-9


def test_digamma():
    known = {1.0: -0.5772156649015329, 0.5: -1.9635100260214235, 10.0: 2.251752589066721}
    assert np.allclose(_digamma(np.array(list(known))), list(known.values()), atol=1e-9)


def test_one_long_word(spark):
    rng = random.Random(5)
    word = "".join(rng.choices(["ab", "ba", "c", "abc"], k=500_000))
    df = spark.createDataFrame([(word, 2), ("abc", 1), ("", 5)], "word string, n long")
    rows = train_unigram(spark, df, 16, 1.0, max_piece_length=3).collect()
    learned = {r["piece"]: r["score"] for r in rows if r["kind"] == "learned"}
    assert len(word) > 900_000 and {"a", "b", "c", "ab", "ba"} <= set(learned) and len(rows) <= 16
    assert abs(sum(map(math.exp, learned.values())) - 1) < 0.3


def test_default_seed_and_size(spark, sentences):
    from corpusloom.operators.stats import marked_word_counts

    vocab = train_unigram(spark, marked_word_counts(sentences[1]), 8000)
    assert vocab.count() == 8000
    assert vocab.select("piece").distinct().count() == 8000
    empty = spark.createDataFrame([], "word string, n long")
    assert train_unigram(spark, empty, 100).count() == 4
