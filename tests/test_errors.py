"""Edit distances by bits and the split into substitutions, insertions and deletions, against plain tables."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import errors


def plain(a, b):
    """(cost, indels) of the cheapest alignment with fewest indels, by the whole table."""
    line = [(j, j) for j in range(len(b) + 1)]
    for x in a:
        new = [(line[0][0] + 1, line[0][1] + 1)]
        for j, y in enumerate(b, 1):
            swap = line[j - 1][0] + (x != y), line[j - 1][1]
            new.append(min(swap, (line[j][0] + 1, line[j][1] + 1), (new[-1][0] + 1, new[-1][1] + 1)))
        line = new
    return line[-1]


def parts(a, b):
    cost, indels = plain(a, b)
    insertions = (indels + len(b) - len(a)) // 2
    return cost - indels, insertions, indels - insertions


@settings(max_examples=600, deadline=None)
@given(st.text("abc", max_size=14), st.text("abcd", max_size=14))
def test_small(a, b):
    assert errors.edit_distance(a, b) == plain(a, b)[0]
    assert errors.align_counts(list(a), list(b)) == parts(a, b)


@pytest.mark.parametrize("size,letters,noise", [(200, "abcdefgh", 0.1), (150, "ab", 0.9), (130, "abcdefghijk", 0.4)])
def test_longer_than_a_machine_word(size, letters, noise):
    rng = random.Random(size)
    for _ in range(6):
        a = rng.choices(letters, k=size)
        b = [c if rng.random() > noise else rng.choice(letters) for c in a if rng.random() > noise / 3]
        b[rng.randrange(len(b)) : 0] = rng.choices(letters, k=rng.randrange(9))
        assert errors.edit_distance(a, b) == plain(a, b)[0] and errors.align_counts(a, b) == parts(a, b)
        assert errors.align_counts(b, a) == parts(b, a)


def test_long_rows():
    rng = random.Random(3)
    a = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    b = [w for w in a if rng.random() > 0.01]
    b[500:500] = ["new", "words"]
    start = time.perf_counter()
    s, i, d = errors.align_counts(a, b)
    assert s + i + d == errors.edit_distance(a, b) and i - d == len(b) - len(a) and i >= 2
    assert time.perf_counter() - start < 60
    assert errors.align_counts(a, []) == (0, 0, len(a)) and errors.align_counts([], b) == (0, len(b), 0)


def test_long_characters(spark, monkeypatch):
    monkeypatch.setattr(errors, "LARGE_TABLE", 50)
    rows = [("abc", "abd"), ("kitten sitting", "sitting kitten"), ("é" * 30, "e" * 28), (None, "a"), ("a", None), ("", "abc"), ("x" * 60, "")]
    df = spark.createDataFrame(rows, "r string, h string")
    got = [r[0] for r in df.coalesce(1).select(errors.char_edits(F.col("r"), F.col("h"))).collect()]
    assert got == [1, plain(*rows[1])[0], 30, None, None, 3, 60]
