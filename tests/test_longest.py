"""Linear longest-match cutting against the plain quadratic rule."""

import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators.longest import LongestMatch


def plain(word, ids):
    pieces, begin = [], 0
    while begin < len(word):
        for end in range(len(word), begin, -1):
            piece = ("##" if begin else "") + word[begin:end]
            if piece in ids:
                break
        else:
            return ["[UNK]"]
        pieces.append(piece)
        begin = end
    return pieces


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.text("abc#é", min_size=1, max_size=5)), max_size=25), st.lists(st.text("abc#é", max_size=12), max_size=10))
def test_equals_the_plain_rule(pieces, words):
    ids = {("##" if inside else "") + text for inside, text in pieces}
    match = LongestMatch(ids)
    for word in [*words, *ids]:
        assert match.cut(word) == plain(word, ids)


def test_long_words():
    ids = {"a", "##a", "##aa", "##aaab", "##b", "ab", "##abab", "##aaaaaaaaaaaaaaaac"}
    match = LongestMatch(ids)
    rng = random.Random(2)
    for size in (101, 150, 3000):
        word = "a" + "".join(rng.choices("ab", k=size))
        assert match.cut(word) == plain(word, ids)
    start = time.perf_counter()
    short = match.cut("a" * 20_000)
    first = time.perf_counter() - start
    start = time.perf_counter()
    long = match.cut("a" * 200_000)
    assert len(short) == 10_001 and len(long) == 100_001 - 0
    assert time.perf_counter() - start < 40 * first + 1
    assert match.cut("a" * 1000 + "x") == ["[UNK]"] and match.cut("") == []


def test_no_pieces():
    assert LongestMatch([]).cut("a") == ["[UNK]"] and LongestMatch(["##"]).cut("##") == ["##"]
