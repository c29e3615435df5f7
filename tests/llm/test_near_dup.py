"""MinHash near-duplicates against all pairs on full sets."""

import random

import brute
import numpy as np
import pytest

from corpusloom.llm import near_dup
from corpusloom.llm.common import connected_components
from corpusloom.llm.minhash import BINS, signature
from corpusloom.llm.near_dup import near_duplicates, op4_minhash_near_dedup
from corpusloom.llm.shingles import shingle_set


def edited(words, draw, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    texts, k = {}, 0
    for _ in range(30):
        base = [f"w{draw.randrange(2000)}" for _ in range(draw.randint(2, 400))]
        for _ in range(draw.choice([1, 2, 9])):
            texts[k], k = edited(base, draw, draw.randint(0, max(1, len(base) // 40))), k + 1
    texts |= {k: None, k + 1: "", k + 2: " \n ", k + 3: "One", k + 4: "one", k + 5: "a b", k + 6: "A  B\t"}
    return texts


@pytest.mark.parametrize("block", [near_dup.BLOCK, 3])
def test_equals_all_pairs(spark, corpus, block, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in corpus.items()], "doc_id long, text string, id string, band string")
    for width, percent in ((3, 85), (5, 80)):
        expected = brute.near_duplicates(corpus, width, percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, width, percent).collect()}
        assert got == expected


def test_edge_rows(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "lonely text here"), (None, None), (7, "")]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()), key=str)
    expected = [(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 1, None, True), (None, 0, None, True), (7, 0, 7, True)]
    assert got == sorted(expected, key=str)
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_all_pairs(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = {(k, n, c, k == c) for k, (n, c) in brute.near_duplicates(texts, 3, 85).items()}
    assert set(map(tuple, op4_minhash_near_dedup(spark, sf).collect())) == expected


def test_signature_borrows_for_empty_bins():
    few = shingle_set(b"a b c d e f g h", 3)
    sign = signature(few)
    assert len(sign) == BINS and set(sign.tolist()) <= set(few.tolist())
    assert (signature(few[:1]) == few[0]).all()
    many = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2))
    half = many[np.random.default_rng(2).random(len(many)) < 0.9]
    assert abs((signature(many) == signature(half)).mean() - 0.9) < 0.1


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 470)]
    expected = brute.components({n for e in links if e[0] != e[1] for n in e}, links)
    df = spark.createDataFrame([*links, (None, 3), (5, 5)], "a long, b long")
    assert dict(map(tuple, connected_components(df).collect())) == expected
    assert connected_components(df.limit(0)).count() == 0
