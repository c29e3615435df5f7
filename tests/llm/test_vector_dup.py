"""Pivot-permutation index against brute force."""

import brute
import numpy as np
import pytest

from corpusloom.llm import vector_dup
from corpusloom.llm.vector_dup import op3_embedding_near_dedup, unit, vector_duplicates


def expected(rows, cosine=0.95):
    units = {k: unit(v) for k, v in rows}
    links = []
    for size in {len(u) for u in units.values() if u is not None}:
        ids = [k for k, u in units.items() if u is not None and len(u) == size]
        points = np.stack([units[k] for k in ids])
        links += [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(points @ points.T >= cosine, 1)))]
    found = brute.components(units, links)
    n = dict.fromkeys(units, 0)
    for a, b in links:
        n[a], n[b] = n[a] + 1, n[b] + 1
    return {(k, n[k], found[k], k == found[k]) for k in units}


@pytest.mark.parametrize("block", [vector_dup.BLOCK, 7])
def test_links_and_components(spark, block, monkeypatch):
    monkeypatch.setattr(vector_dup, "BLOCK", block)
    draw = np.random.default_rng(4)
    rows, k = [], 0
    for _ in range(25):
        centre = draw.standard_normal(32)
        for _ in range(draw.choice([1, 2, 12])):
            rows.append((k, (centre + 0.12 * draw.standard_normal(32)).tolist()))
            k += 1
    rows += [(900, rows[3][1]), (901, rows[3][1]), (902, [2 * x for x in rows[3][1]]), (903, None), (904, [0.0] * 32)]
    rows += [(905, [float("nan")] * 32), (906, [1.0, None]), (907, [1.0, 2.0]), (908, [2.0, 4.0]), (909, [])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<double>, pivot string")
    got, want = set(map(tuple, vector_duplicates(df).collect())), expected(rows)
    assert {r[0] for r in got} == {r[0] for r in want}
    missing = sum(r[1] for r in want) - sum(r[1] for r in got)
    assert 0 <= missing <= 0.02 * sum(r[1] for r in want)
    if not missing:
        assert got == want


def test_edge_rows(spark):
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, None)]
    got = sorted(map(tuple, vector_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    assert got == sorted([(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 0, None, True)], key=str)
    assert vector_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = list(map(tuple, spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()))
    got = set(map(tuple, op3_embedding_near_dedup(spark, sf).collect()))
    want = expected(rows)
    assert len(got) == len(want)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert sum(r[1] for r in got) <= sum(r[1] for r in want)
    assert len(got & want) >= 0.99 * len(want)
