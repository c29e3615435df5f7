"""Toxic spans: held-out accuracy, marginals against all paths, edge rows."""

import itertools

import numpy as np

from corpusloom.llm import toxicity as tx


def test_held_out(spark):
    # The smallest tables have some ten toxic rows to learn from: too few for a rate to mean anything.
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in tx.op10_toxicity(spark, sf).collect()]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_marginals_equal_all_paths(monkeypatch):
    monkeypatch.setattr(tx, "_CHUNK", 3)
    draw = np.random.default_rng(4)
    moves, lengths = draw.normal(size=(2, 2)), np.array([8, 0, 1, 3])
    scores = draw.normal(size=12)
    got, start = tx.marginals(scores, lengths, moves), 0
    for n in lengths:
        own, total, on = scores[start : start + n], 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)) if n else ():
            p = np.exp(np.dot(path, own) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += p
            on += p * np.array(path)
        if n:
            assert np.allclose(got[start : start + n], on / total)
        start += n


def test_edges_and_spans(spark):
    texts = [(k, f"plain words near{k} {'blorgish' if k % 2 else 'calm'} thing{k} end", k % 2) for k in range(60)]
    train = spark.createDataFrame([(k, t) for k, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in texts] + [(None, 1), (3, None), (3, 0)], "doc_id long, toxic int")
    field = tx.fit_on(train, labels)
    rows = [(1, None), (1, None), (2, ""), (None, "so É blorgish thing"), (4, "calm " * 40_000)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string")
    got = tx.tag_documents(docs, field).collect()
    assert len(got) == 5 and [len(r["spans"]) for r in got if r["doc_id"]] == [0, 0, 0, 0]
    span = next(r["spans"][0] for r in got if r["doc_id"] is None)
    assert "so É blorgish thing"[span["start"] : span["end"]].startswith("blorgish")
    assert tx.filter_toxic(docs, field).columns == docs.columns
    assert {r["doc_id"] for r in tx.filter_toxic(docs, field).collect()} >= {1, 2, 4}
    assert tx.tag_documents(docs.limit(0), field).count() == 0
    unfit = tx.fit_on(train, labels.limit(0))
    assert {r["predicted"] for r in tx.tag_documents(docs, unfit).collect()} == {0}
