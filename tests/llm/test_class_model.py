"""The class bigram model against plain counts, and its own definitions on small texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from corpusloom.llm import class_model as cm


def plain_tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def check(rows, got, training):
    counts = Counter(w for _, t in training for w in plain_tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for k, text in rows:
        words, r = plain_tokens(text), by_id[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), n)
        expected = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert math.isclose(r["base_score"], expected, rel_tol=1e-9)
        assert r["score"] < 0 and math.isclose(r["perplexity"], 10 ** (-r["score"] / len(words)), rel_tol=1e-6)


def test_query_counts_and_beats_base(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = cm.op2_class_model(spark, sf).collect()
    training = [(k, t) for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    check(rows, got, training)
    assert {r["doc_id"] for r in got if not r["held_out"]} == {k for k, _ in training}
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_edges_and_rare_words(spark, monkeypatch):
    # A share of 1/8 leaves most words to the join: results are those of one table of all words.
    monkeypatch.setattr(cm, "UNIT_SHARE", 8)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A a b"), (5, "x" * 70_000 + " a"), (6, "unseen É é"), (None, "a b")]
    docs = spark.createDataFrame([(k, t, "w", 3) for k, t in rows], "doc_id long, text string, word string, n int")
    train = docs.filter("doc_id IS NULL OR doc_id <> 6")
    got = cm.score(docs, *cm.fit(train, rounds=1)).collect()
    check(rows, got, [r for r in rows if r[0] != 6])
    assert {r["word"] for r in got} == {"w"}
    assert len(cm.score(docs.union(docs), *cm.fit(train, rounds=1)).collect()) == 2 * len(rows)
    none = docs.limit(0)
    assert cm.score(none, *cm.fit(train, rounds=1)).count() == 0
    alone = cm.score(docs.filter("doc_id = 4"), *cm.fit(none, rounds=1)).first()
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"], alone["base_score"]) == (4, 0, 0, 0.0)


def test_best_class_by_trial():
    draw = np.random.default_rng(5)
    pairs = draw.integers(20, 60, (cm.CLASSES, cm.CLASSES)).astype(float)
    first, slot, n = np.array([0, 3]), np.array([4, 9, cm.CLASSES + 7, 2, cm.CLASSES + 2]), np.array([3.0, 2, 5, 4, 4])
    own = np.array([1, 6])

    def value(m):
        f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return f(m) - f(m.sum(0)) - f(m.sum(1))

    for k, entries in enumerate((range(3), range(3, 5))):
        found = []
        for c in range(1, cm.CLASSES):
            m = pairs.copy()
            for at, sign in ((own[k], -1), (c, 1)):
                for e in entries:
                    if slot[e] < cm.CLASSES:
                        m[slot[e], at] += sign * n[e]
                    else:
                        m[at, slot[e] - cm.CLASSES] += sign * n[e]
            found.append(value(m))
        best = cm.best_classes(first, slot, n, own, pairs)[k]
        assert found[best - 1] >= sorted(found)[-2]


def test_exchange_finds_classes(spark):
    draw = random.Random(2)
    texts = [" ".join(f"{'ab'[k % 2]}{draw.randrange(30)}" for k in range(40)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = cm.score(docs, *cm.fit(docs)).agg({"score": "sum", "base_score": "sum"}).first()
    # Half of the words follow each other only: knowing the side is worth up to log10(2) a token.
    assert got["sum(score)"] - got["sum(base_score)"] > 0.15 * 150 * 41


def test_contexts_equal_plain_counts_in_packed_rows(spark, monkeypatch):
    # Tasks flush after every few texts: counts are those of one pass, and one row per unit is stored.
    monkeypatch.setattr(cm, "_FLUSH_NEIGHBOURS", 64)
    draw = random.Random(4)
    texts = [None, "", " \n", "a", *(" ".join(f"w{draw.randrange(40)}x{draw.randrange(9)}" for _ in range(draw.randrange(30))) for _ in range(60))]
    train = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(3)
    hashes, n = np.unique(np.concatenate([cm.tokens([t.encode()])[0] for t in texts[3:20]]), return_counts=True)
    hashes, n = hashes[hashes != cm.END], n[hashes != cm.END]
    units = cm.Units(hashes, n, (1 + np.arange(len(hashes) + cm.ENDINGS) % (cm.CLASSES - 1)).astype(np.int32))
    shared = spark.sparkContext.broadcast(units)
    expected = Counter()
    for text in texts * 2:
        words, endings, _ = cm.tokens([(text or "").encode()])
        unit = units.of(words, endings)[0]
        own = units.class_of(words, unit).tolist()
        for k, (u, c) in enumerate(zip(unit.tolist(), own)):
            before = own[k - 1] if k else cm.END_CLASS
            expected[-1, cm.CLASSES * before + c] += 1
            if k + 1 < len(own):
                expected[u, before] += 1
                expected[u, cm.CLASSES + own[k + 1]] += 1
    rows = cm.context_counts(cm.unit_texts(train, shared), shared).collect()
    got = {(r["unit"], s): m for r in rows for s, m in zip(np.frombuffer(r["slots"], "<u2").tolist(), np.frombuffer(r["counts"], "<i8").tolist())}
    assert got == dict(expected)
    assert len(rows) == len({u for u, _ in expected})
    none = train.limit(0)
    assert cm.context_counts(cm.unit_texts(none, shared), shared).count() == 0
