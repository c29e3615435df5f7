"""Repeated passages: difference covers, hashes, and whole results against a plain version."""

import hashlib
import random

import numpy as np
import pytest

from corpusloom.llm import substring_dup as sd
from corpusloom.llm.substring_dup import op11_substring_dedup, repeated_passages

SPACES = " \t\n\v\f\r"


def words_of(text):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(rows, width):
    least = {}
    docs = [(2**63 - 1 if d is None else d, words_of(t or "")) for d, t in rows]
    for d, w in docs:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            least[key] = min(d, least.get(key, d))
    out = []
    for (given, _), (d, w) in zip(rows, docs):
        gone = {x for k in range(len(w) - width + 1) if least[tuple(w[k : k + width])] < d for x in range(k, k + width)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((given, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, width):
    rows = repeated_passages(df, width).collect()
    for r in rows:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


def test_covers():
    for period, offsets in sd.COVERS.items():
        held = set(offsets)
        for a in range(period):
            for b in range(period):
                assert any((a + d) % period in held and (b + d) % period in held for d in range(period))
    assert sd.cover(50) == (31, sd.COVERS[31]) and sd.cover(1)[0] == 1


def test_hashes():
    a = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    long = "x" * 70
    words = [a, b, long, long + "y", "é", "日本", "a", "aa", "aaaaaaaa", "aaaaaaaaa", "\x00", "\x00\x00", "a\x00", "Z", "z"]
    data = " ".join(words + words).encode()
    for lane in (0, 1):
        values = sd.word_hashes(data, lane)
        assert len(set(values.tolist())) == len(words) and (values[: len(words)] == values[len(words) :]).all()
    assert len(sd.word_hashes(b"")) == len(sd.word_hashes(b" \n\t")) == 0
    numbers = np.arange(40, dtype=np.uint64)
    for width in (1, 2, 3, 7, 20, 39, 40, 41):
        values = sd.sequence_hashes(numbers % np.uint64(5), width)
        assert len(values) == max(0, 41 - width)
        for x in range(len(values)):
            for y in range(len(values)):
                assert (values[x] == values[y]) == (x % 5 == y % 5)


@pytest.mark.parametrize("width,least,hot", [(50, 100_000, 20), (6, 100_000, 3), (3, 1, 10**9), (1, 100_000, 2)])
def test_random(spark, width, least, hot, monkeypatch):
    monkeypatch.setattr(sd, "SAMPLE_LEAST", least)
    monkeypatch.setattr(sd, "OFTEN", hot)
    rng = random.Random(width)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(1, 4 * width))] for _ in range(12)]
    rows = []
    for k in range(90):
        words = []
        for _ in range(rng.randrange(4)):
            part = list(rng.choice(base))
            lo = rng.randrange(len(part))
            words += part[lo : lo + rng.randrange(1, 3 * width)]
            if rng.random() < 0.3:
                words.append("own%d" % rng.randrange(1000))
        text = "".join(w + rng.choice(SPACES) for w in words)
        rows.append((rng.randrange(-5, 60), text))
    rows += [(None, None), (None, ""), (3, " \n"), (None, " ".join(base[0] * 3)), (None, " ".join(base[0] * 3)), (7, rows[0][1])] + rows[:4]
    rows += [(k, " ".join(base[1] * 2)) for k in range(200, 230)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, id string, k int, starts string")
    assert found(df, width) == plain(rows, width)


def test_edges(spark):
    df = spark.createDataFrame([(2, "a b c"), (1, "x a b c")], "doc_id long, text string")
    assert found(df.limit(0), 3) == []
    assert [r[2] for r in found(df, 3)] == [0, 3] and [r[2] for r in found(df, 4)] == [0, 0]
    long = " ".join(str(k * k % 99991) for k in range(300_000))
    rows = [(1, long), (2, "start " + long + " end"), (3, "q" * 3_000_000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 50) == plain(rows, 50)


def test_texts_move_once(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, op11_substring_dedup(spark, sf).collect()), key=str)
    assert got == plain([tuple(r) for r in rows.collect()], 50)
    assert sum(r[2] for r in got) > 0
