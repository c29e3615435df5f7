"""Fingerprints: homomorphism, order independence, the edit job against plain Python."""

import hashlib

import pytest

from corpusloom.llm import fingerprint as fp
from corpusloom.llm.fingerprint import delete, edited_fingerprints, from_text, insert, likeness, op5_document_fingerprints, print_of, to_text


def test_sums():
    a, b = ["one two three", "four five", ""], ["six", "one two three"]
    assert to_text(print_of(a + b)) == to_text(insert(print_of(a), print_of(b))) == to_text(print_of(b + a[::-1]))
    assert to_text(delete(print_of(a + b), print_of(b))) == to_text(print_of(a))
    assert to_text(from_text(to_text(print_of(a)))) == to_text(print_of(a))
    assert to_text(print_of(a)) != to_text(print_of(["one two three", "four", "five", ""]))
    assert likeness(print_of(a), print_of(a)) == 1.0 and likeness(print_of([]), print_of(a)) == 0.0
    long = [f"line {k} of many words {k * 7} {k * 13}" for k in range(200)]
    assert likeness(print_of(long), print_of(long[:150])) > 0.6
    assert likeness(print_of(long), print_of([f"other {k} things {k * 3}" for k in range(200)])) < 0.3


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        p = [print_of(fp.paragraphs(t)) for t in (text, edited, after)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(p[0]), to_text(p[1]),
                    likeness(p[0], p[1]), likeness(p[0], p[2])))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1000, 2])
def test_edits(spark, size, monkeypatch):
    monkeypatch.setattr(fp, "GROUP_ROWS", size)
    rows = [(5, "abc\ndef gh"), (3, None), (9, "é日本\n\nx y z"), (-4, ""), (3, "again"), (3, "again"), (None, "none"), (7, "q" * 50)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, grp string")
    assert sorted(map(tuple, edited_fingerprints(df).collect()), key=str) == expected(rows)
    assert sorted(map(tuple, edited_fingerprints(df.limit(1)).collect()), key=str) == expected(rows[:1])
    assert edited_fingerprints(df.limit(0)).count() == 0


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, op5_document_fingerprints(spark, sf).collect()), key=str)
    assert got == expected(rows)
    assert sum(r[5] > r[6] or r[6] > 0.5 for r in got) > 0.9 * len(got)
