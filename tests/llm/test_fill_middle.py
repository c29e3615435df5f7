"""Fill-in-the-middle: the wavelet matrix against counting, rewritten texts against a plain version."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import fill_middle as fm


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300), st.integers(0, 300))
def test_ranks(symbols, most):
    index = fm.WaveletMatrix(np.array(symbols, np.uint8), 3)
    for end in {0, len(symbols) // 2, len(symbols)}:
        for c in range(8):
            assert index.rank(c, end) == symbols[:end].count(c)
            assert index.rank_from(c, end) == sum(s >= c for s in symbols[:end])
    ends = [e for e in range(len(symbols) + 1) if sum(s >= 3 for s in symbols[:e]) <= most]
    assert index.last_within(3, most) == max(ends)


def plain(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "abc", "a", "é", "one two  three\nfour", "日本 mixed text日", "x<P>y", "<S", "<<SM>>", "\U0001f600a\U0001f600b", "\r\n\t ", "<" * 7, "S>" * 5]


@pytest.mark.parametrize("piece", [3, 1 << 20])
def test_one_text(piece, monkeypatch):
    monkeypatch.setattr(fm, "_PIECE", piece)
    for doc_id in [None, *range(40)]:
        for text in TEXTS:
            assert fm.rewrite(doc_id, text or "", 1) == plain(doc_id, text)


def test_rows(spark):
    rows = [(k, t) for k in [None, 3, 3, *range(4, 30)] for t in TEXTS] + [(48, "long words " * 200_000), (49, "q" * 2_000_000)]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, output string, n int")
    found = fm.fill_in_middle(df)
    back = found.select("*", fm.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted((tuple(r)[:-1] for r in back), key=str) == sorted(((d, *plain(d, t)) for d, t in rows), key=str)
    assert sorted((r["doc_id"], r["back"]) for r in back if r["doc_id"] is not None) == sorted((d, t or "") for d, t in rows if d is not None)
    assert found.limit(0).count() == 0 and fm.fill_in_middle(df.limit(0)).count() == 0
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}


def test_plan_is_a_map(spark, sf):
    plan = fm.op13_fill_in_middle(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
