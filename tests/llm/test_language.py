"""Language identification on held-out texts, edge rows, and the evidence of host and markup."""

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language as la


@pytest.fixture(scope="module")
def model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 5 <> 0")
    return la.fit(docs)


def test_held_out_accuracy(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 5 = 0")
    found = la.identify_documents(docs, *model)
    joined = docs.join(found, la.row_key() == F.col("row_key"))
    assert joined.filter("language <=> lang").count() >= 0.98 * docs.count()


def test_query_names_every_page(spark, sf):
    got = la.op6_language_id(spark, sf).collect()
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert sorted(r["page_id"] for r in got) == sorted(r["page_id"] for r in pages)
    assert sum(r["language"] == r["declared"] for r in got) >= 0.98 * len(got)


def test_counts_equal_plain_counts(spark):
    rows = [("en", "Ab abc"), ("en", "abc"), ("de", "äb"), (None, "lost"), ("de", None), ("fr", "")]
    got = {}
    for r in la.trigram_counts(spark.createDataFrame(rows, "lang string, text string"), "text", "lang").collect():
        got[r["language"]] = got.get(r["language"], 0) + r["n"]
    expected = {}
    for name, text in rows:
        if name and text:
            expected[name] = expected.get(name, 0) + len(la.cells(text.encode()))
    assert got == expected


def test_edges(spark, model):
    html = '<html LANG="fr-CA"><p>{}</p></html>'
    rows = [(1, None, None), (2, "no address", html.format("")), (2, "no address", html.format("")), (3, "http://a.fr/", html.format("12 34")),
            (None, "http://a.fr:80/x", html.format("que la " * 30_000)), (5, "http://U@A.Fr?x", "<html lang=xx>de la que le")]
    pages = spark.createDataFrame([(*r, "x", "y", 1.5) for r in rows], "page_id long, url string, html string, prior string, host string, seen double")
    got = la.identify_pages(pages, *model).collect()
    assert len(got) == len(rows)
    assert [r["language"] for r in got if r["page_id"] in (1, 2, 3)] == [None] * 4
    assert {r["page_id"]: r["host"] for r in got} == {1: None, 2: None, 3: "a.fr", None: "a.fr", 5: "a.fr"}
    assert {r["page_id"]: r["declared"] for r in got} == {1: None, 2: "fr", 3: "fr", None: "fr", 5: "xx"}
    assert la.identify_pages(pages.limit(0), *model).count() == 0
    nothing = la.fit(spark.createDataFrame([], "lang string, text string"))
    assert {r["language"] for r in la.identify_pages(pages, *nothing).collect()} == {None}


def test_host_prior_and_markup_by_hand(spark):
    names = ["de", "en"]
    # Row 9 has even text evidence: its host and its declaration decide.
    rows = [(k, "h", "de", [0.0, -4.0], 5) for k in range(8)] + [(9, "h", "de", [0.0, 0.0], 5), (10, "i", None, [0.0, 0.0], 5)]
    rows += [(k, "j", "en", [-4.0, 0.0], 5) for k in range(20, 30)]
    df = spark.createDataFrame(rows, "id long, host string, declared string, evidence array<double>, n_trigrams long")
    got = {r["id"]: (r["language"], r["probability"]) for r in la.fuse(df, names, ["host"], "declared").collect()}
    assert got[9][0] == "de" and got[9][1] > 0.9 and got[10][1] < 0.7
    sure = 1 / (1 + 2.718281828459045 ** -4)
    de = 8 * sure + 10 * (1 - sure) + 1
    base = (de + 1) / 22
    prior = (8 * sure + 5 * base) / (8 + 5)
    alone = {r["id"]: r["probability"] for r in la.fuse(df, names, ["host"], None).collect()}
    assert abs(alone[9] - prior) < 1e-6
