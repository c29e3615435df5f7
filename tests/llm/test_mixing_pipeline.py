"""Copies the mix takes, and the pipeline against its stages' definitions."""

import re
from collections import Counter

import brute

import corpus_pipeline
from corpusloom.llm import mixing, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_take_equals_mix(spark):
    rows = [(k, f"Word{k} " * (k % 9), f"s{k % 3}", 1) for k in range(60)] + [(None, "a  b\tc", None, 2), (None, None, None, 2), (7, "", "s1", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        wanted[r["doc_id"]] += r["taken"]
    got, copies = Counter(), mixing.take(docs)
    assert copies.columns == docs.columns
    for r in copies.collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {k: n for k, n in got.items()} == {k: n for k, n in wanted.items() if n}
    assert sorted(map(str, copies.collect())) == sorted(map(str, mixing.take(docs.repartition(5)).collect()))
    assert mixing.take(docs.limit(0)).count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert docs.columns == corpus_pipeline.COLUMNS
    by_name, kept = dict(corpus_pipeline.STAGES), docs
    kept = by_name["language_id"](spark, docs, sf)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    field = toxicity.fit_on(kept, spark.read.parquet(f"{sf}/labels.parquet"))
    clean = {r["doc_id"] for r in toxicity.tag_documents(kept, field).collect() if not r["predicted"]}
    kept = by_name["toxicity"](spark, kept, sf)
    assert {r["doc_id"] for r in kept.collect()} == clean
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    heads = {k for k, (_, c) in brute.near_duplicates(texts, 5, 80).items() if k == c}
    kept = by_name["near_duplicates"](spark, kept, sf)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(heads) and kept.columns == docs.columns
    mixed = by_name["mix_sources"](spark, kept, sf)
    assert mixed.columns == docs.columns
    tokens = by_name["tokens"](spark, mixed, sf)
    assert tokens.count() == mixed.count() == corpus_pipeline.run(spark, sf).count()


def test_empty_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "a", 0), (10**9, "", "en", "a", 0)], docs.schema)
    for df in (docs.union(odd).union(docs), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, sf)
            assert out.count() <= 3 * max(df.count(), 1) and "doc_id" in out.columns
