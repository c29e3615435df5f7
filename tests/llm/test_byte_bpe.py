"""Boundaries, merges and decoding against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from corpusloom.llm.byte_bpe import (
    Codec, decode_ids, encode_texts, load_ranks, merge_slice, op7_byte_bpe, text_digests, token_digests,
)

TEXTS = [
    "", " ", "  ", "a", "it's I'll we've they're 'tis ''s 'S  's \n's", "a  b\n\n c\t\td  x", "end  ", "1234 5six ٣ Ⅷ",
    "don't'll'd'", " 'm", "!'re", "\n\n\n", "x  y", "naïve Straße 日本語 🎉🎉 é", "a" * 5000, "ab" * 3000 + " " * 500,
    "<|endoftext|> x", "\x1c\x1d a\x85b", "'", "''", "'r", "'l", "'re", "''re", "áb", "\r\n\r\n x",
]


@pytest.fixture(scope="module")
def encoding(spark):
    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.value, special_tokens={})


def test_codec_equals_library(encoding):
    ranks, library = encoding
    draw = random.Random(5)
    alphabet = "ab '\n\t st re ve ll m d S1٣!?.é日  \x85\x1c🎉"
    texts = TEXTS + ["".join(draw.choices(alphabet, k=draw.randint(0, 200))) for _ in range(1500)]
    codec = Codec(ranks.value)
    ids, offsets, bounds = codec.encode(texts)
    for k, text in enumerate(texts):
        mine = ids[bounds[k] : bounds[k + 1]].tolist()
        assert mine == library.encode_ordinary(text), repr(text)
        assert codec.decode(mine) == text.encode()
        data = text.encode()
        at = slice(bounds[k], bounds[k + 1])
        assert codec.decode_at(ids[at], offsets[at]).tobytes() == data
        cuts = [*offsets[bounds[k] : bounds[k + 1]].tolist(), len(data)]
        assert [data[a:b] for a, b in zip(cuts, cuts[1:])] == [codec.pieces[i] for i in mine]


def test_merge_of_long_slices(encoding):
    ranks, library = encoding
    for piece in ("aaab" * 60, "the" * 50, "xyz" * 200):
        assert merge_slice(piece.encode(), ranks.value) == library.encode_ordinary(piece)


def test_dataframe_edge_cases(spark, encoding):
    ranks, library = encoding
    rows = [(1, None, "z"), (None, "hello world", "z"), (2, "hello world", "z"), (2, "hello world", "z"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = decode_ids(encode_texts(df, ranks), ranks).collect()
    expected = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r[0], list(r[1]), bytes(r[2])) for r in got), key=str) == sorted(expected, key=str)
    assert encode_texts(df.limit(0), ranks).count() == text_digests(df.limit(0), ranks).count() == 0
    both = token_digests(decode_ids(encode_texts(df, ranks), ranks)), text_digests(df, ranks)
    assert both[0].columns == both[1].columns and len({str(sorted(map(str, b.collect()))) for b in both}) == 1


def test_query(spark, sf, encoding):
    _, library = encoding
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_pipeline_tokens_take_one_worker_a_task(spark, encoding):
    ranks, library = encoding
    rows = [(k, t, "en", "web", len(t)) for k, t in enumerate(TEXTS * 3)] + [(None, None, None, None, None), (3, "a b", "en", "web", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    out = dict(corpus_pipeline.STAGES)["tokens"](spark, df, None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    expected = []
    for k, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((k, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    for got in (out, token_digests(decode_ids(encode_texts(df, ranks), ranks))):
        assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_ids_that_are_null_or_unknown(spark, encoding):
    ranks, _ = encoding
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: (r["ids"], bytes(r["decoded"])) for r in decode_ids(df.coalesce(1), ranks).collect()}
    pieces = {r: p for p, r in ranks.value.items()}
    assert got == {1: (None, b""), 2: ([], b""), 3: ([64, 65], pieces[64] + pieces[65])}
    for bad in (-1, 10**6):
        with pytest.raises(Exception):
            decode_ids(spark.createDataFrame([(1, [bad])], "doc_id long, ids array<int>"), ranks).collect()
