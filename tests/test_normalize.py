"""The trainer's normalisation against the public library: every character, decompositions, mixed strings."""

import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.normalize import replacements, trainer_normalize

spm = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    options = dict(add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    return spm.SentencePieceNormalizer(rule_name="nmt_nfkc", **options).normalize


CODES = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]


def test_every_character(library):
    rule = replacements()
    assert [c for c in CODES if rule.apply(chr(c)) != library(chr(c))] == []


def test_every_decomposition(library):
    rule = replacements()
    texts = {unicodedata.normalize(form, chr(c)) for c in CODES for form in ("NFD", "NFKD")}
    texts = [t for t in texts if len(t) > 1]
    assert len(texts) > 13_000
    assert [t for t in texts if rule.apply(f"a{t}b") != library(f"a{t}b")] == []


def test_mixed_strings(library):
    rule, rng = replacements(), random.Random(1)
    marks = [chr(c) for c in CODES if unicodedata.combining(chr(c))]
    composed = [chr(c) for c in CODES if unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    parts = [unicodedata.normalize("NFKD", c) for c in composed]
    alphabet = [chr(c) for c in CODES if unicodedata.category(chr(c)) != "Cn"]
    for _ in range(4000):
        kinds = rng.choices([marks, composed, parts, alphabet, list("aeou Aき ㄱㅏㄱㅏﾞｶ")], k=rng.randrange(1, 25))
        text = "".join(rng.choice(kind) for kind in kinds)
        assert rule.apply(text) == library(text), ascii(text)


def test_column(spark):
    rows = [(None,), ("",), ("ﬁ​Ａ̊\t",), ("ệ x" * 1000,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").coalesce(1).select(trainer_normalize(F.col("t"))).collect()]
    assert got[:3] == [None, "", "fi Å "] and got[3] == "ệ x" * 1000
