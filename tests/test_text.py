"""Text expressions against plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from corpusloom.functions import text as tx

SAMPLES = [
    " \x1c a b　\n", "​ x", "", "   ", None, "\u0085a  ", "tab\tin\x0bside",
    "بِسْمِ الله", "ﷺ １２", "naïve café 42x", "漢字kanaカナ",
    "a<ctl>b", "one\n\ntwo \r\n", "\U0001f600 ok", "x  y",
]


def frame(spark, values=SAMPLES):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string")


def column(spark, expression, values=SAMPLES):
    rows = frame(spark, values).select("id", expression.alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["id"])]


def test_strip_and_clean_match_python(spark):
    assert column(spark, tx.strip_text(F.col("t"))) == [s if s is None else s.strip() for s in SAMPLES]
    assert column(spark, tx.clean_or_null(F.col("t"))) == [(s or "").strip() or None for s in SAMPLES]


def test_every_whitespace_code_point(spark):
    values = [f"{chr(c)}a{chr(c)}" for c in range(1, 0x3100) if chr(c).isspace() or c in (0x200B, 0x180E, 0x2060)]
    assert column(spark, tx.strip_text(F.col("t")), values) == [v.strip() for v in values]


def test_split_and_collapse_match_python(spark):
    given = [s for s in SAMPLES if s is not None]
    assert column(spark, tx.split_words(F.col("t")), given) == [s.split() for s in given]
    assert column(spark, tx.collapse_whitespace(F.col("t")), given) == [" ".join(s.split()) for s in given]


def test_nfkc(spark):
    expected = [s if s is None else unicodedata.normalize("NFKC", s) for s in SAMPLES]
    assert column(spark, tx.nfkc_normalize("t")) == expected


def test_bert_normalize_drops_arabic_marks_and_case(spark):
    got = column(spark, tx.bert_normalize(F.col("t")), ["بِسْمِ", "École\u0000 A", "漢字"])
    assert got == ["بسم", "ecole a", " 漢  字 "]
    assert column(spark, tx.bert_normalize(F.col("t"), lowercase=False), ["É"]) == ["É"]


def test_pretokenize_cuts_digits_and_scripts(spark):
    got = column(spark, tx.pretokenize(F.col("t"), True, True), ["ab12 بسx,y", "بِس"])
    assert got == [["▁ab", "1", "2", "▁بس", "x", ",", "y"], ["▁بِس"]]
    assert column(spark, tx.pretokenize(F.col("t")), ["ab12 c"]) == [["▁ab12", "▁c"]]


def test_pretokenize_loses_nothing(spark):
    rng = random.Random(5)
    alphabet = "abé1٢ ,.بً漢カαЖ▁-\U0001f600"
    values = ["".join(rng.choice(alphabet) for _ in range(25)) for _ in range(200)]
    for digits in (False, True):
        for scripts in (False, True):
            got = column(spark, tx.pretokenize(F.col("t"), digits, scripts), values)
            assert ["".join(g) for g in got] == ["".join("▁" + w for w in v.split()) for v in values]


def test_split_symbols_longest_first(spark):
    values = ["xthe***th", "***", "", "a.b"]
    expected = [[p for p in re.split(r"(\*\*\*|the|th)", v) if p] for v in values]
    assert column(spark, tx.split_symbols(F.col("t"), ["th", "the", "***"]), values) == expected
