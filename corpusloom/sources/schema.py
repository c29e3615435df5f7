"""Schemas of the files read and written."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, split sizes and preference orders of the corpus format.
SIMPLE_TEXT = "text_ar_simple"
MARKED_TEXT = "text_ar_uthmani"
DURATION = "ayah_duration_s"
CORPUS_TEXT_ORDER = (SIMPLE_TEXT, MARKED_TEXT)
MANIFEST_TEXT_ORDER = (MARKED_TEXT, SIMPLE_TEXT)
SPLIT_SHARDS = {"train": 771, "validation": 28, "test": 13}

AUDIO = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])

MANIFEST = T.StructType([
    T.StructField("audio_filepath", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("text", T.StringType()),
])

VOCABULARY = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("piece", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("kind", T.StringType(), False),
])
