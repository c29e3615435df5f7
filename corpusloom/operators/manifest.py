"""Training manifests: build, filter, validate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.numbers import coerce_duration
from corpusloom.operators.joins import hot_keys, left_lookup

# Shortest and longest utterance, in seconds.
MIN_DURATION = 0.1
MAX_DURATION = 20.0

# Reason codes of the reject table.
REASONS = (
    "missing_audio", "null_text", "bad_duration", "zero_duration", "duration_out_of_range",
    "duplicate_path",
)


def audio_name(audio: Column, ordinal: Column) -> Column:
    """File name of a row's audio: its own path, else one made from the row number."""
    made = F.format_string("sample_%06d.wav", ordinal)
    return F.coalesce(F.nullif(audio["path"], F.lit("")), made)


def has_bytes(audio: Column) -> Column:
    """Whether the audio struct carries a payload."""
    return F.coalesce(F.octet_length(audio["bytes"]) > 0, F.lit(False))


def audio_path(audio: Column, ordinal: Column, folder: str) -> Column:
    """Where the audio is: under ``folder`` when it has bytes, bare name without, "" if absent."""
    name = audio_name(audio, ordinal)
    stored = F.when(has_bytes(audio), F.concat_ws("/", F.lit(folder), name)).otherwise(name)
    return F.when(audio.isNull(), F.lit("")).otherwise(stored)


def manifest_rows(
    df: DataFrame, folder: str, audio: str = "audio", duration: str = "duration",
    text: str = "text", ordinal: str = "ordinal",
) -> DataFrame:
    """Manifest fields of a corpus scan; columns of one row stay aligned."""
    return df.select(
        F.col(ordinal),
        audio_path(F.col(audio), F.col(ordinal), folder).alias("audio_filepath"),
        coerce_duration(F.col(duration)).alias("duration"),
        F.col(text).alias("text"),
    )


def manifest_from_nested(df: DataFrame, take: int | None = None, ordinal: str = "ordinal") -> DataFrame:
    """Manifest of the variant with path and duration inside the audio struct.

    The first ``take`` rows are taken before rows without audio or path are dropped.
    """
    taken = df if take is None else df.filter(F.col(ordinal) < take)
    present = taken.filter(F.col("audio").isNotNull() & (F.col("audio.path") != ""))
    return present.select(
        F.col(ordinal),
        F.col("audio.path").alias("audio_filepath"),
        coerce_duration(F.col("audio.duration")).alias("duration"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def duration_filter(
    df: DataFrame, min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION
) -> DataFrame:
    """Rows whose duration lies in the closed range."""
    return df.filter(F.col("duration").between(min_duration, max_duration))


def manifest_rejects(
    df: DataFrame, raw_duration: str = "raw_duration", files: DataFrame | None = None,
    min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION,
) -> DataFrame:
    """Every row with ``reasons``, the codes it fails; an empty array means it is valid.

    A path is a duplicate when two or more rows carry it. Copies are counted per path with a
    partial aggregate and only repeated paths are joined back, hot paths by broadcast. ``files`` (column
    ``audio_filepath``) lists the audio that exists; without it that check is skipped.
    """
    copies = df.groupBy("audio_filepath").agg(F.count(F.lit(1)).alias("_copies"))
    hot = hot_keys(copies, "audio_filepath", "_copies")
    repeated = copies.filter("_copies > 1")
    rows = left_lookup(df, repeated, "audio_filepath", hot)
    missing = F.coalesce(F.col("audio_filepath") == "", F.lit(True))
    if files is not None:
        known = files.select("audio_filepath").distinct().withColumn("_known", F.lit(True))
        rows = left_lookup(rows, known, "audio_filepath", hot)
        missing = missing | F.col("_known").isNull()
    seconds = F.col(raw_duration).try_cast("double")
    checks = (
        missing,
        F.col("text").isNull(),
        seconds.isNull() | F.isnan(seconds),
        seconds == 0,
        (seconds != 0) & ~seconds.between(min_duration, max_duration),
        (F.col("audio_filepath") != "") & F.col("_copies").isNotNull(),
    )
    codes = [F.when(check, F.lit(code)) for code, check in zip(REASONS, checks)]
    kept = rows.withColumn("reasons", F.array_compact(F.array(*codes)))
    return kept.drop("_copies", "_known")


def manifest_validate(rejects: DataFrame) -> DataFrame:
    """One row of totals over :func:`manifest_rejects`."""
    counts = [
        F.count_if(F.array_contains("reasons", code)).alias(code) for code in REASONS
    ]
    return rejects.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.size("reasons") == 0).alias("valid"), *counts
    )
