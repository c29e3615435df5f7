"""Presets and the chain from shards to a stored vocabulary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.normalize import trainer_normalize
from corpusloom.functions.numbers import coerce_duration, head_target, run_name
from corpusloom.functions.text import clean_or_null, collapse_whitespace
from corpusloom.operators.hygiene import dedup_shards
from corpusloom.operators.manifest import audio_name
from corpusloom.operators.sampling import OrderedCorpus, cap_rows, sample_sentences, stride_sample
from corpusloom.operators.stats import bert_word_counts, segment_counts
from corpusloom.operators.vocab.bpe import train_bpe, train_wordpiece
from corpusloom.operators.vocab.simple import train_char, train_word
from corpusloom.operators.vocab.unigram import train_unigram
from corpusloom.sources.schema import DURATION, MANIFEST_TEXT_ORDER, SPLIT_SHARDS
from corpusloom.sources.audio_files import export_audio
from corpusloom.sources.shards import find_shards, text_fallback, text_of_files
from corpusloom.sources.sinks import (
    write_manifest, write_run_manifest, write_vocab, write_wordpiece_vocab,
)
from corpusloom.sources.text import read_manifest

# The two presets and the defaults they start from.
DEFAULTS = {
    "vocab_size": 8000, "model_type": "bpe", "character_coverage": 0.9995, "split": "train",
    "percent": 100.0, "max_samples": None, "num_files": None, "text_column": "text_ar_uthmani",
    "num_threads": 8,
}
PRESETS = {
    "local-subset": {"num_files": 10},
    "runpod-full": {"num_files": SPLIT_SHARDS["train"], "percent": 100.0},
}
TRAINERS = {"bpe": train_bpe, "unigram": train_unigram, "char": train_char, "word": train_word}


def preset_options(profile: str, **given: Any) -> dict[str, Any]:
    """Defaults, then given options; a preset fills the file count and the full one the percent."""
    options = {**DEFAULTS, **given, "profile": profile}
    preset = PRESETS[profile]
    if options["num_files"] is None:
        options["num_files"] = preset["num_files"]
    if "percent" in preset or options["percent"] is None:
        options["percent"] = preset.get("percent", 100.0)
    return options


def corpus_texts(spark: SparkSession, root: str, options: dict[str, Any]) -> DataFrame:
    """Clean texts of the chosen shards. Row numbers are used only when a rule needs them."""
    percent, cap = options["percent"], options["max_samples"]
    numbered = percent < 100 or cap is not None
    texts = text_fallback(
        spark, root, options["split"], options["text_column"], num_files=options["num_files"],
        positions=numbered,
    )
    if numbered:
        texts = OrderedCorpus(spark, texts.inputFiles()).number(texts)
        texts = stride_sample(cap_rows(texts, cap), percent)
    return texts.select(clean_or_null(F.col("text")).alias("text")).filter("text is not null")


def train(spark: SparkSession, texts: DataFrame, options: dict[str, Any]) -> DataFrame:
    """Vocabulary of a model type over clean texts."""
    model = options["model_type"]
    counts = segment_counts(texts, split_scripts=model in ("bpe", "unigram"))
    extra = {} if model == "word" else {"coverage": options["character_coverage"]}
    return TRAINERS[model](spark, counts, options["vocab_size"], **extra)


def build_vocabulary(
    spark: SparkSession, root: str, output_dir: str, profile: str = "local-subset", **given: Any
) -> DataFrame:
    """Shards to a stored vocabulary with a record of the run next to it."""
    options = preset_options(profile, **given)
    vocab = train(spark, corpus_texts(spark, root, options), options)
    name = run_name("spe", options["vocab_size"], options["model_type"])
    write_vocab(vocab, f"{output_dir}/{name}")
    record = {
        **options, "timestamp_utc": datetime.now(timezone.utc).isoformat(), "output_dir": output_dir,
        "local_data_dir": root, "build_command": [f"{k}={v}" for k, v in sorted(given.items())],
    }
    write_run_manifest(spark, f"{output_dir}/run_manifest", record)
    return vocab


def train_from_lines(
    spark: SparkSession, lines: DataFrame, output_dir: str, tokenizer: str = "wpe",
    vocab_size: int = 1024, spe_type: str = "bpe", coverage: float = 1.0,
    bos: bool = False, eos: bool = False, pad: bool = False,
    user_symbols: Sequence[str] = (), control_symbols: Sequence[str] = (),
    split_digits: bool = False, split_scripts: bool = True, remove_extra_whitespaces: bool = False,
    nfkc: bool = False, lowercase: bool = True, sample_size: int = -1, sample_key: Sequence[str] = ("value",),
    max_piece_length: int = -1, byte_fallback: bool = False,
) -> DataFrame:
    """Vocabulary of a corpus of lines (``value``), stored under a folder named by its options.

    ``wpe`` is WordPiece over BERT-normalised text, where ``lowercase`` also drops marks. ``spe``
    is one of the four model types; there ``lowercase`` folds case and ``nfkc`` normalises by the trainer's rule.
    ``sample_key`` must identify a line for ``sample_size`` to be exact.
    """
    rows = sample_sentences(lines, sample_size, list(sample_key))
    text = F.col("value")
    if tokenizer == "wpe":
        vocab = train_wordpiece(spark, bert_word_counts(rows, "value", lowercase), vocab_size)
        write_wordpiece_vocab(vocab, f"{output_dir}/{run_name('wpe', vocab_size)}")
        return vocab
    text = trainer_normalize(text) if nfkc else text
    text = F.lower(text) if lowercase else text
    text = collapse_whitespace(text) if remove_extra_whitespaces else text
    pieces = spe_type in ("bpe", "unigram")
    words = segment_counts(
        rows.select(text.alias("text")), "text", split_digits and pieces, split_scripts and pieces,
        user_symbols,
    )
    extra: dict[str, Any] = {} if spe_type == "word" else {"coverage": coverage}
    if pieces and max_piece_length > 0:
        extra["max_piece_length"] = max_piece_length
    vocab = TRAINERS[spe_type](
        spark, words, vocab_size, control=control_symbols, user=user_symbols,
        byte_fallback=byte_fallback, **extra,
    )
    write_vocab(vocab, f"{output_dir}/{run_name('spe', vocab_size, spe_type, max_piece_length, pad, bos, eos)}")
    return vocab


def build_manifest(
    spark: SparkSession, roots: Sequence[str], out_dir: str, split: str = "train",
    percent: float = 1.0, max_samples: int | None = None, total: str = "first_shard",
) -> DataFrame:
    """Shards below several roots to audio files and a manifest of the leading rows.

    Copies of a shard are dropped by fingerprint. ``max_samples`` overrides ``percent``. Only the
    files that hold a kept row are read.
    """
    listing = find_shards(spark, roots, split)
    kept = listing.join(dedup_shards(listing).select("path"), "path", "left_semi")
    texts = text_of_files(
        spark, kept, split, order=MANIFEST_TEXT_ORDER, keep=["audio", DURATION], positions=True
    )
    corpus = OrderedCorpus(spark, texts.inputFiles())
    cap = max_samples
    if cap is None and percent < 100:
        rows = corpus.total if total == "exact" else corpus.estimated_total
        cap = head_target(rows, percent)
    if cap is not None:
        texts = texts.filter(F.col("path").isin(corpus.files_below(cap)))
    numbered = cap_rows(corpus.number(texts), cap)
    audio = F.col("audio")
    rows = numbered.select(
        "ordinal", audio_name(audio, F.col("ordinal")).alias("name"), audio["bytes"].alias("payload"),
        coerce_duration(F.col(DURATION)).alias("duration"), "text", audio.isNull().alias("no_audio"),
    )
    exported = export_audio(
        rows, f"{out_dir}/audio", F.col("name"), F.col("payload"), ["duration", "text", "no_audio"]
    )
    path = F.when(F.col("no_audio"), F.lit("")).otherwise(F.col("audio_filepath"))
    target = f"{out_dir}/{split}_manifest"
    write_manifest(exported.withColumn("audio_filepath", path), target, rejects=f"{target}_rejects")
    return read_manifest(spark, target)
