"""A corpus pipeline: language, toxicity, near-duplicates, mixing and tokens, each stage stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe, language, mixing, near_dup, toxicity
from corpusloom.llm.common import prepare, store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; those without letters, or of none for sure, go."""
    prepare(spark)
    names, logs = language.fit(docs)
    found = language.identify_documents(docs, names, logs).filter("language IS NULL")
    rejected = store(found.select(F.col("row_key").alias("r_key")).distinct(), "rejected")
    return docs.select(COLUMNS).join(rejected, language.row_key() == F.col("r_key"), "left_anti")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the field predicts as toxic. Repeated rows of an id are judged one by one."""
    prepare(spark)
    field = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return toxicity.filter_toxic(docs.select(COLUMNS), field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; of rows that repeat its id, one with its text."""
    prepare(spark)
    found = near_dup.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("k_id")).distinct()
    kept = docs.select(COLUMNS).join(found, F.col("doc_id").cast("long") == F.col("k_id")).select(COLUMNS)
    # Ids repeat only where the input repeats them.
    kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.union(docs.select(COLUMNS).filter("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole copies, and the first words of the last one."""
    prepare(spark)
    return mixing.take(docs.select(COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every copy: encoded, decoded and digested in one map."""
    import public_tokenizers

    prepare(spark)
    ranks = byte_bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.text_digests(docs, ranks)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]
# The language model, the field and byte-pair merging are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
