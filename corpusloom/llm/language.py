"""Language identification by fusing text, declared markup language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import as_bytes, mapped, store, table
from corpusloom.llm.shingles import SPACE
from corpusloom.operators.joins import hot_keys, left_lookup

# Byte trigrams are counted in this many cells per language.
CELLS = 1 << 16
# More languages than this are refused: the counts are broadcast, 512 KiB for each.
MAX_LANGUAGES = 256
# Neighbouring trigrams overlap and depend on each other: their evidence counts for this share.
TEMPER = 0.3
# Pseudo-counts that each level of the prior takes from the level above it.
STRENGTH = 5.0
# A language is named at this posterior; below it, or without any letters, the answer is null.
MIN_POSTERIOR = 0.5
_CHUNK = 1 << 20
_FLUSH = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Everything in ASCII that is no letter is one separator.
_LOWER[SPACE] = 32
_LOWER[[b for b in range(128) if not chr(b).isalpha()]] = 32
TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&#?\w+;"


def cells(data: bytes | None) -> np.ndarray:
    """The cell of every byte trigram that is not all separators; A-Z count as a-z."""
    raw = _LOWER[np.frombuffer(b" " + (data or b"") + b" ", np.uint8)].astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    code = code[(raw[1:-1] != 32) | ((raw[:-2] != 32) & (raw[2:] != 32))]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def trigram_counts(docs: DataFrame, text: str, language: str) -> DataFrame:
    """``(language, cell, n)`` over all rows with a language; added up in each task before the shuffle."""

    def rows(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["language", "cell", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, data in zip(batch.column("language").to_pylist(), as_bytes(batch.column("text"))):
                if name not in counts:
                    if len(counts) >= _FLUSH:
                        yield from rows(counts)
                        counts = {}
                    counts[name] = np.zeros(CELLS, np.int64)
                for start in range(0, len(data or b""), _CHUNK):
                    counts[name] += np.bincount(cells(data[start : start + _CHUNK]), minlength=CELLS)
        yield from rows(counts)

    known = docs.select(F.col(language).alias("language"), F.col(text).alias("text")).filter("language IS NOT NULL AND text IS NOT NULL")
    counted = known.mapInArrow(count, "language string, cell int, n long")
    return counted.groupBy("language", "cell").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", language: str = "lang") -> tuple[list[str], Broadcast]:
    """The languages and the log-probability of each cell in each, from the counts of all labelled rows.

    What reaches the driver is at most ``CELLS`` rows for each of ``MAX_LANGUAGES`` languages; more
    languages raise a ValueError. Without labelled rows there are no languages.
    """
    counts = store(trigram_counts(docs, text, language), "trigrams")
    names = sorted(r[0] for r in counts.select("language").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    n = np.zeros((CELLS, len(names)))
    place = {name: k for k, name in enumerate(names)}
    for name in names:
        found = counts.filter(F.col("language") == name).select("cell", "n").toPandas()
        n[found["cell"].to_numpy(), place[name]] = found["n"].to_numpy()
    logs = np.log((n + 0.5) / (n.sum(0) + 0.5 * CELLS)).astype(np.float32) if names else n.astype(np.float32)
    return names, docs.sparkSession.sparkContext.broadcast(logs)


def text_evidence(rows: DataFrame, names: list[str], logs: Broadcast, keep: list[str]) -> DataFrame:
    """The columns of ``keep``, ``evidence`` (tempered log-likelihood per language, largest 0) and ``n_trigrams``."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, values, sizes = logs.value, [], []
        for data in as_bytes(batch.column("_text")):
            total, size = np.zeros(len(names)), 0
            for start in range(0, len(data or b""), _CHUNK):
                at = cells(data[start : start + _CHUNK])
                size += len(at)
                total += model[at].sum(0, dtype=np.float64)
            values.append(((total - total.max(initial=-np.inf)) * TEMPER).tolist() if names else [])
            sizes.append(size)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep] + [pa.array(values, pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
            [*keep, "evidence", "n_trigrams"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep]
    return mapped(rows.select(*keep, "_text"), score, ", ".join([*types, "evidence array<double>", "n_trigrams long"]))


def _normal(logs: str) -> str:
    """SQL for the probabilities of an array of log weights."""
    return (f"transform({logs}, x -> exp(x - array_max({logs})) / "
            f"aggregate({logs}, 0D, (a, y) -> a + exp(y - array_max({logs}))))")


def _sums(rows: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """``(key, n, name)``: rows and summed text posteriors of each non-null key."""
    grouped = rows.filter(F.col(key).isNotNull()).groupBy(key)
    return grouped.agg(F.count("*").alias(f"{name}_n"), F.array(*[F.sum(F.col("posterior")[k]) for k in range(size)]).alias(name))


def fuse(rows: DataFrame, names: list[str], levels: list[str], declared: str | None) -> DataFrame:
    """Adds ``language`` and ``probability`` to rows with ``evidence`` and ``n_trigrams``.

    The prior starts from the shares of the text posteriors over all rows and is refined level by
    level (``levels``, widest first): every level's grouped sums, without the row's own share, are
    smoothed by ``STRENGTH`` pseudo-counts of the level above. The declared language counts by how
    often it stands with each text language over all rows; declarations that name no known language
    are one value, null another. Hot keys meet their sums by broadcast of a bounded table.
    """
    size = len(names)
    if not size:
        return rows.withColumns({"language": F.lit(None).cast("string"), "probability": F.lit(None).cast("double")})
    # Rows without trigrams give no evidence and add nothing to the sums.
    silent = f"array_repeat(0D, {size})"
    rows = store(rows.withColumn("posterior", F.expr(f"CASE WHEN n_trigrams > 0 THEN {_normal('evidence')} ELSE {silent} END")), "evidence")
    total = rows.agg(*[F.coalesce(F.sum(F.col("posterior")[k]), F.lit(0.0)) for k in range(size)]).first()
    base = (np.array(total) + 1.0) / (sum(total) + size)
    rows = rows.withColumn("prior", F.array(*[F.lit(float(p)) for p in base]))
    for level in levels:
        sums = store(_sums(rows, level, size, "seen"), "level")
        rows = left_lookup(rows, sums, level, hot_keys(sums, level, "seen_n"))
        rows = rows.withColumn("prior", F.expr(
            f"CASE WHEN seen IS NULL THEN prior ELSE transform(prior, (p, k) -> (greatest(seen[k] - posterior[k], 0D) + {STRENGTH} * p)"
            f" / (aggregate(seen, 0D, (a, x) -> a + x) - aggregate(posterior, 0D, (a, x) -> a + x) + {STRENGTH})) END")).drop("seen", "seen_n")
    logs = "transform(evidence, (x, k) -> ln(prior[k]) + x{})"
    if declared:
        value = F.when(F.col(declared).isin(names), F.col(declared)).when(F.col(declared).isNotNull(), F.lit("other"))
        rows = rows.withColumn("said", F.coalesce(value, F.lit("none")))
        # One row for each language and two more: bounded by MAX_LANGUAGES.
        seen = {r["said"]: np.array(r["seen"]) for r in _sums(rows, "said", size, "seen").collect()}
        kinds = [*names, "other", "none"]
        table_ = np.array([seen.get(k, np.zeros(size)) for k in kinds]) + 0.5
        table_ = np.log(table_ / table_.sum(0))
        given = F.create_map(*[F.lit(v) for k, row in zip(kinds, table_.tolist()) for v in (k, row)])
        rows = rows.withColumn("told", given[F.col("said")]).withColumn("fused", F.expr(logs.format(" + told[k]"))).drop("told", "said")
    else:
        rows = rows.withColumn("fused", F.expr(logs.format("")))
    rows = rows.withColumn("fused", F.expr(_normal("fused")))
    rows = rows.withColumn("probability", F.array_max("fused"))
    best = F.get(F.array(*[F.lit(n) for n in names]), F.expr("array_position(fused, probability) - 1").cast("int"))
    sure = (F.col("n_trigrams") > 0) & (F.col("probability") >= MIN_POSTERIOR)
    return rows.withColumn("language", F.when(sure, best)).drop("prior", "fused", "posterior")


def host_levels(url: Column) -> dict[str, Column]:
    """Address suffix, domain (last two labels) and host of a URL; null where there is no ``://``."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    host = F.when(host != "", F.regexp_replace(host, r"^[^@]*@|:\d*$", ""))
    return {"suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2), "host": host}


def declared_language(html: Column) -> Column:
    """The primary subtag of the ``lang`` attribute of a page's ``html`` element; null if none."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([a-z]+)""", 1))
    return F.when(found != "", found)


def identify_pages(pages: DataFrame, names: list[str], logs: Broadcast) -> DataFrame:
    """``(page_id, host, declared, n_trigrams, language, probability)`` per row of pages.

    Text is the page without tags, scripts, styles and entities. Null or letterless pages get a null
    language, as do pages whose best posterior is below ``MIN_POSTERIOR``. Null URLs have only the
    corpus-wide prior. Repeated rows are answered row by row and count as rows; equal posteriors go
    to the first language by code point; extra columns are ignored; an empty table gives none.
    """
    rows = pages.select("page_id", *[c.alias(k) for k, c in host_levels(F.col("url")).items()],
                        declared_language(F.col("html")).alias("declared"), F.regexp_replace("html", TAGS, " ").alias("_text"))
    found = text_evidence(rows, names, logs, ["page_id", "suffix", "domain", "host", "declared"])
    return fuse(found, names, ["suffix", "domain", "host"], "declared").select(
        "page_id", "host", "declared", "n_trigrams", "language", "probability")


def row_key() -> Column:
    """Tells documents apart; rows with equal key are equal in all that the decision rests on."""
    return F.xxhash64("doc_id", "source", "text")


def identify_documents(docs: DataFrame, names: list[str], logs: Broadcast) -> DataFrame:
    """``(row_key, n_trigrams, language, probability)`` per row of documents; the source is the host.

    Documents have no address or markup. Null, empty and letterless texts get a null language. Texts
    do not travel beyond the first map.
    """
    rows = docs.select(row_key().alias("row_key"), F.col("source").alias("host"), F.col("text").alias("_text"))
    found = text_evidence(rows, names, logs, ["row_key", "host"])
    return fuse(found, names, ["host"], None).select("row_key", "n_trigrams", "language", "probability")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, logs = fit(table(spark, sf_dir, "documents"))
    return identify_pages(table(spark, sf_dir, "pages"), names, logs)
