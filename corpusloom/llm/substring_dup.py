"""Removal of repeated passages: anchors at difference-cover positions, extended to windows of words."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import as_bytes, mapped, store, table
from corpusloom.llm.shingles import SPACE, mix
from corpusloom.operators.joins import hot_keys, left_lookup
from corpusloom.session import scratch_path

# Difference sets. Any two positions have a common offset below the period at which both,
# modulo the period, are in the set.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
WIDTH = 50
# Rows sampled to find keys that need a broadcast instead of a shuffle: a hundredth, within these
# bounds. The sample decides on the route of a row only, never on the result.
SAMPLE_LEAST, SAMPLE_MOST, OFTEN, MOST_HOT = 100_000, 10_000_000, 20, 10_000
# Words above this many bytes are hashed one by one.
_LONG_WORD = 64
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LAST_ID = 2**63 - 1


def cover(width: int) -> tuple[int, tuple[int, ...]]:
    """The period and the cover for windows of ``width`` words; an anchor has ``width - period + 1`` words."""
    period = max(p for p in COVERS if p == 1 or 5 * p <= 3 * width + 5)
    return period, COVERS[period]


def word_hashes(data: bytes, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every word of a UTF-8 text, in order; the two lanes are independent.

    Words are folded eight bytes at a time, all words at once.
    """
    raw = np.zeros(len(data) + 8, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~SPACE[raw[: len(data)]], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    blocks = np.ndarray((len(data) + 1,), "<u8", raw.data, strides=(1,))
    length = (end - start).astype(np.int64)
    value = mix(length.astype(np.uint64) * _ODD[lane] + np.uint64(lane))
    short = length <= _LONG_WORD
    for k in range(0, min(int(length.max()), _LONG_WORD), 8):
        at = np.flatnonzero(short & (length > k))
        spare = np.maximum(8 - (length[at] - k), 0).astype(np.uint64) * np.uint64(8)
        block = (blocks[start[at] + k] << spare) >> spare
        value[at] = mix((value[at] * _ODD[lane]) ^ block)
    for k in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[start[k] : end[k]], digest_size=8, salt=bytes([lane])).digest()
        value[k] = np.frombuffer(digest, "<u8")[0]
    return value


def sequence_hashes(words: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """A hash of every ``width`` consecutive words, from hashes of 1, 2, 4 ... words."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, at, size, level = np.zeros(count, np.uint64), 0, 1, words
    while True:
        if width & size:
            total = mix(total * _ODD[lane] + level[at : at + count])
            at += size
        if at == width:
            return total
        level = mix((level[: len(level) - size] * _ODD[lane]) ^ level[size:])
        size *= 2


def anchor_positions(count: int, width: int) -> np.ndarray:
    """The cover positions among the first ``count``, ascending."""
    period, offsets = cover(width)
    places = (np.arange(0, count, period)[:, None] + np.array(offsets)).ravel()
    return places[places < count]


def anchors(data: bytes, width: int) -> np.ndarray:
    """The anchor hashes of a text, in order of position; none for a text without a whole window."""
    words = word_hashes(data)
    if len(words) < width:
        return np.empty(0, np.uint64)
    found = sequence_hashes(words, width - cover(width)[0] + 1)
    return found[anchor_positions(len(found), width)]


def windows_around(data: bytes, width: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and two hashes of the windows that hold one of the anchors numbered ``shared``, within the reach of the period."""
    period = cover(width)[0]
    lanes = [sequence_hashes(word_hashes(data, lane), width, lane) for lane in (0, 1)]
    count = len(lanes[0])
    at = anchor_positions(count + period - 1, width)[shared]
    near = np.zeros(count + 1, np.int64)
    np.add.at(near, np.minimum(np.maximum(at - period + 1, 0), count), 1)
    np.add.at(near, np.minimum(at + 1, count), -1)
    starts = np.flatnonzero(np.cumsum(near[:count]) > 0)
    return starts, lanes[0][starts], lanes[1][starts]


def spans_of(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The word ranges that windows at these starts cover, merged."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    breaks = np.flatnonzero(np.diff(starts) > width) + 1
    return [(int(run[0]), int(run[-1]) + width) for run in np.split(starts, breaks)]


def kept_words(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """The number of words, of words in ``spans``, and the others joined by one space."""
    words = data.split()  # ASCII white space, as in SPACE
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def bounds(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the least and greatest ``id`` of their key, as ``first`` and ``last``.

    Keys frequent in a sample, at most ``MOST_HOT``, are aggregated in the tasks, and their rows look the
    result up in a map without a shuffle; the other keys are too rare to burden one task and are
    shuffled once.
    """
    spark, total = rows.sparkSession, rows.count()
    share = min(1.0, max(SAMPLE_LEAST, min(total / 100, SAMPLE_MOST)) / max(total, 1))
    often = rows.sample(share, 17).groupBy(keys[0]).count().filter(F.col("count") >= OFTEN)
    often = often.orderBy(F.desc("count")).limit(MOST_HOT).select(keys[0]).collect()
    ends = F.min("id").alias("first"), F.max("id").alias("last")
    key = W.partitionBy(*keys)

    def within(part: DataFrame) -> DataFrame:
        return part.select("*", F.min("id").over(key).alias("first"), F.max("id").over(key).alias("last"))

    if not often:
        return within(rows)
    name = F.col(keys[0])
    found = rows.filter(name.isin([r[0] for r in often])).groupBy(*keys).agg(*ends).toPandas()
    # The first part of a key tells frequent keys apart; one that does not goes with the rare ones.
    found = found.drop_duplicates(keys[0], keep=False).sort_values(keys[0])
    if found.empty:
        return within(rows)
    names, first, last = (found[c].to_numpy() for c in (keys[0], "first", "last"))
    hot = name.isin(names.tolist())

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.searchsorted(names, batch.column(keys[0]).to_numpy())
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(first[at]), pa.array(last[at])], [*batch.schema.names, "first", "last"])

    cold = within(rows.filter(~hot))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    looked_up = mapped(rows.filter(hot), look_up, f"{schema}, first long, last long")
    return cold.select(looked_up.columns).union(looked_up)


def _bucketed(df: DataFrame, keys: list[str]) -> DataFrame:
    """A stored table in buckets by ``keys``, so that joins on them move the other side only."""
    spark = df.sparkSession
    name, buckets = f"corpusloom_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", scratch_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def _with_anchors(df: DataFrame, width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [pa.array(anchors(t, width).view(np.int64)) for t in as_bytes(batch.column("text"))]
        offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(found))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "hashes"])

    return mapped(df, run, "id long, k long, text string, hashes array<long>")


def _windows(df: DataFrame, width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists, texts = batch.column("shared"), as_bytes(batch.column("text"))
        found = [windows_around(t, width, s.values.to_numpy()) for t, s in zip(texts, lists)]
        sizes = [len(f[0]) for f in found]
        keys = [np.repeat(batch.column(c).to_numpy(), sizes) for c in ("id", "k")]
        parts = [np.concatenate([f[n] for f in found]) for n in range(3)]
        arrays = [*keys, parts[0].astype(np.int32), parts[1].view(np.int64), parts[2].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["id", "k", "start", "w1", "w2"])

    return mapped(df, run, "id long, k long, start int, w1 long, w2 long")


def _results(df: DataFrame, width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, starts in zip(as_bytes(batch.column("text")), batch.column("starts")):
            spans = spans_of(starts.values.to_numpy(), width) if starts.is_valid else []
            n, gone, kept = kept_words(text, spans)
            out.append((n, gone, [{"start": a, "end": b} for a, b in spans], hashlib.sha256(kept).hexdigest()))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), span, pa.string()]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("k"), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]],
            ["id", "k", "n_words", "n_removed", "spans", "kept_sha256"])

    return mapped(df, run, "id long, k long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_sha256 string")


def repeated_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept_sha256)`` per row: word ranges that earlier documents hold.

    A word goes if a window of ``width`` words over it occurs, starting anywhere, in a document with a
    smaller id. Of equal texts only that of the smallest id is searched; the others go whole. Words of a
    text are hashed at the cover positions only. Two equal windows hold one of these anchors at the same
    offset, so windows are hashed (128 bits) and compared only around anchors that several ids share.
    The texts are shuffled once, into buckets; later joins bring anchors and windows to them.

    Null texts are empty; a null id counts as the greatest. Rows of one id never remove each other's
    words, so repeated rows have equal results. Texts shorter than ``width`` words stay whole. Extra
    columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("id"),
        F.xxhash64("text").alias("k"), F.xxhash64(F.lit(width), "text").alias("k2"))
    leads = store(rows.groupBy("k", "k2").agg(F.min("id").alias("id"), F.count("*").alias("n")), "leads")
    texts = rows.groupBy("id", "k").agg(F.first("text").alias("text"))
    texts = _bucketed(_with_anchors(texts.join(leads.select("id", "k"), ["id", "k"], "left_semi"), width), ["id", "k"])

    places = texts.select("id", "k", F.posexplode("hashes").alias("place", "hash"))
    shared = bounds(places, ["hash"]).filter("first <> last")
    shared = shared.groupBy("id", "k").agg(F.collect_list("place").alias("shared"))
    around = store(_windows(texts.join(shared, ["id", "k"]).select("id", "k", "text", "shared"), width), "windows")
    removed = bounds(around, ["w1", "w2"]).filter("first < id")
    removed = removed.groupBy("id", "k").agg(F.collect_list("start").alias("starts"))
    found = _results(texts.join(removed, ["id", "k"], "left").select("id", "k", "text", "starts"), width)

    key = F.concat_ws(" ", "k", "k2")
    found = found.join(leads, ["id", "k"]).select(key.alias("key"), "id", "n_words", "n_removed", "spans", "kept_sha256")
    found = store(found.withColumnRenamed("id", "lead"), "results")
    hot = hot_keys(leads.filter(F.col("n") >= OFTEN).select(key.alias("key"), "n"), "key", "n")
    judged = left_lookup(rows.select("doc_id", "id", key.alias("key")), found, "key", hot)
    whole = (F.col("id") > F.col("lead")) & (F.col("n_words") >= width)
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return judged.select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, everything).otherwise(F.col("spans")).alias("spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = rf"""
WITH words AS (
  SELECT doc_id, coalesce(doc_id, {_LAST_ID}) AS id, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, id, s, sha256(array_to_string(w[s:s + {WIDTH - 1}], ' ')) AS h
  FROM (SELECT r, id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS s FROM words WHERE len(w) >= {WIDTH})),
removed AS (
  SELECT r, s FROM (SELECT r, s, id, min(id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < id),
covered AS (SELECT DISTINCT r, unnest(range(s, s + {WIDTH})) AS place FROM removed),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words) ANTI JOIN covered USING (r, place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r)
"""
