"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import mapped, table
from corpusloom.llm.shingles import SPACE, mix, word_hashes

# Lanes of 64 bits, uniformly hashed: equal sums mean equal paragraphs. Lanes of 32 bits for likeness.
EQUAL_LANES, LIKE_LANES = 8, 128
# Consecutive documents that one group of the edit job holds, and the most groups there are.
GROUP_ROWS, MOST_GROUPS = 1000, 10_000
_ZERO = (np.zeros(EQUAL_LANES, np.uint64), np.zeros(LIKE_LANES, np.uint32))
Print = tuple[np.ndarray, np.ndarray]


def paragraphs(text: str) -> list[str]:
    """The lines of a text; an empty text has none."""
    return text.split("\n") if text else []


def _likeness_lanes(parts: list[str]) -> np.ndarray:
    """Count sketch of the word pairs within each paragraph (of the word where it is alone)."""
    data = "\n".join(parts).encode("utf-8", "replace")
    words = word_hashes(data)  # of all paragraphs at once: a word's hash does not depend on its place
    if not len(words):
        return _ZERO[1].copy()
    raw = np.frombuffer(data, np.uint8)
    inside = ~SPACE[raw]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    line = np.searchsorted(np.flatnonzero(raw == ord("\n")), starts)
    pair = mix(words[:-1] * np.uint64(3) + words[1:])[line[:-1] == line[1:]]
    single = words[np.bincount(line)[line] == 1]
    units = np.concatenate((pair, mix(single)))
    lane = (units % np.uint64(LIKE_LANES)).astype(np.int64)
    sign = 1.0 - 2.0 * ((units >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    return np.bincount(lane, sign, LIKE_LANES).astype(np.int64).astype(np.uint32)


def print_of(parts: list[str]) -> Print:
    """The fingerprint of paragraphs: a sum, so their order does not matter."""
    equal = _ZERO[0].copy()
    for part in parts:
        wide = hashlib.shake_128(part.encode("utf-8", "replace")).digest(8 * EQUAL_LANES)
        equal += np.frombuffer(wide, "<u8")
    return equal, _likeness_lanes(parts)


def insert(a: Print, b: Print) -> Print:
    """The fingerprint with the paragraphs of ``b`` added, modulo 2**64 and 2**32 by lane."""
    return a[0] + b[0], a[1] + b[1]


def delete(a: Print, b: Print) -> Print:
    """The fingerprint with the paragraphs of ``b`` taken away."""
    return a[0] - b[0], a[1] - b[1]


def likeness(a: Print, b: Print) -> float:
    """1 for equal fingerprints; else the shared part of the paragraphs' word pairs, estimated, 0 to 1."""
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    total = (x * x).sum() + (y * y).sum()
    return float(min(1.0, max(0.0, 1.0 - ((x - y) ** 2).sum() / total))) if total else 0.0


def to_text(a: Print) -> str:
    return base64.b64encode(a[0].astype("<u8").tobytes() + a[1].astype("<u4").tobytes()).decode()


def from_text(text: str) -> Print:
    raw = base64.b64decode(text)
    return np.frombuffer(raw[: 8 * EQUAL_LANES], "<u8"), np.frombuffer(raw[8 * EQUAL_LANES :], "<u4")


def edited_print(before: Print, old: str, new: str) -> Print:
    """The fingerprint of ``new`` from that of ``old``: only paragraphs from the first changed one on are hashed."""
    was, now = paragraphs(old), paragraphs(new)
    same = 0
    while same < min(len(was), len(now)) and was[same] == now[same]:
        same += 1
    return insert(delete(before, print_of(was[same:])), print_of(now[same:]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` per row; a null text is empty. A map without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [to_text(print_of(paragraphs(t or ""))) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, fingerprint string")


def _edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group, own rows first; each is edited with the one after it."""
    previous = group = None

    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("grp", "lead", "doc_id", "text"))
        for key, lead, doc_id, text in zip(*columns):
            text = text or ""
            if key != group:
                group, previous = key, None
            elif previous is None:
                continue  # the group is over
            own = print_of(paragraphs(text))
            if previous is not None:
                out.append(_edited_row(*previous, text, own))
            previous = None if lead else (doc_id, text, own)
        if out:
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _edited_row(doc_id, text: str, own: Print, after: str, after_print: Print) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + after[:cut]
    changed = edited_print(own, text, edited)
    digest = hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest()
    return doc_id, len(text), digest, to_text(own), to_text(changed), likeness(own, changed), likeness(own, after_print)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint next to that of its edited text, and their likeness.

    The edited text has its last third (rounded down, in code points) replaced by the first as many
    code points of the next document in descending ``doc_id``, or all of them; after the last comes
    the first. The next document need not be found by one global sort: quantiles of ``doc_id`` cut
    the order into groups, the largest id of each group is also sent to the group above it (that of
    all to the lowest), and each group is then complete in itself. Text is shuffled once.

    Null ids come last; equal ids are ordered by text; a document alone follows itself. Null texts
    are empty; an empty text has the zero fingerprint. Extra columns are ignored; an empty table gives no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(key.alias("key"))
    n = min(MOST_GROUPS, max(1, ids.count() // GROUP_ROWS))
    cuts = np.unique(np.array(ids.approxQuantile("key", [k / n for k in range(1, n)], 0.2 / n), np.float64)) if n > 1 else np.empty(0)

    def group_of(values):
        return np.searchsorted(cuts, np.asarray(values, np.float64), side="left")

    @F.pandas_udf("int")
    def grouped(keys):
        import pandas as pd

        return pd.Series(group_of(keys), dtype="int32")

    # One row per group, at most MOST_GROUPS.
    largest = dict(sorted(ids.groupBy(grouped("key").alias("grp")).agg(F.max("key")).collect()))
    order = list(largest)
    above = {largest[g]: order[k + 1] for k, g in enumerate(order) if k + 1 < len(order)}
    if order:
        above.setdefault(largest[order[-1]], order[0])

    @F.pandas_udf("array<int>")
    def places(keys):
        import pandas as pd

        own = group_of(keys).tolist()
        return pd.Series([[g, above[k]] if k in above else [g] for g, k in zip(own, keys.tolist())])

    rows = docs.select(F.posexplode(places(key)).alias("pos", "grp"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("grp", (F.col("pos") > 0).alias("lead"), "doc_id", "text").repartition("grp")
    rows = rows.sortWithinPartitions("grp", "lead", F.col("doc_id").desc_nulls_last(), "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
    return rows.mapInArrow(_edit, schema)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
