"""MinHash near-duplicates: banded one-permutation signatures, buckets confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import as_bytes, connected_components, mapped, store, table
from corpusloom.llm.minhash import bands, signature
from corpusloom.llm.shingles import mix, shared, shingle_set

# Members of a bucket that one task compares; a larger bucket is cut into blocks of this size.
BLOCK = 384
# Distinct shingles of two blocks that are counted together.
_COLUMNS = 4096


def shingle_signatures(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n_shingles, d0, d1, bands)``: set size, a 128-bit digest of the set, band keys."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, low, high, keys = [], [], [], []
        for data in as_bytes(batch.column("text")):
            hashes = shingle_set(data, width)
            sizes.append(len(hashes))
            low.append(int(mix(hashes).sum(dtype=np.uint64).view(np.int64)))
            high.append(int(mix(hashes ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64).view(np.int64)))
            keys.append(bands(signature(hashes)) if len(hashes) else None)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()),
            pa.array(high, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
        ], ["doc_id", "n_shingles", "d0", "d1", "bands"])

    return mapped(docs.select("doc_id", "text"), sign, "doc_id long, n_shingles long, d0 long, d1 long, bands array<long>")


def _buckets(representatives: DataFrame) -> DataFrame:
    """``(bucket, id, part, parts)``: members of every bucket with two or more distinct sets.

    Buckets of different bands that hold the same members are kept once. ``part`` is a member's
    block in a bucket of more than ``BLOCK`` members.
    """
    rows = representatives.select(F.explode("bands").alias("band"), "id")
    member = F.xxhash64("id")
    facts = rows.groupBy("band").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.bit_xor(member).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).filter("n > 1 AND low <> high")
    kept = facts.groupBy("n", "low", "high", "x", "y").agg(F.min("band").alias("bucket"))
    parts = F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")
    joined = rows.join(kept.select("bucket", parts), F.col("band") == F.col("bucket"))
    return joined.select("bucket", "id", "parts", F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int").alias("part"))


def _pairs_of_blocks(members: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks it belongs to: ``(bucket, i, j, side, id)``, i <= j."""
    other = F.explode(F.expr("sequence(0, parts - 1)")).alias("other")
    rows = members.select("bucket", "id", "part", other)
    return rows.select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id")


def _counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of ``a`` with all of ``b``, by products of indicator matrices."""
    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (av, ai), (bv, bi) = flat(a), flat(b)
    both = np.intersect1d(np.unique(av), np.unique(bv), assume_unique=True)
    total = np.zeros((len(a), len(b)), np.float64)
    if not len(both):
        return total

    def columns(values, owner):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[at] == values
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    (ac, ao), (bc, bo) = columns(av, ai), columns(bv, bi)
    for start in range(0, len(both), _COLUMNS):
        stop = min(start + _COLUMNS, len(both))
        left, right = np.zeros((len(a), stop - start), np.float32), np.zeros((len(b), stop - start), np.float32)
        for out, col, owner in ((left, ac, ao), (right, bc, bo)):
            lo, hi = np.searchsorted(col, (start, stop))
            out[owner[lo:hi], col[lo:hi] - start] = 1
        total += left @ right.T
    return total


def stars(linked: np.ndarray, first: np.ndarray, second: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(member, centre) for the components that ``linked`` makes; ``first`` and ``second`` are its row and column members."""
    label = np.arange(n)
    while True:  # smallest label of the neighbours until nothing changes
        before = label.copy()
        near = np.where(linked, label[second][None, :], n).min(axis=1, initial=n)
        label[first] = np.minimum(label[first], near)
        near = np.where(linked, label[first][:, None], n).min(axis=0, initial=n)
        label[second] = np.minimum(label[second], near)
        if (label == before).all():
            return [(k, int(label[k])) for k in np.flatnonzero(label != np.arange(n)).tolist()]


def links_of_block(sets: list[np.ndarray], parts: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Star edges (member, centre) of the components that the confirmed links of a block pair make.

    With two parts only links between them count, with one all. Every link is confirmed on the full
    sets: ``100 * intersection >= percent * union``.
    """
    n = len(sets)
    if n == 2:
        k = shared(*sets)
        return [(1, 0)] if 100 * k >= percent * (len(sets[0]) + len(sets[1]) - k) else []
    sizes = np.array([len(s) for s in sets], np.float64)
    first = np.flatnonzero(parts == parts.min())
    second = np.flatnonzero(parts == parts.max())
    if parts.min() == parts.max():
        second = first
    common = _counts([sets[k] for k in first], [sets[k] for k in second])
    linked = 100 * common >= percent * (sizes[first][:, None] + sizes[second][None, :] - common)
    return stars(linked, first, second, n)


def _confirm(percent: int, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block pair; a block pair may go on in the next batch."""
        current, ids, parts, sets, seen = None, [], [], [], set()

        def finish():
            found = links_of_block(sets, np.array(parts), percent) if len(sets) > 1 else []
            return [(ids[a], ids[b]) for a, b in found]

        for batch in batches:
            edges = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")))
            rest = zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), as_bytes(batch.column("text")))
            for key, (one, part, data) in zip(keys, rest):
                if key != current:
                    edges += finish()
                    current, ids, parts, sets, seen = key, [], [], [], set()
                if (one, data) in seen:  # a repeated row
                    continue
                seen.add((one, data))
                ids.append(one)
                parts.append(part)
                sets.append(shingle_set(data, width))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])
        edges = finish()
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every document, linked at ``percent`` similarity.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct shingles of
    ``width`` words, the whole sequence if there are fewer. Documents are linked if ``100 *
    intersection >= percent * union``; ``component_id`` is the smallest reachable ``doc_id``.

    Equal sets are one class and compared once. Classes meet in the banded buckets of their
    one-permutation signatures. A star around one member of a bucket would lose links between
    members that both differ from it, so each bucket is compared whole on full sets, in block pairs
    that spread over tasks; each confirmed component leaves one star of edges, never all pairs.

    Texts that are null or have no words have an empty set and link with nothing. Rows with a null
    ``doc_id`` take their class's component if it has an id, else null, and are kept only then.
    Repeated ids and rows are answered row by row; extra columns are ignored; an empty table gives none.
    """
    signed = store(shingle_signatures(docs, width), "signatures")
    some = F.col("n_shingles") > 0
    classes = signed.filter(some).groupBy("d0", "d1").agg(F.min("doc_id").alias("id"))
    heads = classes.filter("id IS NOT NULL").select("id", F.col("d0").alias("c0"), F.col("d1").alias("c1"))
    representatives = signed.join(heads, (F.col("doc_id") == F.col("id")) & (F.col("d0") == F.col("c0")) & (F.col("d1") == F.col("c1")))
    representatives = representatives.dropDuplicates(["doc_id", "d0", "d1"])
    members = _pairs_of_blocks(_buckets(representatives.select("id", "bands")))
    texts = docs.select(F.col("doc_id").cast("long").alias("key"), "text")
    blocks = members.join(texts, F.col("id") == F.col("key")).select("bucket", "i", "j", "part", "id", "text")
    blocks = blocks.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    components = connected_components(blocks.mapInArrow(_confirm(percent, width), "a long, b long"))
    classes = classes.join(components, F.col("id") == F.col("node"), "left")
    found = classes.select("d0", "d1", F.coalesce("component", "id").alias("component"))
    out = signed.drop("bands").join(found, ["d0", "d1"], "left")
    component = F.when(some, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
