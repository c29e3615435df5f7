"""Fill-in-the-middle rewriting; the cuts are located on a wavelet matrix over character classes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import mapped, table

# The markers, the share of texts that are rewritten and, of these, of suffix-first ones, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
REWRITTEN, SUFFIX_FIRST = 90, 20
# Classes of code points: a letter A-Z or a-z after such a letter, one that begins a word, ASCII white space, any other.
INSIDE, FIRST, SPACE, OTHER = range(4)
# Code points that are classed at a time, so that a long text costs few bytes per code point.
_PIECE = 1 << 20


class WaveletMatrix:
    """Rank queries over small integers, one bit plane per binary digit, highest first.

    Every plane holds its bits in words of 64 with the number of ones before each word. Symbols with
    a zero in the plane go before those with a one in the next plane, in order.
    """

    def __init__(self, symbols: np.ndarray, digits: int):
        self.length, self.digits, self.planes = len(symbols), digits, []
        for digit in range(digits - 1, -1, -1):
            bits = (symbols >> digit) & 1
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.planes.append((words, before, len(symbols) - int(bits.sum(dtype=np.int64))))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def _ones(self, plane: int, end: int) -> int:
        words, before, _ = self.planes[plane]
        inside = int(words[end >> 6]) & ((1 << (end & 63)) - 1)
        return int(before[end >> 6]) + inside.bit_count()

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs before ``end``."""
        return self.rank_from(symbol, end) - (self.rank_from(symbol + 1, end) if symbol + 1 < 1 << self.digits else 0)

    def rank_from(self, symbol: int, end: int) -> int:
        """How many symbols before ``end`` are ``symbol`` or greater: the ranks of these classes, summed on the way down."""
        start, found = 0, 0
        for plane in range(self.digits):
            ones_start, ones_end = self._ones(plane, start), self._ones(plane, end)
            if symbol >> (self.digits - 1 - plane) & 1:
                zeros = self.planes[plane][2]
                start, end = zeros + ones_start, zeros + ones_end
            else:
                found += ones_end - ones_start
                start, end = start - ones_start, end - ones_end
        return found + end - start

    def last_within(self, symbol: int, most: int) -> int:
        """The greatest ``end`` with at most ``most`` symbols of ``symbol`` or greater before it, by bisection on ranks."""
        low, high = 0, self.length
        while low < high:
            middle = (low + high + 1) // 2
            if self.rank_from(symbol, middle) <= most:
                low = middle
            else:
                high = middle - 1
        return low


def classes(text: str) -> np.ndarray:
    """The class of every code point of a text."""
    found, letter = [np.empty(0, np.uint8)], False
    for start in range(0, len(text), _PIECE):
        points = np.frombuffer(text[start : start + _PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
        folded = points | 32
        letters = (folded >= ord("a")) & (folded <= ord("z"))
        after = np.concatenate(([letter], letters[:-1]))
        letter = bool(letters[-1])
        space = (points == 32) | ((points >= 9) & (points <= 13))
        kind = np.where(letters, np.where(after, INSIDE, FIRST), np.where(space, SPACE, OTHER))
        found.append(kind.astype(np.uint8))
    return np.concatenate(found)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the seed and the id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def rewrite(doc_id: int | None, text: str, seed: int) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    index = WaveletMatrix(classes(text), 2)
    n = index.rank_from(FIRST, len(text))  # a token begins at every code point that is not inside a word
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= REWRITTEN:
        return n, "plain", None, None, text
    left, right = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.last_within(FIRST, left), index.last_within(FIRST, right)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` per row: texts cut into prefix, middle and suffix.

    A text has ``n`` tokens: words of A-Z and a-z, and every other code point alone. Two seeded draws
    per id choose the cuts between tokens. A map without a shuffle; one text at a time is indexed, in
    some ten bytes per code point. Null texts are empty; empty texts, texts that hold a marker and a
    seeded tenth stay ``plain``, with null counts. Null ids draw alike, and so do rows that repeat an
    id, each by its own text. Extra columns are ignored; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        rows = [rewrite(d.as_py(), t.as_py() or "", seed) for d, t in zip(batch.column("doc_id"), texts)]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return mapped(columns, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The original text from ``output`` and ``form``. Parts hold no marker, so the markers cut it unambiguously."""
    parts = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), "<[PSM]>", -1)
    first, second, middle = (F.get(parts, F.lit(k)) for k in range(3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = f"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, t, len(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS c1,
    ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS c2, ('0x' || h[17:24])::BIGINT % 100 AS c3, ('0x' || h[25:32])::BIGINT % 100 AS c4
  FROM tokens),
parts AS (
  SELECT doc_id, text, n, CASE
      WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR c3 >= {REWRITTEN}
      THEN 'plain' WHEN c4 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(t[1:least(c1, c2)], '') AS p, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(t[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
