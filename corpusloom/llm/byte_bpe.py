"""Byte-level BPE: boundaries by scanned transition functions, cached pair merging, decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import mapped, table

# Distinct slices one worker remembers; it starts anew when full.
CACHE_SLICES = 300_000
# A slice longer than this is merged through a heap, so that its time is not quadratic.
LONG_SLICE = 100
_BLOCK = 64

# What a code point is for the scanner, with what follows it: a letter, a number, another mark, an
# apostrophe before one or two letters of a contraction, a space that joins the next word, white
# space that goes on (or ends the text), and the last white space of a run that joins nothing.
LETTER, NUMBER, MARK, SHORT, LONG, JOIN, BLANK, LAST = range(8)
# Where the scanner is after a code point; DONE: the next one opens a slice.
_LETTERS, _NUMBERS, _MARKS, _JOINED, _BLANKS, _ONE, _TWO, DONE = range(8)
# White_Space code points, and the contractions of the split pattern.
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a slice starts at this code point."""
    if symbol == LETTER:
        inside = {_LETTERS: _LETTERS, _JOINED: _LETTERS, _ONE: DONE, _TWO: _ONE}
        return inside.get(state, _LETTERS), state not in inside
    if symbol == NUMBER:
        return _NUMBERS, state not in (_NUMBERS, _JOINED)
    if symbol in (MARK, SHORT, LONG):
        if state in (_MARKS, _JOINED):
            return _MARKS, False
        return {MARK: _MARKS, SHORT: _ONE, LONG: _TWO}[symbol], True
    if symbol == BLANK:
        return _BLANKS, state != _BLANKS
    return (_JOINED if symbol == JOIN else DONE), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions closed under composition.

    Returns the function of each symbol (the second half: at the start of a text, where the state
    before does not matter), the composition table, each function's result from ``DONE``, and the
    start flags by state and symbol.
    """
    plain = [tuple(_step(s, c)[0] for s in range(8)) for c in range(8)]
    fresh = [(_step(DONE, c)[0],) * 8 for c in range(8)]
    known = {f: k for k, f in enumerate(dict.fromkeys([tuple(range(8)), *plain, *fresh]))}
    queue = list(known)
    for f in queue:
        for g in [*plain, *fresh]:
            both = tuple(g[x] for x in f)
            if both not in known:
                known[both] = len(known)
                queue.append(both)
    compose = np.array([[known[tuple(g[x] for x in f)] for g in queue] for f in queue], np.uint16)
    flags = np.array([[_step(s, c)[1] for c in range(8)] for s in range(8)])
    return np.array([known[f] for f in plain + fresh], np.uint16), compose, np.array([f[DONE] for f in queue], np.uint8), flags


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, MARK or BLANK for every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], MARK) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = BLANK
    return out


def symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The scanner's symbols of joined texts; ``first`` marks where each text starts."""
    kind = classes()[codes]
    ends = np.append(first[1:], True)
    after = np.append(kind[1:], BLANK)
    after[ends] = BLANK  # nothing follows: white space goes on to the end
    out = kind.copy()
    tail = (kind == BLANK) & (after != BLANK)
    out[tail] = LAST
    out[tail & (codes == 0x20)] = JOIN
    quotes = np.flatnonzero((codes == 0x27) & ~ends)
    if len(quotes):
        one = np.isin(codes[quotes + 1], [ord(c) for c in ONE_LETTER])
        out[quotes[one]] = SHORT
        rest = quotes[~one & (quotes + 2 < len(codes))]
        rest = rest[~ends[rest + 1]]
        pair = [(codes[rest + 1] == ord(a)) & (codes[rest + 2] == ord(b)) for a, b in TWO_LETTERS]
        out[rest[np.any(pair, axis=0)]] = LONG
    return out


def slice_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where slices start, as a mask over the code points.

    The functions of the symbols are composed in blocks side by side, the blocks' products one after
    the other, and the states before each block then give those inside.
    """
    of_symbol, compose, from_done, flags = automaton()
    symbol = symbols(codes, first)
    n = len(codes)
    rows = -(-n // _BLOCK)
    functions = np.zeros(rows * _BLOCK, np.uint16)  # 0 is the identity
    functions[:n] = of_symbol[symbol + 8 * first.astype(np.uint8)]
    functions = functions.reshape(rows, _BLOCK).T.copy()
    for k in range(1, _BLOCK):
        functions[k] = compose[functions[k - 1], functions[k]]
    products, step = functions[-1].copy(), 1
    while step < rows:  # associative: doubling distances
        products[step:] = compose[products[:-step].copy(), products[step:]]
        step *= 2
    before = np.concatenate((np.zeros(1, np.uint16), products[:-1]))
    states = from_done[compose[before[None, :], functions]].T.reshape(-1)[:n]
    previous = np.concatenate((np.array([DONE], np.uint8), states[:-1]))
    previous[first] = DONE
    return flags[previous, symbol]


def merge_slice(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one slice: the pair of lowest rank is merged first, the leftmost of equals."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_SLICE:
        return _merge_long(piece, ranks)
    parts = [piece[k : k + 1] for k in range(len(piece))]
    pairs = [ranks.get(parts[k] + parts[k + 1]) for k in range(len(parts) - 1)]
    while True:
        best = min((r for r in pairs if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(at: int) -> None:
        if at >= 0 and right[at] < n:
            stop = end[right[at]]
            rank = ranks.get(piece[at:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, at, stop))

    for k in range(n - 1):
        offer(k)
    alive = [True] * n
    while heap:
        _, at, stop = heapq.heappop(heap)
        if not alive[at] or right[at] >= n or end[right[at]] != stop:
            continue
        gone = right[at]
        alive[gone], end[at], right[at] = False, stop, right[gone]
        if right[at] < n:
            left[right[at]] = at
        offer(at)
        offer(left[at])
    return [ranks[piece[k : end[k]]] for k in range(n) if alive[k]]


class Codec:
    """Encoder and decoder over one rank table; the cache of merged slices is bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.cache = ranks, {}
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.sizes = np.zeros(max(self.pieces, default=-1) + 1, np.int64)
        for rank, piece in self.pieces.items():
            self.sizes[rank] = len(piece)
        # All pieces in a row, by id, and where each begins.
        self.flat = np.frombuffer(b"".join(self.pieces.get(r, b"") for r in range(len(self.sizes))), np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the byte offset of each in its text, and the bounds of texts."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.concatenate(([0], np.cumsum(lengths)))
        first = np.zeros(len(codes), bool)
        first[begin[:-1][lengths > 0]] = True
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        at_byte = np.concatenate(([0], np.cumsum(width)))
        starts = np.flatnonzero(slice_starts(codes, first)) if len(codes) else np.empty(0, np.int64)
        data, cuts = joined.encode(), at_byte[np.append(starts, len(codes))].tolist()
        cache, ranks, found = self.cache, self.ranks, []
        for a, b in zip(cuts, cuts[1:]):
            piece = data[a:b]
            ids = cache.get(piece)
            if ids is None:
                ids = merge_slice(piece, ranks)
                if b - a <= LONG_SLICE:
                    if len(cache) >= CACHE_SLICES:
                        cache.clear()
                    cache[piece] = ids
            found.append(ids)
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        ends = np.cumsum(self.sizes[ids])
        bounds = np.searchsorted(ends, at_byte[begin], side="right")
        bounds[0] = 0
        offsets = np.concatenate(([0], ends[:-1])) if len(ids) else ends
        offsets = offsets - np.repeat(at_byte[begin[:-1]], np.diff(bounds))
        return ids.astype(np.int32), offsets.astype(np.int32), bounds

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def decode_at(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes of ids, each put at its offset: one gather from the pieces in a row."""
        sizes = self.sizes[ids]
        out = np.empty(int(sizes.sum()), np.uint8)
        within = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(offsets, sizes) + within] = self.flat[np.repeat(self.begins[ids], sizes) + within]
        return out


_codecs: dict[int, Codec] = {}


def _codec(ranks: Broadcast) -> Codec:
    """The codec of this worker."""
    if id(ranks.value) not in _codecs:
        _codecs.clear()
        _codecs[id(ranks.value)] = Codec(ranks.value)
    return _codecs[id(ranks.value)]


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file (base64 piece and rank per line) as a broadcast; its size is the vocabulary's."""
    with open(path, "rb") as lines:
        return spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def _list_bounds(column: pa.Array) -> np.ndarray:
    """Where each list begins among all values in a row, and the end; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _encoder(ranks: Broadcast):
    """``(doc_id, text)`` batches to ``(doc_id, ids, offsets)``."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets, bounds = _codec(ranks).encode([t or "" for t in batch.column("text").to_pylist()])
        bounds = pa.array(bounds.astype(np.int32))
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(ids)),
            pa.ListArray.from_arrays(bounds, pa.array(offsets)),
        ], ["doc_id", "ids", "offsets"])

    return encode


def _decoder(ranks: Broadcast):
    """``(doc_id, ids, ...)`` batches to ``(doc_id, ids, decoded)``."""

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec, column = _codec(ranks), batch.column("ids")
        ids = column.flatten().to_numpy()
        if len(ids) and (ids.min() < 0 or not codec.sizes[ids].all()):
            raise KeyError("an id without a piece")
        starts = np.concatenate(([0], np.cumsum(codec.sizes[ids])))
        data, cuts = codec.decode_at(ids, starts[:-1]), starts[_list_bounds(column)].astype(np.int32)
        decoded = pa.BinaryArray.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), column, decoded], ["doc_id", "ids", "decoded"])

    return decode


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``(doc_id, ids, decoded)`` batches to counts and digests."""
    words, bounds = batch.column("ids").flatten().to_numpy().astype("<u4"), _list_bounds(batch.column("ids"))
    own = [hashlib.sha256(words[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]
    back = [None if d is None else hashlib.sha256(d).hexdigest() for d in batch.column("decoded").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(own, pa.string()), pa.array(back, pa.string())],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _with_id(df: DataFrame, columns: str) -> str:
    """The schema of ``doc_id`` as in ``df`` and these columns."""
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {columns}"


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_texts(docs: DataFrame, ranks: Broadcast) -> DataFrame:
    """``(doc_id, ids, offsets)`` per row: ids and the byte offset at which each token starts.

    Special tokens are ordinary text. Null and empty texts have no ids. Rows are independent:
    repeated rows and null ids are kept as they are, extra columns are ignored, and an empty table
    gives no rows. A map without a shuffle.
    """
    return mapped(docs.select("doc_id", "text"), _encoder(ranks), _with_id(docs, "ids array<int>, offsets array<int>"))


def decode_ids(tokens: DataFrame, ranks: Broadcast) -> DataFrame:
    """``(doc_id, ids, decoded)`` per row of ``(doc_id, ids)``; ``decoded`` holds the bytes. Null ids are none."""
    return mapped(tokens.select("doc_id", "ids"), _decoder(ranks), _with_id(tokens, "ids array<int>, decoded binary"))


def token_digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of ``(doc_id, ids, decoded)``: ids as little-endian 32-bit integers."""
    return mapped(decoded.select("doc_id", "ids", "decoded"), _digest, _with_id(decoded, DIGESTS))


def text_digests(docs: DataFrame, ranks: Broadcast) -> DataFrame:
    """``encode_texts``, ``decode_ids`` and ``token_digests`` one after the other on each slice, in one map.

    A task needs one Python worker with one rank table, not three, and neither ids nor decoded bytes
    leave it. Nulls, repeated rows and empty tables as in :func:`encode_texts`.
    """
    encode, decode = _encoder(ranks), _decoder(ranks)
    return mapped(docs.select("doc_id", "text"), lambda batch: _digest(decode(encode(batch))), _with_id(docs, DIGESTS))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return text_digests(table(spark, sf_dir, "documents"), ranks)
