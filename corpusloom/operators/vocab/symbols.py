"""Vectorised steps on blocks of words, run inside tasks.

A word is an array of symbol numbers. Characters are their own code points, so no character table
is needed; learned symbols get numbers above them. Number 0 stands for an uncovered character and
never pairs with anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CODE_POINTS = 0x110000
UNCOVERED = 0
_LOW = (1 << 32) - 1

Batch = tuple[np.ndarray, np.ndarray]


def pack(left: int, right: int) -> int:
    """One number for a pair of symbols."""
    return (left << 32) | right


def unpack(code: int) -> tuple[int, int]:
    """The two symbols of a packed pair."""
    return code >> 32, code & _LOW


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _apart(at: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs without every second, overlapping one in a run of equal symbols."""
    if len(at) > 1:
        follows = np.concatenate([[False], (np.diff(at) == 1) & (slot[1:] == slot[:-1])])
        place = np.arange(len(at))
        since = place - np.maximum.accumulate(np.where(follows, 0, place))
        at, slot = at[since % 2 == 0], slot[since % 2 == 0]
    return at, slot


class Keys:
    """Sorted packed pairs, to be found in symbols.

    In many symbols they are found by a table with a cell for each left and right symbol of a key, made
    once; in few, or where the table were too large, by search.
    """

    MANY_SYMBOLS, MOST_CELLS = 1 << 16, 1 << 20

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self._table: tuple | None = None

    def among(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a symbol and the next make a key, and which key."""
        left, right = symbols[:-1], symbols[1:]
        if not len(left) or not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(left) >= self.MANY_SYMBOLS and (table := self._numbered()):
            row, column, cells = table
            slot = cells[row[np.minimum(left, len(row) - 1)] + column[np.minimum(right, len(column) - 1)]]
            at = np.flatnonzero(slot >= 0)
            return at, slot[at].astype(np.int64)
        codes = (left << 32) | right
        slot = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[slot] == codes)
        return at, slot[at]

    def _numbered(self) -> tuple:
        """First cell of each left symbol, cell in a row of each right symbol, and the key of each cell."""
        if self._table is None:
            (row, rows), (column, columns) = (self._number(s) for s in (self.keys >> 32, self.keys & _LOW))
            self._table = ()
            if rows * columns <= self.MOST_CELLS:
                row *= columns
                cells = np.full(rows * columns, -1, np.int32)
                cells[row[self.keys >> 32] + column[self.keys & _LOW]] = np.arange(len(self.keys))
                self._table = row, column, cells
        return self._table

    @staticmethod
    def _number(symbols: np.ndarray) -> tuple[np.ndarray, int]:
        """Numbers from 1 of the distinct symbols, 0 for all others, by symbol; and how many numbers there are."""
        distinct = np.unique(symbols)
        number = np.zeros(int(distinct[-1]) + 2, np.int32)
        number[distinct] = np.arange(1, len(distinct) + 1)
        return number, len(distinct) + 1


class Block:
    """Symbols of many words, end to end, with the word each belongs to."""

    def __init__(self, symbols: np.ndarray, word: np.ndarray, weight: np.ndarray):
        self.symbols, self.word, self.weight = symbols, word, weight

    @classmethod
    def of_arrow(cls, batch: pa.RecordBatch) -> Block:
        lists = batch.column("symbols")
        sizes = np.diff(lists.offsets.to_numpy())
        word = np.repeat(np.arange(len(lists)), sizes)
        weight = batch.column("n").to_numpy(zero_copy_only=False)
        return cls(lists.flatten().to_numpy().astype(np.int64), word, weight)

    def to_arrow(self) -> pa.RecordBatch:
        sizes = np.bincount(self.word, minlength=len(self.weight))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(self.symbols, pa.int32()))
        return pa.RecordBatch.from_arrays([lists, pa.array(self.weight, pa.int64())], ["symbols", "n"])

    def pairs(self) -> np.ndarray:
        """Packed pair at each position but the last; -1 across words and at uncovered symbols."""
        left, right = self.symbols[:-1], self.symbols[1:]
        inside = (self.word[:-1] == self.word[1:]) & (left != UNCOVERED) & (right != UNCOVERED)
        return np.where(inside, (left << 32) | right, -1)

    def find(self, keys: Keys | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of pairs among sorted ``keys``, and which key each is."""
        if not isinstance(keys, Keys):
            keys = Keys(keys)
        at, slot = keys.among(self.symbols)
        inside = self.word[at] == self.word[at + 1]
        return at[inside], slot[inside]

    def find_apart(self, keys: Keys | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``find``, but in a run of equal symbols every second, overlapping pair is left out."""
        return _apart(*self.find(keys))

    def replaced(self, at: np.ndarray, slot: np.ndarray, values: np.ndarray) -> Block:
        """The block with the pair at each place made one symbol."""
        if (np.diff(at) == 1).any():
            raise RuntimeError("merges of one batch overlap")
        symbols = self.symbols.copy()
        symbols[at] = values[slot]
        return Block(np.delete(symbols, at + 1), np.delete(self.word, at + 1), self.weight)

    def merged(self, batch: Batch) -> tuple[Block, np.ndarray]:
        """The block after a batch of merges, and a mask of the words that changed."""
        keys, values = batch
        at, slot = self.find_apart(keys)
        touched = np.zeros(len(self.weight), bool)
        if not len(at):
            return self, touched
        touched[self.word[at]] = True
        return self.replaced(at, slot, values), touched

    def only(self, words: np.ndarray) -> Block:
        """The words of a mask, numbered as before."""
        keep = words[self.word]
        return Block(self.symbols[keep], self.word[keep], self.weight)

    def pair_weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each distinct pair."""
        codes = self.pairs()
        valid = codes >= 0
        return summed(codes[valid], self.weight[self.word[:-1][valid]])

    def overlaps(self, keys: np.ndarray) -> np.ndarray:
        """Packed (first, second) key numbers that share a symbol somewhere in a word."""
        at, slot = self.find(keys)
        chained = np.flatnonzero(np.diff(at) == 1)
        first, second = slot[chained], slot[chained + 1]
        return np.unique((first << 32) | second)


class IndexedBlock:
    """Words of a block with an inverted index from each pair to the words that hold it.

    One file, or one row of binary columns, so that a task reads it without parsing.
    """

    COLUMNS = {"symbols": np.int32, "ends": np.int64, "n": np.int64, "pairs": np.int64, "starts": np.int64, "words": np.int32}
    SCHEMA = ", ".join(f"{name} binary" for name in COLUMNS)

    def __init__(self, **arrays: np.ndarray):
        self.symbols, self.ends, self.n = arrays["symbols"], arrays["ends"], arrays["n"]
        self.pairs, self.starts, self.words = arrays["pairs"], arrays["starts"], arrays["words"]

    @classmethod
    def of(cls, block: Block) -> IndexedBlock:
        codes = block.pairs()
        at = np.flatnonzero(codes >= 0)
        code, word = codes[at], block.word[at]
        order = np.argsort(code, kind="stable")  # words stay in order
        code, word = code[order], word[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (word[1:] != word[:-1])
        code, word = code[new], word[new]
        pairs, starts = np.unique(code, return_index=True)
        ends = np.cumsum(np.bincount(block.word, minlength=len(block.weight)))
        return cls(symbols=block.symbols, ends=ends, n=block.weight, pairs=pairs, starts=np.append(starts, len(code)), words=word)

    def save(self, path: str) -> None:
        """Write a file of the array sizes and the arrays, each from a multiple of eight bytes."""
        arrays = [np.ascontiguousarray(getattr(self, name), kind) for name, kind in self.COLUMNS.items()]
        with open(path, "wb") as file:
            file.write(np.array([len(a) for a in arrays], np.int64).tobytes())
            for a in arrays:
                file.write(a.tobytes())
                file.write(bytes(-a.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> IndexedBlock:
        """A block from its file; only the parts that are looked at are read."""
        data = np.memmap(path, np.uint8, "r")
        sizes = data[: 8 * len(cls.COLUMNS)].view(np.int64).tolist()
        arrays, at = {}, 8 * len(cls.COLUMNS)
        for (name, kind), size in zip(cls.COLUMNS.items(), sizes):
            width = size * np.dtype(kind).itemsize
            arrays[name] = np.asarray(data[at : at + width].view(kind))
            at += width + -width % 8
        return cls(**arrays)

    @classmethod
    def read(cls, batches: Iterable[pa.RecordBatch]) -> Iterator[IndexedBlock]:
        """The blocks of a task."""
        for batch in batches:
            for row in range(batch.num_rows):
                yield cls(**{
                    name: np.frombuffer(batch.column(name)[row].as_buffer(), kind) for name, kind in cls.COLUMNS.items()})

    def to_arrow(self) -> pa.RecordBatch:
        columns = [np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.COLUMNS.items()]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], list(self.COLUMNS))

    def holding(self, pairs: np.ndarray) -> np.ndarray:
        """The words that hold one of the pairs, ascending."""
        if not len(self.pairs):
            return np.empty(0, np.int64)
        slot = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        slot = slot[self.pairs[slot] == pairs]
        return np.unique(self.words[ranges(self.starts[slot], self.starts[slot + 1])]).astype(np.int64)

    def take(self, words: np.ndarray) -> Block:
        """Some of the words, numbered anew."""
        ends = self.ends[words]
        starts = np.where(words > 0, self.ends[words - 1], 0)
        symbols = self.symbols[ranges(starts, ends)].astype(np.int64)
        return Block(symbols, np.repeat(np.arange(len(words)), ends - starts), self.n[words])

    def whole(self) -> Block:
        return self.take(np.arange(len(self.n)))


def summed(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values added up per code."""
    distinct, where = np.unique(codes, return_inverse=True)
    total = np.bincount(where, weights=values, minlength=len(distinct))
    return distinct, total.astype(np.int64)


def advance(block: Block, batches: Iterable[Batch]) -> Block:
    """The block after several batches of merges.

    A merge makes pairs of later batches only, so each word may take its own batches in order, whatever
    the others take: in one step every word takes the first batch that it holds a pair of, and words
    without any are left. The steps follow the merges inside one word, not the number of batches.
    """
    batches = [batch for batch in batches if len(batch[0])]
    if len(batches) < 2:
        return block.merged(batches[0])[0] if batches else block
    keys, values = (np.concatenate(part) for part in zip(*batches))
    turn = np.repeat(np.arange(len(batches)), [len(batch[0]) for batch in batches])
    order = np.argsort(keys, kind="stable")
    keys, values, turn = Keys(keys[order]), values[order], turn[order]
    done = []
    while True:
        at, slot = block.find(keys)
        if not len(at):
            break
        word = block.word[at]
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        least = np.minimum.reduceat(turn[slot], begins)
        now = turn[slot] == np.repeat(least, np.diff(np.append(begins, len(at))))
        going = np.zeros(len(block.weight), bool)
        going[word] = True
        after = block.replaced(*_apart(at[now], slot[now]), values)
        done.append(block.only(~going))
        block = after.only(going)
    if not done:
        return block
    parts = [*done, block]
    symbols, word = np.concatenate([b.symbols for b in parts]), np.concatenate([b.word for b in parts])
    order = np.argsort(word, kind="stable")
    return Block(symbols[order], word[order], block.weight)


def spell(words: np.ndarray, weight: np.ndarray, covered: np.ndarray | None, inner: int = 0) -> Block:
    """Block of strings; characters outside ``covered`` become the uncovered symbol.

    ``inner`` is added to every symbol but the first of a word, for alphabets that tell them apart.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    if covered is not None:
        slot = np.minimum(np.searchsorted(covered, flat), len(covered) - 1)
        flat = np.where(covered[slot] == flat, flat, UNCOVERED)
    word = np.repeat(np.arange(len(words)), sizes)
    if inner and len(flat):
        first = np.concatenate([[True], word[1:] != word[:-1]])
        flat = np.where(first | (flat == UNCOVERED), flat, flat + inner)
    return Block(flat, word, weight)


def records(kind: int, codes: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Rows (kind, first, second, value) of packed codes."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(codes), kind, np.int32)), pa.array((codes >> 32).astype(np.int32)),
            pa.array((codes & _LOW).astype(np.int32)), pa.array(values.astype(np.int64)),
        ],
        ["kind", "first", "second", "value"],
    )


def in_one(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Code and value arrays of several blocks added up."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return summed(np.concatenate([c for c, _ in parts]), np.concatenate([v for _, v in parts]))


def indexed(most_words: int):
    """A function from batches of words to indexed blocks of at most so many words, and a batch more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[IndexedBlock]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= most_words:
                yield IndexedBlock.of(_joined(held))
                held = []
        if sum(b.num_rows for b in held):
            yield IndexedBlock.of(_joined(held))

    return run


def _joined(batches: list[pa.RecordBatch]) -> Block:
    return Block.of_arrow(pa.Table.from_batches(batches).combine_chunks().to_batches()[0])
