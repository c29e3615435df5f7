"""All ways to cut many words into pieces at once: a trie in flat arrays and passes over its arcs.

Words lie end to end in one array of code points. The arcs of a word are the pieces at its places;
they are followed place by place, all words together. Where no piece crosses a place, the ways before
and after it are independent, so long words fall into short segments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Segments above this many characters are walked one by one, arc by arc.
LONG_SEGMENT = 1000
_CHARACTER_BITS = 21
# Fixed value: an odd number near 2**64 divided by the golden ratio, which spreads neighbouring numbers.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def code_points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts end to end, and the length of each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), sizes


class PieceTrie:
    """Pieces as a trie in sorted arrays, small enough to broadcast; ``score`` is by piece number."""

    def __init__(self, pieces: list[str]):
        codes, sizes = code_points_of(pieces)
        starts = np.cumsum(sizes) - sizes
        node = np.zeros(len(pieces), np.int64)
        keys, children, count = [], [], 1
        self.longest = int(sizes.max()) if len(sizes) else 0
        for depth in range(self.longest):
            at = np.flatnonzero(sizes > depth)
            edge = (node[at] << _CHARACTER_BITS) | codes[starts[at] + depth]
            distinct, which = np.unique(edge, return_inverse=True)
            node[at] = count + which
            keys.append(distinct)
            children.append(count + np.arange(len(distinct)))
            count += len(distinct)
        # Nodes are numbered level by level, so the keys of all levels are sorted together.
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        self.children = (np.concatenate(children) if children else np.empty(0, np.int64)).astype(np.int32)
        self.piece = np.full(count, -1, np.int32)
        self.piece[node] = np.arange(len(pieces))
        self._slots: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_slots": None}

    def _first_slot(self, edge: np.ndarray) -> np.ndarray:
        return ((edge.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _place(self) -> None:
        """A table from edges to their number in ``keys``, made once in each process; the next slot if one is taken."""
        self._bits = max(4, (2 * len(self.keys)).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int32)
        left, slot = np.arange(len(self.keys), dtype=np.int32), self._first_slot(self.keys)
        while len(left):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = left[free]
            waits = self._slots[slot] != left
            left, slot = left[waits], (slot[waits] + 1) & (len(self._slots) - 1)

    def step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The child of each node for a character, or 0."""
        edge = (node << _CHARACTER_BITS) | character
        child = np.zeros(len(edge), np.int64)
        if self._slots is None:
            self._place()
        at, slot = np.arange(len(edge)), self._first_slot(edge)
        while len(at):
            number = self._slots[slot]
            taken = np.flatnonzero(number >= 0)
            at, slot, number = at[taken], slot[taken], number[taken]
            same = self.keys[number] == edge[at]
            child[at[same]] = self.children[number[same]]
            at, slot = at[~same], (slot[~same] + 1) & (len(self._slots) - 1)
        return child


@dataclass
class Arcs:
    """Arcs ``start -> end`` with a piece number (-1: unknown character) and a score, over segments.

    Nodes are numbered so that each segment has one more than it has characters.
    """

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    offset: np.ndarray
    first: np.ndarray
    length: np.ndarray
    word: np.ndarray
    nodes: int
    segment: np.ndarray


def arcs_of(codes: np.ndarray, sizes: np.ndarray, trie: PieceTrie, score: np.ndarray, unknown: float, whole: bool = True,
            split: bool = True) -> Arcs:
    """The arcs of words; without ``whole`` the piece that is a whole word of several characters is left out.

    Without ``split`` every word is one segment, so that scores are added up from its start.
    """
    total = len(codes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    found, node, at = [], np.zeros(total, np.int64), np.arange(total)
    single = np.zeros(total, bool)
    for depth in range(trie.longest):
        at = at[at + depth < ends[at]]
        after = trie.step(node[at], codes[at + depth])
        at, after = at[after > 0], after[after > 0]
        node[at] = after
        piece = trie.piece[after]
        known = piece >= 0
        if not whole and depth:
            known &= (at > starts[at]) | (at + depth + 1 < ends[at])
        here = at[known]
        found.append((here, np.full(len(here), depth + 1), piece[known].astype(np.int64)))
        if not depth:
            single[here] = True
    alone = np.flatnonzero(~single)
    found.append((alone, np.ones(len(alone), np.int64), np.full(len(alone), -1)))
    place, size, piece = (np.concatenate(part) for part in zip(*found))
    value = np.where(piece >= 0, score[piece] if len(score) else unknown, unknown)

    if split:
        crossed = np.bincount(place + 1, minlength=total + 1) - np.bincount(place + size, minlength=total + 1)
        inner = np.cumsum(crossed)[:total] > 0
    else:
        inner = np.arange(total) > starts
    head = np.flatnonzero(~inner)  # word starts are never crossed
    segment = np.cumsum(~inner) - 1
    length = np.diff(np.append(head, total))
    node_of = np.arange(total) + segment
    offset = place - head[segment[place]]
    order = _by_offset_and_size(offset, size)
    place, size = place[order], size[order]
    word = np.repeat(np.arange(len(sizes)), sizes)[head] if total else np.empty(0, np.int64)
    begin = node_of[place]
    return Arcs(begin, begin + size, piece[order], value[order], offset[order], node_of[head] if total else head, length, word, total + len(head),
                segment[place])


def _by_offset_and_size(offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The order by offset, then size; keys of 16 bits are sorted by counting."""
    if not len(size):
        return np.empty(0, np.int64)
    width = int(size.max()) + 1
    if (int(offset.max()) + 1) * width > 1 << 16:
        return np.lexsort((size, offset))
    return np.argsort((offset * width + size).astype(np.uint16), kind="stable")


def _groups(arcs: Arcs) -> list[slice]:
    """Arcs of one offset and size: no two of them share a start or an end."""
    if not len(arcs.start):
        return []
    size = arcs.end - arcs.start
    cuts = np.flatnonzero((np.diff(arcs.offset) != 0) | (np.diff(size) != 0)) + 1
    edges = [0, *cuts.tolist(), len(size)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _split(arcs: Arcs) -> tuple[Arcs, list[Arcs]]:
    """Arcs of short segments together, and of each long one apart."""
    long = np.flatnonzero(arcs.length > LONG_SEGMENT)
    if not len(long):
        return arcs, []
    segment = arcs.segment

    def part(mask: np.ndarray, segments: np.ndarray) -> Arcs:
        return Arcs(arcs.start[mask], arcs.end[mask], arcs.piece[mask], arcs.score[mask], arcs.offset[mask],
                    arcs.first[segments], arcs.length[segments], arcs.word[segments], arcs.nodes,
                    np.searchsorted(segments, segment[mask]))

    apart = [part(segment == s, np.array([s])) for s in long]
    short = np.flatnonzero(arcs.length <= LONG_SEGMENT)
    return part(~np.isin(segment, long), short), apart


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def expected(arcs: Arcs, weight: np.ndarray, pieces: int) -> tuple[np.ndarray, float]:
    """The expected count of each piece over all ways, times the weight of its word, and the log-likelihood."""
    forward, backward = np.full(arcs.nodes, -np.inf), np.full(arcs.nodes, -np.inf)
    forward[arcs.first] = 0.0
    backward[arcs.first + arcs.length] = 0.0
    short, apart = _split(arcs)
    groups = _groups(short)
    for g in groups:
        s, e = short.start[g], short.end[g]
        forward[e] = np.logaddexp(forward[e], forward[s] + short.score[g])
    for g in reversed(groups):
        s, e = short.start[g], short.end[g]
        backward[s] = np.logaddexp(backward[s], backward[e] + short.score[g])
    for part in apart:
        base = int(part.first[0])
        ways = list(zip((part.start - base).tolist(), (part.end - base).tolist(), part.score.tolist()))
        f, b = [-math.inf] * (int(part.length[0]) + 1), [-math.inf] * (int(part.length[0]) + 1)
        f[0] = b[-1] = 0.0
        for s, e, value in ways:
            f[e] = _log_add(f[e], f[s] + value)
        for s, e, value in reversed(ways):
            b[s] = _log_add(b[s], b[e] + value)
        forward[base : base + len(f)], backward[base : base + len(b)] = f, b
    total = forward[arcs.first + arcs.length]
    segment = arcs.segment
    share = np.exp(forward[arcs.start] + arcs.score + backward[arcs.end] - total[segment])
    share *= weight[arcs.word[segment]]
    known = arcs.piece >= 0
    sums = np.bincount(arcs.piece[known], share[known], pieces)
    return sums, float((total * weight[arcs.word]).sum())


def best(arcs: Arcs) -> tuple[np.ndarray, np.ndarray]:
    """The best score at every node and the number of the arc that gives it; of equal ones the earliest start."""
    score, by = np.full(arcs.nodes, -np.inf), np.full(arcs.nodes, -1)
    score[arcs.first] = 0.0
    for g in _groups(arcs):
        s, e = arcs.start[g], arcs.end[g]
        offered = score[s] + arcs.score[g]
        better = offered > score[e]
        score[e[better]] = offered[better]
        by[e[better]] = np.arange(g.start, g.stop)[better]
    return score, by


def best_pieces(arcs: Arcs) -> tuple[np.ndarray, np.ndarray]:
    """The piece numbers of the best way of every segment, in order, and the word of each."""
    _, by = best(arcs)
    piece, taken = np.full(arcs.nodes, -1), np.zeros(arcs.nodes, bool)
    at = arcs.first + arcs.length
    while len(at):
        arc = by[at]
        at = arcs.start[arc]
        piece[at], taken[at] = arcs.piece[arc], True
        at = at[by[at] >= 0]
    node = np.flatnonzero(taken)
    return piece[node], arcs.word[np.searchsorted(arcs.first, node, side="right") - 1]


def best_counts(arcs: Arcs, weight: np.ndarray, pieces: int) -> np.ndarray:
    """The count of each piece on the best way of every word, times the word's weight."""
    sums = np.zeros(pieces)
    short, apart = _split(arcs)
    for part in [short, *apart]:
        _, by = best(part) if part is short else _best_alone(part)
        at, value = part.first + part.length, weight[part.word]
        while len(at):
            arc = by[at]
            known = part.piece[arc] >= 0
            sums += np.bincount(part.piece[arc][known], value[known], pieces)
            at = part.start[arc]
            going = by[at] >= 0
            at, value = at[going], value[going]
    return sums


def _best_alone(part: Arcs) -> tuple[None, np.ndarray]:
    """As ``best`` for one long segment."""
    base, size = int(part.first[0]), int(part.length[0])
    score, by = [-math.inf] * (size + 1), [-1] * (size + 1)
    score[0] = 0.0
    ways = zip((part.start - base).tolist(), (part.end - base).tolist(), part.score.tolist())
    for k, (s, e, value) in enumerate(ways):
        if score[s] + value > score[e]:
            score[e], by[e] = score[s] + value, k
    whole = np.full(part.nodes, -1)
    whole[base : base + size + 1] = by
    return None, whole
