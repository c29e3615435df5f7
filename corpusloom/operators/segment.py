"""How one word is cut into pieces; small helpers called inside tasks."""

from __future__ import annotations

import heapq
import math

from corpusloom.functions.text import WORD_MARK

# Fixed value: score gap of an unknown character.
UNKNOWN_PENALTY = 10.0

_ABSENT = object()


def merge_pieces(word: list[str], scores: dict[str, float]) -> list[str]:
    """Join neighbours, best-scored piece first and leftmost on ties, until none is known."""
    parts: list[str | None] = list(word)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    queue: list[tuple[float, int, str]] = []

    def offer(left: int, right: int) -> None:
        if left >= 0 and right < len(parts):
            score = scores.get(parts[left] + parts[right])
            if score is not None:
                heapq.heappush(queue, (-score, left, parts[left] + parts[right]))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    while queue:
        _, left, piece = heapq.heappop(queue)
        right = after[left]
        if parts[left] is None or right >= len(parts) or parts[left] + parts[right] != piece:
            continue
        parts[left], parts[right] = piece, None
        after[left] = after[right]
        if after[left] < len(parts):
            before[after[left]] = left
        offer(before[left], left)
        offer(left, after[left])
    return [p for p in parts if p is not None]


def prefix_table(scores: dict[str, float]) -> dict[str, float | None]:
    """Scores, plus every prefix of a piece that is no piece itself, without a score.

    A scan from a place in a word can stop at the first substring that is not in the table.
    """
    table: dict[str, float | None] = dict(scores)
    for piece in scores:
        for size in range(1, len(piece)):
            table.setdefault(piece[:size], None)
    return table


def _arcs(word: str, begin: int, table: dict, unknown: float) -> list[tuple[int, float]]:
    """(end, score) of the pieces that start at a place; one character always ends somewhere."""
    found = []
    for end in range(begin + 1, len(word) + 1):
        score = table.get(word[begin:end], _ABSENT)
        if score is _ABSENT:
            break
        if score is not None:
            found.append((end, score))
    if not found or found[0][0] > begin + 1:
        found.insert(0, (begin + 1, unknown))
    return found


def best_path(word: str, table: dict, unknown: float, whole: bool = True) -> list[str]:
    """Most likely pieces of a word; single characters fall back to the unknown score.

    Without ``whole`` the word must be cut at least once, unless it is one character.
    """
    size = len(word)
    best, start = [0.0] + [-math.inf] * size, [0] * (size + 1)
    for begin in range(size):
        for end, score in _arcs(word, begin, table, unknown):
            if not whole and end - begin == size > 1:
                continue
            if best[begin] + score > best[end]:
                best[end], start[end] = best[begin] + score, begin
    pieces, end = [], size
    while end:
        pieces.append(word[start[end]:end])
        end = start[end]
    return pieces[::-1]


def piece_weights(table: dict[str, float | None], per_character: float) -> dict[str, float | None]:
    """Probabilities of a prefix table, times a constant per character.

    The constant cancels out of every posterior and keeps products of many pieces near one.
    """
    return {
        p: None if s is None else math.exp(s + per_character * len(p)) for p, s in table.items()
    }


def expected_pieces(word: str, weights: dict, unknown: float) -> list[tuple[str, float]]:
    """Probability that each piece occurs at each place of a word."""
    size = len(word)
    arcs = [_arcs(word, begin, weights, unknown) for begin in range(size)]
    forward, backward = [1.0] + [0.0] * size, [0.0] * size + [1.0]
    for begin in range(size):
        at = forward[begin]
        for end, weight in arcs[begin]:
            forward[end] += at * weight
    for begin in reversed(range(size)):
        backward[begin] = sum(weight * backward[end] for end, weight in arcs[begin])
    total = forward[size]
    if not 1e-250 < total < 1e250 or not all(1e-250 < f < 1e250 for f in forward):
        return _expected_by_logs(word, arcs)
    return [
        (word[begin:end], forward[begin] * weight * backward[end] / total)
        for begin in range(size) for end, weight in arcs[begin]
    ]


def _expected_by_logs(word: str, arcs: list) -> list[tuple[str, float]]:
    """The same for words whose products leave the range of a double."""
    size = len(word)
    forward, backward = [0.0] + [-math.inf] * size, [-math.inf] * size + [0.0]
    logs = [[(end, math.log(weight)) for end, weight in places] for places in arcs]
    for begin in range(size):
        for end, score in logs[begin]:
            forward[end] = _log_add(forward[end], forward[begin] + score)
    for begin in reversed(range(size)):
        for end, score in logs[begin]:
            backward[begin] = _log_add(backward[begin], backward[end] + score)
    total = forward[size]
    return [
        (word[begin:end], math.exp(forward[begin] + score + backward[end] - total))
        for begin in range(size) for end, score in logs[begin]
    ]


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def join_unknown(pieces: list[str], ids: dict[str, int]) -> list[str]:
    """Neighbouring unknown pieces as one."""
    out: list[str] = []
    open_run = False
    for piece in pieces:
        unknown = piece not in ids
        if unknown and open_run:
            out[-1] += piece
        else:
            out.append(piece)
        open_run = unknown
    return out


def as_bytes(pieces: list[str], ids: dict[str, int]) -> list[str]:
    """Unknown pieces spelled out as byte pieces."""
    out: list[str] = []
    for piece in pieces:
        if piece in ids:
            out.append(piece)
        else:
            out += [f"<0x{b:02X}>" for b in piece.encode()]
    return out


def marked(text: str) -> list[str]:
    """Words of a text with the word-start mark."""
    return [WORD_MARK + w for w in text.split()]
