"""Longest-match cutting in linear time: a trie with failure links over flat arrays (Song et al., 2021)."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_CHARACTER_BITS = 21
_MARK = "##"


class LongestMatch:
    """Cuts words into pieces, longest first, with ``##`` in front of all but the first piece.

    A node is a prefix of pieces, from the root for word starts or from the root for continuations. If
    no piece goes on with the next character, the failure link leads to the node that remains after the
    pieces taken so far, which are listed once per node; so every character is looked at once and every
    piece is put out once.
    """

    START, INSIDE = 0, 1

    def __init__(self, pieces: Iterable[str]):
        pieces = list(pieces)
        texts = [(self.START, p, p) for p in pieces if p]
        texts += [(self.INSIDE, p[len(_MARK):], p) for p in pieces if p.startswith(_MARK) and len(p) > len(_MARK)]
        self.children: dict[int, int] = {}
        parent, label, piece = [-1, -1], [0, 0], [-1, -1]
        self.pieces: list[str] = []
        for root, text, name in texts:
            node = root
            for character in text:
                edge = (node << _CHARACTER_BITS) | ord(character)
                child = self.children.get(edge)
                if child is None:
                    child = self.children[edge] = len(parent)
                    parent.append(node)
                    label.append(ord(character))
                    piece.append(-1)
                node = child
            piece[node] = len(self.pieces)
            self.pieces.append(name)
        self._link(parent, label, piece)

    def _link(self, parent: list[int], label: list[int], piece: list[int]) -> None:
        """Failure links, and the pieces put out on the way, node by node in order of depth."""
        count = len(parent)
        depth = np.zeros(count, np.int64)
        for node in range(2, count):  # a parent is numbered before its children
            depth[node] = depth[parent[node]] + 1
        link, out = [-1] * count, [()] * count
        for node in np.argsort(depth, kind="stable").tolist():
            if node in (self.START, self.INSIDE):
                continue
            if piece[node] >= 0:
                link[node], out[node] = self.INSIDE, (piece[node],)
                continue
            above = parent[node]
            at, taken = link[above], list(out[above])
            while at >= 0 and (at << _CHARACTER_BITS) | label[node] not in self.children:
                taken += out[at]
                at = link[at]
            if at >= 0:
                link[node], out[node] = self.children[(at << _CHARACTER_BITS) | label[node]], tuple(taken)
        self.link = np.array(link, np.int32)
        self.out_end = np.cumsum([len(o) for o in out]).astype(np.int64)
        self.out = np.array([p for o in out for p in o], np.int32)
        self._lists: tuple[list[int], list[int], list[int]] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_lists": None}

    def _as_lists(self) -> tuple[list[int], list[int], list[int]]:
        """Links, ends and pieces as lists, which are read faster one by one; made once in each process."""
        if self._lists is None:
            self._lists = self.link.tolist(), self.out_end.tolist(), self.out.tolist()
        return self._lists

    def cut(self, word: str, unknown: str = "[UNK]") -> list[str]:
        """The pieces of a word, or the unknown piece alone; an empty word has none."""
        if not word:
            return []
        link, ends, out = self._as_lists()
        children, pieces, found, node = self.children, self.pieces, [], self.START
        for character in word:
            edge = ord(character)
            while (child := children.get((node << _CHARACTER_BITS) | edge)) is None:
                if link[node] < 0:
                    return [unknown]
                found.append(node)
                node = link[node]
            node = child
        while node != self.INSIDE:
            if link[node] < 0:
                return [unknown]
            found.append(node)
            node = link[node]
        return [pieces[p] for n in found for p in out[ends[n - 1] : ends[n]]]
