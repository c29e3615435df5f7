"""The normalisation rule of the public subword trainer: longest known sequence first, then single characters.

It is NFKC in most places. It differs where marks do not follow in canonical order or follow a character that is
composed already (NFKC reorders and composes, the rule does not), and in the characters listed below.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.slices import sliced

# Control characters that vanish, characters that become a space, one that stays as it is.
REMOVED = (*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F)
SPACES = (0x09, 0x0A, 0x0C, 0x0D, 0x061C, 0x1680, 0x200B, 0x200C, 0x200E, 0x200F, 0x2028, 0x2029, 0x2581, 0xFEFF, 0xFFFD)
KEPT = (0xFF5E,)
# Compatibility characters of later Unicode versions.
LATER = {0xA7F1: "S", **{0x1CCD6 + k: chr(ord("A") + k) for k in range(26)}, **{0x1CCF0 + k: str(k) for k in range(10)}}


class Replacements:
    """Single replacements, and a trie of sequences that compose to something else.

    A sequence is the full decomposition of a character; each of its places may hold any character that
    decomposes to the one there.
    """

    def __init__(self) -> None:
        self.single: dict[int, str] = {}
        self.base: dict[str, str] = {}
        self.trie: dict = {}
        later: set[str] = set()
        sequences = []
        for code in range(sys.maxunicode + 1):
            character = chr(code)
            if 0xD800 <= code < 0xE000 or code in KEPT:
                continue
            full = unicodedata.normalize("NFKD", character)
            composed = unicodedata.normalize("NFKC", character)
            if composed != character:
                self.single[code] = composed
            if len(full) == 1 and full != character:
                self.base[character] = full
            if len(full) > 1 and composed != full:
                sequences.append((full, composed))
        self.single |= {c: "" for c in REMOVED} | {c: " " for c in SPACES} | LATER
        self.base |= {chr(c): t for c, t in LATER.items()}
        for sequence, composed in sequences:
            node = self.trie
            for character in sequence:
                node = node.setdefault(character, {})
            node[""] = composed
            later.update(sequence[1:])
        following = sorted(later | {c for c, b in self.base.items() if b in later})
        self.sequences = re.compile(f"(?s).[{re.escape(''.join(following))}]+")

    def _replace(self, found: re.Match) -> str:
        text, out, at = found[0], [], 0
        while at < len(text):
            node, end, best, result = self.trie, at, at, ""
            while end < len(text) and (node := node.get(self.base.get(text[end], text[end]))) is not None:
                end += 1
                if "" in node:
                    best, result = end, node[""]
            if best == at:
                best, result = at + 1, text[at].translate(self.single)
            out.append(result)
            at = best
        return "".join(out)

    def apply(self, text: str) -> str:
        """The normalised text, in one pass; only places before a character that may compose are looked at twice."""
        out, at = [], 0
        for found in self.sequences.finditer(text):
            out.append(text[at : found.start()].translate(self.single))
            out.append(self._replace(found))
            at = found.end()
        out.append(text[at:].translate(self.single))
        return "".join(out)


@lru_cache(1)
def replacements() -> Replacements:
    """The rule, made once per worker from the Unicode tables."""
    return Replacements()


@F.arrow_udf(T.StringType())
def trainer_normalize(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts by the trainer's rule; Spark has no built-in Unicode normalisation."""
    rule = replacements()
    for batch in sliced(texts):
        yield pa.array([None if t is None else rule.apply(t) for t in batch.to_pylist()], pa.string())
