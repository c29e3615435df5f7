"""Encode and decode whole corpora with a vocabulary table.

Encoding is a map: the vocabulary is broadcast (its size is bounded when it is trained and checked
again here) and each text is encoded where it lies, so nothing is shuffled and no key can be hot.
Each task keeps the pieces of words it has seen; a part of a batch looks its words up and takes their pieces
in arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.slices import sliced
from corpusloom.functions.text import WORD_MARK, bert_normalize, bert_words, collapse_whitespace
from corpusloom.operators.longest import LongestMatch
from corpusloom.operators.segment import (
    UNKNOWN_PENALTY, as_bytes, best_path, join_unknown, marked, merge_pieces, prefix_table,
)
from corpusloom.operators.vocab.lattice import PieceTrie, arcs_of, best_pieces, code_points_of
from corpusloom.operators.vocab.symbols import ranges
from corpusloom.session import SMALL_TABLE_ROWS

MODELS = ("bpe", "unigram", "char", "word", "wordpiece")
_CACHED_WORDS = 200_000
# Words that are cut together, and the characters above which a word is cut alone.
_WORDS_TOGETHER, _LONG_WORD = 20_000, 100


class Encoder:
    """Pieces and ids of words for one vocabulary."""

    def __init__(self, rows: list, model: str):
        if model not in MODELS:
            raise ValueError(f"model must be one of {MODELS}")
        self.model = model
        text_rows = [r for r in rows if r["kind"] in ("learned", "user")]
        self.scores = {r["piece"]: r["score"] for r in text_rows if r["kind"] == "learned"}
        # Control and byte pieces never match text: "<s>" in a text is spelled out.
        self.text_ids = {r["piece"]: r["id"] for r in text_rows}
        self.byte_ids = {r["piece"]: r["id"] for r in rows if r["kind"] == "byte"}
        unknown = "[UNK]" if model == "wordpiece" else "<unk>"
        self.unknown_id = next((r["id"] for r in rows if r["piece"] == unknown), 0)
        user = sorted((r["piece"] for r in rows if r["kind"] == "user"), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, user)) + ")") if user else None
        self.user = set(user)
        self.known = list(self.text_ids)
        self.table = prefix_table(self.scores) if model == "unigram" else {}
        # Without user pieces the words of a text can be cut together.
        self.trie = PieceTrie(self.known) if model == "unigram" and not user else None
        self.longest = LongestMatch(self.text_ids) if model == "wordpiece" else None
        self.score: np.ndarray | None = None
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY

    def _cut(self, word: str) -> list[str]:
        if self.model == "bpe":
            return merge_pieces(list(word), self.scores)
        if self.model == "unigram":
            return best_path(word, self.table, self.unknown_score)
        if self.model == "char":
            return list(word)
        return [word]

    def word_pieces(self, word: str) -> list[str]:
        if self.model == "wordpiece":
            return self.longest.cut(word)
        segments = self.cut.split(word) if self.cut else [word]
        pieces: list[str] = []
        for segment in segments:
            if segment in self.user:
                pieces.append(segment)
            elif segment:
                pieces += self._cut(segment)
        if self.byte_ids:
            return as_bytes(pieces, self.text_ids)
        return join_unknown(pieces, self.text_ids)

    def numbered_pieces(self, words: list[str], numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of words end to end, and how many each has; the pieces of :meth:`word_pieces`."""
        if self.trie is None:
            return self._one_by_one(words, numbers)
        # Long words cost a step per character for all of them; unknown characters are joined or spelled.
        short = [k for k, word in enumerate(words) if len(word) <= _LONG_WORD]
        flat, sizes = np.empty(0, np.int64), np.zeros(len(words), np.int64)
        apart = np.ones(len(words), bool)
        for begin in range(0, len(short), _WORDS_TOGETHER):
            at = np.array(short[begin : begin + _WORDS_TOGETHER])
            found, size, whole = self._together([words[k] for k in at])
            flat, sizes[at[whole]] = np.concatenate((flat, found)), size[whole]
            apart[at[whole]] = False
        others = np.flatnonzero(apart)
        if not len(others):
            return flat, sizes
        found, sizes[others] = self._one_by_one([words[k] for k in others], numbers)
        out, alone = np.empty(sizes.sum(), np.int64), np.repeat(apart, sizes)
        out[alone], out[~alone] = found, flat
        return out, sizes

    def _one_by_one(self, words: list[str], numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        sizes = np.empty(len(words), np.int64)
        for k, word in enumerate(words):
            pieces = self.word_pieces(word)
            flat += map(numbers.__getitem__, pieces)
            sizes[k] = len(pieces)
        return np.array(flat, np.int64), sizes

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known pieces of the words without unknown ones, how many each word has, and which words these are."""
        if self.score is None:
            self.score = np.array([self.scores[p] for p in self.known])
        arcs = arcs_of(*code_points_of(words), self.trie, self.score, self.unknown_score, split=False)
        piece, word = best_pieces(arcs)
        whole = np.ones(len(words), bool)
        whole[word[piece < 0]] = False
        return piece[whole[word]], np.bincount(word, minlength=len(words)), whole

    def piece_id(self, piece: str) -> int:
        found = self.text_ids.get(piece)
        return self.byte_ids.get(piece, self.unknown_id) if found is None else found

    def words(self, text: str) -> list[str]:
        return text.split() if self.model == "wordpiece" else marked(text)


def _vocab_rows(vocab: DataFrame) -> list:
    """Driver copy of a vocabulary table, refused beyond the size that may be broadcast."""
    rows = vocab.limit(SMALL_TABLE_ROWS + 1).collect()
    if len(rows) > SMALL_TABLE_ROWS:
        raise ValueError(f"a vocabulary may have at most {SMALL_TABLE_ROWS} pieces")
    return rows


def load_encoder(vocab: DataFrame, model: str) -> Encoder:
    """Encoder of a vocabulary table."""
    return Encoder(_vocab_rows(vocab), model)


def _pieces_by_id(vocab: DataFrame) -> dict[int, str]:
    return {r["id"]: r["piece"] for r in _vocab_rows(vocab)}


class _WordTable:
    """Pieces of the words a task has seen: word numbers, and piece numbers of all words end to end."""

    def __init__(self, encoder: Encoder, ids: bool):
        self.encoder, self.ids = encoder, ids
        self.numbers: dict[str, int] = _Numbers()
        self.pieces = _Numbers((p, k) for k, p in enumerate(encoder.known))
        self.values = self._values(encoder.known)
        self.flat, self.ends = np.empty(0, np.int64), np.zeros(1, np.int64)

    def _values(self, pieces: list[str]) -> pa.Array:
        return pa.array([self.encoder.piece_id(p) for p in pieces], pa.int32()) if self.ids else pa.array(pieces, pa.string())

    def _learn(self) -> None:
        """Encode the words that have a number but no pieces yet."""
        words = list(islice(self.numbers, len(self.ends) - 1, None))
        if not words:
            return
        flat, sizes = self.encoder.numbered_pieces(words, self.pieces)
        if len(self.pieces) > len(self.values):
            new = list(islice(self.pieces, len(self.values), None))
            self.values = pa.concat_arrays([self.values, self._values(new)])
        self.flat = np.concatenate((self.flat, flat))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))

    def encode(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """The tokens of texts end to end, and where each text's end."""
        words, bounds = [], [0]
        for text in texts:
            if text is not None:
                words += self.encoder.words(text)
            bounds.append(len(words))
        at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        self._learn()
        starts, ends = self.ends[at], self.ends[at + 1]
        tokens = self.values.take(pa.array(self.flat[ranges(starts, ends)]))
        return tokens, np.append(0, np.cumsum(ends - starts))[bounds]


class _Numbers(dict):
    """Numbers keys in order of their first use."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _encode_udf(shared, ids: bool):
    """Arrow in, Arrow out: tokens of a batch are one flat array with offsets per text."""

    @F.arrow_udf("array<int>" if ids else "array<string>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = shared.value
        seen = _WordTable(encoder, ids)
        for batch in sliced(texts):
            if len(seen.numbers) >= _CACHED_WORDS:
                seen = _WordTable(encoder, ids)
            values, ends = seen.encode(batch.to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pc.if_else(batch.is_null(), pa.scalar(None, lists.type), lists) if batch.null_count else lists

    # Otherwise an explode of the tokens makes Spark encode every text twice, once for a filter.
    return encode.asNondeterministic()


def _encoded(df: DataFrame, vocab: DataFrame, model: str, text: str, ids: bool) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(load_encoder(vocab, model))
    source = F.col(text)
    if model == "wordpiece":
        source = F.array_join(bert_words(bert_normalize(source)), " ")
    return _encode_udf(shared, ids)(source)


def encode_pieces(
    df: DataFrame, vocab: DataFrame, model: str, text: str = "text", out: str = "pieces"
) -> DataFrame:
    """Text to pieces; unknown characters keep their surface."""
    return df.withColumn(out, _encoded(df, vocab, model, text, ids=False))


def encode_ids(
    df: DataFrame, vocab: DataFrame, model: str, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Text to ids; unknown pieces get the unknown id."""
    return df.withColumn(out, _encoded(df, vocab, model, text, ids=True))


def decode_pieces(pieces: Column) -> Column:
    """Pieces to text: marks become spaces, the leading one is dropped."""
    return F.regexp_replace(F.replace(F.array_join(pieces, ""), F.lit(WORD_MARK), F.lit(" ")), "^ ", "")


def decode_with_bytes(pieces: Column) -> Column:
    """As :func:`decode_pieces` for vocabularies with byte pieces, joined at byte level."""
    is_byte = lambda p: p.rlike("^<0x[0-9A-F]{2}>$")
    as_hex = F.transform(
        pieces, lambda p: F.when(is_byte(p), F.substring(p, 4, 2)).otherwise(F.hex(F.encode(p, "UTF-8")))
    )
    joined = F.decode(F.unhex(F.array_join(as_hex, "")), "UTF-8")
    spelled = F.regexp_replace(F.replace(joined, F.lit(WORD_MARK), F.lit(" ")), "^ ", "")
    return F.when(F.array_join(pieces, "").contains("<0x"), spelled).otherwise(decode_pieces(pieces))


def decode_wordpieces(pieces: Column) -> Column:
    """WordPiece pieces to text: continuations join their word."""
    return F.replace(F.array_join(pieces, " "), F.lit(" ##"), F.lit(""))


def ids_to_pieces(df: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "pieces") -> DataFrame:
    """Stored ids back to pieces; a map over the rows, like encoding. Ids out of range give null."""
    shared = df.sparkSession.sparkContext.broadcast(_pieces_by_id(vocab))

    @F.arrow_udf("array<string>")
    def look_up(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(shared.value.keys(), pa.int64())
        pieces = pa.array(shared.value.values(), pa.string())
        for batch in sliced(rows):
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False))
            values = pieces.take(pc.index_in(batch.flatten().cast(pa.int64()), known))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)
            yield pc.if_else(batch.is_null(), pa.scalar(None, lists.type), lists) if batch.null_count else lists

    return df.withColumn(out, look_up(ids))


def roundtrip_check(df: DataFrame, key: str, text: str = "text", pieces: str = "pieces") -> DataFrame:
    """Texts per key and how many come back unchanged, whitespace runs aside."""
    same = decode_with_bytes(F.col(pieces)) == collapse_whitespace(F.col(text))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(same).alias("unchanged"),
        F.round(F.avg(F.when(same, 0.0).otherwise(1.0)), 6).alias("mismatch_rate"),
    )


def token_preview(tokens: Column, n: int = 8) -> Column:
    """First tokens of a text, with dots when there are more."""
    shown = F.array_join(F.slice(tokens, 1, n).cast("array<string>"), " ")
    return F.when(F.size(tokens) > n, F.concat(shown, F.lit(" ..."))).otherwise(shown)


def token_counts(encoded: DataFrame, tokens: str = "ids") -> DataFrame:
    """Frequency of every token; counted per task before the shuffle."""
    return encoded.select(F.explode(tokens).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")
    )
