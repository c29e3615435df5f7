"""Text expressions: strip, whitespace, normalisation, symbol and word splitting."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.slices import sliced

# The code points Python's str.isspace() accepts.
WHITESPACE = (
    r"\x09-\x0d\x1c-\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same code points as characters, for trimming.
_WHITESPACE_CHARACTERS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WORD_MARK = "▁"

# Scripts a word is cut at; anything else is one further class.
SCRIPTS = (
    "Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Syriac", "Devanagari",
    "Bengali", "Gujarati", "Tamil", "Telugu", "Thai", "Georgian", "Ethiopic", "Hangul",
)
# Han, Hiragana and Katakana mix freely in one word.
_EAST_ASIAN = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\x{30fc}"


def strip_text(text: Column) -> Column:
    """Unicode strip: every leading and trailing whitespace code point."""
    return F.btrim(text, F.lit(_WHITESPACE_CHARACTERS))


def clean_or_null(text: Column) -> Column:
    """Stripped text, or null where nothing is left."""
    return F.nullif(strip_text(text), F.lit(""))


def collapse_whitespace(text: Column) -> Column:
    """Strip and turn each inner run of whitespace into one space."""
    return strip_text(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def split_words(text: Column) -> Column:
    """Whitespace-separated words; no empty strings."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda w: w != "")


def mark_words(text: Column) -> Column:
    """Words with the word-start mark in front."""
    return F.transform(split_words(text), lambda w: F.concat(F.lit(WORD_MARK), w))


def _piece_pattern(split_digits: bool, split_scripts: bool) -> str | None:
    marks = r"\p{IsInherited}"
    digit = r"\p{Nd}"
    if split_scripts:
        # Classes are disjoint but for marks, which go to the first script. Each looks at ASCII before it looks up scripts.
        known = "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + _EAST_ASIAN
        rest = rf"\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e[^{known}{marks}{WORD_MARK}{digit}]"
        runs = [rf"[A-Za-z[\p{{IsLatin}}{marks}&&[^{digit}]]]+"]
        runs += [digit, rf"[{rest}]+"] if split_digits else [rf"[{digit}{rest}]+"]
        runs += [rf"[\p{{Is{s}}}{marks}&&[^{digit}]]+" for s in SCRIPTS[1:]]
        runs.append(rf"[{_EAST_ASIAN}{marks}&&[^{digit}]]+")
    elif split_digits:
        runs = [digit, rf"[^{WORD_MARK}{digit}]+"]
    else:
        return None
    # A mark takes the run that follows it; a mark before nothing stands alone.
    body = "|".join(runs)
    return rf"{WORD_MARK}?(?:{body})|(?s:.)"


def cut_word(
    word: Column, split_digits: bool = False, split_scripts: bool = False,
    symbols: Sequence[str] = (),
) -> Column:
    """Segments of a marked word: cut at user symbols, which are left out, digits and scripts."""
    parts = F.array(word)
    if symbols:
        parts = F.filter(split_symbols(word, symbols), lambda p: ~p.isin(*symbols))
    pattern = _piece_pattern(split_digits, split_scripts)
    if pattern is None:
        return parts
    cut = lambda p: F.regexp_extract_all(p, F.lit(pattern), F.lit(0))
    return F.flatten(F.transform(parts, cut)) if symbols else cut(word)


def pretokenize(
    text: Column, split_digits: bool = False, split_scripts: bool = False,
    symbols: Sequence[str] = (),
) -> Column:
    """Marked words of a text, each cut by :func:`cut_word`."""
    pattern = _piece_pattern(split_digits, split_scripts)
    if pattern and not symbols:
        # No piece goes on over a mark, so the words may be cut end to end.
        stripped = strip_text(text)
        joined = F.concat(F.lit(WORD_MARK), F.regexp_replace(stripped, f"[{WHITESPACE}]+", WORD_MARK))
        return F.regexp_extract_all(F.when(stripped == "", "").otherwise(joined), F.lit(pattern), F.lit(0))
    cut = lambda w: cut_word(w, split_digits, split_scripts, symbols)
    return F.flatten(F.transform(mark_words(text), cut))


def split_symbols(text: Column, symbols: Sequence[str]) -> Column:
    """Segments of the text in order, every user symbol a segment of its own."""
    longest_first = sorted(symbols, key=len, reverse=True)
    alternatives = "|".join(java_quote(s) for s in longest_first)
    between = rf"(?s:(?:(?!{alternatives}).)+)"
    return F.regexp_extract_all(text, F.lit(f"{alternatives}|{between}"), F.lit(0))


def java_quote(literal: str) -> str:
    """Escape a literal for a Java regular expression."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def _normalized(form: str, texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in sliced(texts):
        yield pa.array([None if t is None else unicodedata.normalize(form, t) for t in batch.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def nfkc_normalize(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """NFKC form; Spark has no built-in Unicode normalisation."""
    yield from _normalized("NFKC", texts)


@F.arrow_udf(T.StringType())
def _nfd(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from _normalized("NFD", texts)


# Ideograph blocks that get a space on both sides.
_IDEOGRAPHS = (
    r"\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}"
    r"\x{2b740}-\x{2b81f}\x{2b920}-\x{2ceaf}\x{f900}-\x{faff}\x{2f800}-\x{2fa1f}"
)


def bert_normalize(text: Column, lowercase: bool = True) -> Column:
    """Drop control characters, space ideographs and, with ``lowercase``, fold case and marks."""
    kept = F.regexp_replace(text, r"[\x00\x{fffd}]|[\p{C}&&[^\t\n\r\p{Cn}]]", "")
    # These tell plain ASCII first; a space stays what it is.
    kept = F.regexp_replace(kept, rf"[[^\x20-\x7e]&&[{WHITESPACE}]]", " ")
    kept = F.regexp_replace(kept, rf"([[^\x00-\x7f]&&[{_IDEOGRAPHS}]])", " $1 ")
    if not lowercase:
        return kept
    return F.lower(F.regexp_replace(_nfd(kept), r"\p{Mn}", ""))


def bert_words(text: Column) -> Column:
    """Words of a BERT-normalised text, each punctuation sign a word of its own."""
    punctuation = r"[\p{P}$+<=>^`|~]"
    return F.regexp_extract_all(
        text, F.lit(rf"[A-Za-z0-9[^{WHITESPACE}\p{{P}}$+<=>^`|~]]+|{punctuation}"), F.lit(0)
    )
