"""Steps whose time or memory must not follow repeated words, long runs or the size of a batch."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions import slices
from corpusloom.functions.normalize import trainer_normalize
from corpusloom.functions.text import nfkc_normalize, pretokenize
from corpusloom.operators import stats
from corpusloom.operators.encode import ids_to_pieces
from corpusloom.sources.schema import VOCABULARY


def test_pretokenize_takes_long_mixed_runs(spark):
    run = "1-" * 30_000
    rows = spark.createDataFrame([(f" {run} a\u2581b\u0301 \u0416x",), ("",), (None,)], "text string")
    found = [r[0] for r in rows.select(pretokenize(F.col("text"), split_scripts=True)).collect()]
    assert found == [["\u2581" + run, "\u2581a", "\u2581b\u0301", "\u2581\u0416", "x"], [], None]


def test_tasks_pass_on_distinct_words_only(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["a b a", None, "", "b\x1ca\u3000c"])], ["text"])
    (sums,) = stats._count_words([batch])
    assert dict(zip(*sums.to_pydict().values())) == {"a": 3, "b": 2, "c": 1}
    monkeypatch.setattr(stats, "WORDS_PER_BATCH", 2)
    parts = list(stats._count_words([batch]))
    total = Counter()
    for part in parts:
        total.update(dict(zip(*part.to_pydict().values())))
    assert len(parts) == 2 and total == {"a": 3, "b": 2, "c": 1}


def test_batches_are_taken_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(slices, "SLICE_SIZE", 4)
    texts = pa.array(["ab", None, "cd", "efghij", "", "k"]).slice(1)
    assert [p.to_pylist() for p in slices.sliced([texts])] == [[None, "cd"], ["efghij", ""], ["k"]] or \
        [p.to_pylist() for p in slices.sliced([texts])] == [[None, "cd"], ["efghij"], ["", "k"]]
    lists = pa.array([[1, 2, 3], [4], None, [5] * 9, []])
    assert [p.to_pylist() for p in slices.sliced([lists])][0] == [[1, 2, 3], [4], None]
    assert [p.to_pylist() for p in slices.sliced([texts.slice(0, 0)])] == [[]]


def test_parts_of_a_batch_make_whole_columns(spark):
    texts = [None, "", "\ufb01\u2460" * 400_000, "x", "\u00c5" * 700_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").coalesce(1)
    found = rows.select("k", nfkc_normalize("text").alias("a"), trainer_normalize("text").alias("b")).orderBy("k").collect()
    want = [None, "", "fi1" * 400_000, "x", "\u00c5" * 700_000]
    assert [r["a"] for r in found] == want and [r["b"] for r in found] == want


def test_ids_to_pieces_in_arrow(spark):
    vocab = spark.createDataFrame([(0, "<unk>", 0.0, "unknown"), (7, "x", 0.0, "learned")], VOCABULARY)
    rows = spark.createDataFrame([(0, [7, 0, 9]), (1, None), (2, []), (3, [7] * 1_500_000)], "k int, ids array<int>").coalesce(1)
    found = {r["k"]: r["pieces"] for r in ids_to_pieces(rows, vocab).collect()}
    assert found == {0: ["x", "<unk>", None], 1: None, 2: [], 3: ["x"] * 1_500_000}


def test_functions_get_parts_of_batches(spark):
    from corpusloom.llm.common import SLICE_BYTES, mapped

    rows = spark.createDataFrame([("x" * 100_000,)] * 40, "text string").coalesce(1)
    sizes = mapped(rows, lambda b: pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]), "n long").collect()
    assert len(sizes) > 1 and max(r["n"] for r in sizes) <= SLICE_BYTES


def _random_merges(rng, words: int, batches: int):
    """A block of words of few letters and batches of merges, each of pairs that do not overlap in it."""
    from corpusloom.operators.vocab.symbols import Block

    sizes = rng.integers(0, 12, words)
    block = Block(rng.integers(97, 101, sizes.sum()), np.repeat(np.arange(words), sizes), np.ones(words, np.int64))
    made, at, symbol = [], block, 1 << 22
    for _ in range(batches):
        codes = at.pairs()
        codes = np.unique(codes[codes >= 0])
        if not len(codes):
            break
        first = int(rng.choice(codes))
        apart = [c for c in codes.tolist() if not {c >> 32, c & 0xFFFFFFFF} & {first >> 32, first & 0xFFFFFFFF}][:1]
        keys = np.array(sorted([first, *apart]), np.int64)
        made.append((keys, np.arange(symbol, symbol + len(keys))))
        symbol += len(keys)
        at = at.merged(made[-1])[0]
    return block, made, at


def test_batches_of_merges_are_applied_word_by_word(monkeypatch):
    from corpusloom.operators.vocab import symbols

    rng = np.random.default_rng(5)
    for words in (1, 3, 40, 400):
        block, made, want = _random_merges(rng, words, 32)
        got = symbols.advance(block, made)
        assert got.symbols.tolist() == want.symbols.tolist() and got.word.tolist() == want.word.tolist()
    looked_at = []
    find = symbols.Block.find
    monkeypatch.setattr(symbols.Block, "find", lambda self, keys: looked_at.append(len(self.symbols)) or find(self, keys))
    symbols.advance(block, made)
    # Once over all, then the words that go on: not once over all for each batch.
    assert sum(looked_at) < len(made) * len(want.symbols) / 2


def test_words_of_a_part_are_cut_together(monkeypatch):
    from corpusloom.operators import encode

    rng = np.random.default_rng(7)
    pieces = sorted({"".join(rng.choice(list("abc\u2581"), size)) for size in rng.integers(1, 6, 60)} | set("abc\u2581"))
    rows = [{"piece": "<unk>", "id": 0, "score": 0.0, "kind": "unknown"}]
    # Few distinct scores, so that many ways are tied.
    rows += [{"piece": p, "id": k + 1, "score": -float(rng.integers(1, 5)) / 3, "kind": "learned"} for k, p in enumerate(pieces)]
    words = ["".join(rng.choice(list("abcxy"), size)) for size in rng.integers(1, 30, 800)] + ["ab" * 300]
    texts = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)] + [None, "", " "]
    for model in ("unigram", "bpe", "char", "word"):
        for more in ([], [{"piece": "<0x78>", "id": 900, "score": 0.0, "kind": "byte"}], [{"piece": "ba", "id": 901, "score": 0.0, "kind": "user"}]):
            encoder = encode.Encoder(rows + more, model)
            want = [[p for w in encoder.words(t or "") for p in encoder.word_pieces(w)] for t in texts]
            for ids in (False, True):
                table = encode._WordTable(encoder, ids)
                for begin in (0, 50, 0):
                    values, ends = table.encode(texts[begin : begin + 50])
                    got = [values[a:b].to_pylist() for a, b in zip(ends.tolist(), ends[1:].tolist())]
                    assert got == [[encoder.piece_id(p) for p in t] if ids else t for t in want[begin : begin + 50]]
    calls = []
    encoder = encode.Encoder(rows, "unigram")
    monkeypatch.setattr(encode, "best_path", lambda *given: calls.append(given) or ["a"])
    encoder.numbered_pieces(["\u2581abc", "cab", "bb"] * 50, {})
    assert not calls


def test_bert_classes_hold_the_same_characters(spark):
    from corpusloom.functions.text import WHITESPACE, _IDEOGRAPHS, bert_normalize, bert_words

    rows = spark.range(0x110000).filter("id < 55296 OR id > 57343")
    one = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    rows = rows.select("id", F.concat(F.lit("a"), one, F.lit("1")).alias("t"))
    kept = F.regexp_replace("t", r"[\x00\x{fffd}]|[\p{C}&&[^\t\n\r\p{Cn}]]", "")
    kept = F.regexp_replace(F.regexp_replace(kept, f"[{WHITESPACE}]", " "), f"([{_IDEOGRAPHS}])", " $1 ")
    punctuation = r"[\p{P}$+<=>^`|~]"
    words = F.regexp_extract_all("t", F.lit(rf"{punctuation}|[^{WHITESPACE}\p{{P}}$+<=>^`|~]+"), F.lit(0))
    assert rows.filter(~(bert_normalize(F.col("t"), lowercase=False) == kept)).count() == 0
    assert rows.filter(~(bert_words(F.col("t")) == words)).count() == 0


def test_longest_match_is_walked_in_lists():
    import pickle

    from corpusloom.operators.longest import LongestMatch

    match = LongestMatch(["a", "ab", "##c", "##cd", "##d"])
    assert match.cut("abccd") == ["ab", "##c", "##cd"] and match.cut("abx") == ["[UNK]"]
    assert all(isinstance(part, list) for part in match._as_lists())
    assert pickle.loads(pickle.dumps(match)).cut("ad") == ["a", "##d"]


def test_arcs_are_ordered_by_counting_or_comparing():
    from corpusloom.operators.vocab.lattice import _by_offset_and_size

    rng = np.random.default_rng(3)
    for longest in (50, 5000):
        offset, size = rng.integers(0, longest, 4000), rng.integers(1, 17, 4000)
        assert _by_offset_and_size(offset, size).tolist() == np.lexsort((size, offset)).tolist()
    assert len(_by_offset_and_size(offset[:0], size[:0])) == 0
