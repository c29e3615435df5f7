"""Trainers and encoders against public libraries and brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import bert_normalize, bert_words, mark_words, pretokenize
from corpusloom.operators import encode
from corpusloom.operators.segment import (
    best_path, expected_pieces, merge_pieces, piece_weights, prefix_table, _expected_by_logs, _arcs,
)
from corpusloom.operators.stats import word_counts
from corpusloom.operators.vocab import merges as mg
from corpusloom.operators.vocab import simple, table as vt
from corpusloom.operators.vocab.bpe import train_bpe, train_wordpiece
from corpusloom.operators.vocab.symbols import IndexedBlock, Keys, spell
from corpusloom.operators.vocab.unigram import train_unigram
from corpusloom.plans import queries

spm = pytest.importorskip("sentencepiece")


def library(lines, folder, model, size, **options):
    (folder / "text.txt").write_text("\n".join(lines) + "\n")
    settings = dict(
        input=str(folder / "text.txt"), model_prefix=str(folder / model), vocab_size=size, model_type=model,
        character_coverage=0.9995, normalization_rule_name="identity", unk_id=0, bos_id=1, eos_id=2, pad_id=3,
        hard_vocab_limit=False, minloglevel=4,
    )
    spm.SentencePieceTrainer.train(**{**settings, **options})
    return spm.SentencePieceProcessor(model_file=str(folder / f"{model}.model"))


def as_table(spark, processor):
    def kind(i):
        if processor.is_unknown(i):
            return "unknown"
        return "control" if processor.is_control(i) else "byte" if processor.is_byte(i) else "learned"

    rows = [(i, processor.id_to_piece(i), processor.get_score(i), kind(i)) for i in range(processor.get_piece_size())]
    return spark.createDataFrame(rows, vt.VOCABULARY)


def pieces(vocab):
    return [r["piece"] for r in vocab.orderBy("id").collect()]


@pytest.fixture(scope="module")
def segments(sentences):
    return word_counts(sentences[1], pretokenize(F.col("text"), split_scripts=True)).persist()


@pytest.fixture(scope="module")
def bpe(spark, sentences, segments, tmp_path_factory):
    return train_bpe(spark, segments, 500), library(sentences[0], tmp_path_factory.mktemp("bpe"), "bpe", 500)


def test_bpe_equals_library(bpe):
    mine, lib = bpe
    rows = mine.orderBy("id").collect()
    assert [r["piece"] for r in rows] == [lib.id_to_piece(i) for i in range(500)]
    assert [r["score"] for r in rows] == [lib.get_score(i) for i in range(500)]


def test_encoding_equals_library(spark, sentences, bpe):
    mine, lib = bpe
    odd = ["漢字 x", "a▁b", "<s> hi", "", "  two  spaces "]
    frame = sentences[1].unionByName(spark.createDataFrame([(t,) for t in odd[3:]], "text string"))
    encoded = encode.encode_ids(encode.encode_pieces(frame, mine, "bpe"), mine, "bpe").collect()
    assert all(r["pieces"] == lib.encode(r["text"], out_type=str) for r in encoded)
    assert all(r["ids"] == lib.encode(r["text"]) for r in encoded)
    assert len(encoded) > 1000


def test_round_trip_and_previews(spark, sentences, bpe):
    encoded = encode.encode_ids(encode.encode_pieces(sentences[1], bpe[0], "bpe"), bpe[0], "bpe").withColumn("k", F.lit(1))
    assert encode.roundtrip_check(encoded, "k").first()["mismatch_rate"] < 0.05
    shown = encoded.select(encode.token_preview(F.col("pieces"), 3).alias("p"), F.size("pieces").alias("n")).collect()
    assert all(r["p"].endswith(" ...") == (r["n"] > 3) for r in shown)
    back = encode.ids_to_pieces(encoded, bpe[0], out="back").filter("NOT array_contains(ids, 0)")
    assert back.filter(F.col("back") != F.col("pieces")).count() == 0 < back.count()


def test_unknown_control_user_and_bytes(spark):
    words = spark.createDataFrame([("▁aba", 5), ("▁b", 2)], "word string, n long")
    user = simple.train_char(spark, words, 50, user=["[x]"], control=["<c>"])
    text = spark.createDataFrame([("ab[x]a z漢 <c>",)], "text string")
    got = encode.encode_pieces(text, user, "char").first()["pieces"]
    assert got == ["▁", "a", "b", "[x]", "a", "▁", "z漢", "▁", "<c>"]
    full = simple.train_char(spark, words, 400, byte_fallback=True)
    spelled = encode.encode_pieces(text.withColumn("text", F.lit("a 漢")), full, "char")
    assert spelled.first()["pieces"] == ["▁", "a", "▁", "<0xE6>", "<0xBC>", "<0xA2>"]
    assert spelled.select(encode.decode_with_bytes(F.col("pieces"))).first()[0] == "a 漢"
    ids = encode.encode_ids(text, user, "char").first()["ids"]
    assert ids[6] == 0 and pieces(user)[:6] == ["<unk>", "<s>", "</s>", "<pad>", "<c>", "[x]"]


def adjacent(word):
    return list(zip(word, word[1:]))


def one_by_one(table, wanted, max_length=16, min_count=1):
    """Plain greedy merging with full recounts."""
    words = [[list(w), n] for w, n in table]
    known, found = set(), []
    while len(found) < wanted:
        counts = Counter()
        for word, n in words:
            for pair in adjacent(word):
                counts[pair] += n
        allowed = [p for p, n in counts.items() if n >= min_count and len("".join(p)) <= max_length and "".join(p) not in known]
        if not allowed:
            break
        best = min(allowed, key=lambda p: (-counts[p], len("".join(p)), "".join(p)))
        found.append(("".join(best), counts[best]))
        known.add("".join(best))
        for entry in words:
            word, out = entry[0], []
            while word:
                step = 2 if tuple(word[:2]) == best else 1
                out.append("".join(word[:step]))
                word = word[step:]
            entry[0] = out
    return found


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("tracked", [200_000, 12])
def test_batched_merges_equal_one_by_one(spark, monkeypatch, seed, tracked):
    """Ties and runs of equal letters on purpose; also with few pairs tracked on the driver."""
    monkeypatch.setattr(mg, "TRACKED_PAIRS", tracked)
    monkeypatch.setattr(mg, "ROUNDS_PER_TABLE", 3)
    rng = random.Random(seed)
    table = {"".join(rng.choice("aabc") for _ in range(rng.randint(1, 10))): rng.randint(1, 4) for _ in range(40)}
    words = spark.createDataFrame(list(table.items()), "word string, n long")
    got = mg.learn_merges(spark, words, 30, mg.MergeOptions(max_length=6))
    assert [tuple(g) for g in got] == one_by_one(table.items(), 30, 6)


def test_merges_of_cached_blocks_and_of_many_files(spark, monkeypatch):
    """Blocks as rows, where the shared folder is no mounted file system, and several files a task."""
    rng = random.Random(9)
    table = {"".join(rng.choice("aabcd") for _ in range(rng.randint(1, 8))): rng.randint(1, 9) for _ in range(60)}
    words = spark.createDataFrame(list(table.items()), "word string, n long").repartition(3)
    wanted = one_by_one(table.items(), 40)
    monkeypatch.setattr(mg, "ROUNDS_PER_TABLE", 4)
    monkeypatch.setattr(mg, "WORDS_PER_PARTITION", 3)
    trainer = mg.MergeTrainer(spark, words, mg.MergeOptions())
    assert trainer._tasks < len(trainer._files) and [tuple(g) for g in trainer.run(40)] == wanted
    trainer.close()
    monkeypatch.setattr(mg, "local_path", lambda spark, path: None)
    assert [tuple(g) for g in mg.learn_merges(spark, words, 40, mg.MergeOptions())] == wanted


@pytest.mark.parametrize("tracked", [1, 3])
def test_ties_wider_than_the_tracked_pairs(spark, monkeypatch, tracked):
    monkeypatch.setattr(mg, "TRACKED_PAIRS", tracked)
    table = [(a + b, 5) for a, b in zip("abcdefghij", "klmnopqrst")]
    words = spark.createDataFrame(table, "word string, n long")
    got = mg.learn_merges(spark, words, 20, mg.MergeOptions())
    assert [tuple(g) for g in got] == one_by_one(table, 20) and len(got) == 10
    table = [("abab", 2), ("ab", 3), ("aab", 5), ("ba", 5), ("abba", 5)]
    words = spark.createDataFrame(table, "word string, n long")
    assert [tuple(g) for g in mg.learn_merges(spark, words, 20, mg.MergeOptions())] == one_by_one(table, 20)


def test_rounds_touch_only_words_of_their_pairs(tmp_path):
    rng = random.Random(1)
    words = np.array(["".join(rng.choices("abcd", k=rng.randrange(0, 9))) for _ in range(300)], object)
    plain = spell(words, np.arange(len(words)), None)
    index = IndexedBlock.of(plain)
    index = next(IndexedBlock.read([index.to_arrow()]))
    index.save(f"{tmp_path}/block")
    stored = IndexedBlock.load(f"{tmp_path}/block")
    assert all((getattr(stored, name) == getattr(index, name)).all() for name in IndexedBlock.COLUMNS)
    for pair in ("ab", "cc", "dz"):
        code = np.array([(ord(pair[0]) << 32) | ord(pair[1])])
        held = index.holding(code)
        assert [words[w] for w in held] == [w for w in words if pair in w]
        taken = index.take(held)
        assert "".join(map(chr, taken.symbols)) == "".join(words[held]) and taken.weight.tolist() == held.tolist()
    assert (index.whole().symbols == plain.symbols).all() and (index.whole().word == plain.word).all()


def test_pairs_are_found_by_table_and_by_search(monkeypatch):
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 9, 500)
    keys = np.unique((rng.integers(1, 9, 12) << 32) | rng.integers(1, 12, 12))
    codes = (symbols[:-1] << 32) | symbols[1:]
    places = [k for k, c in enumerate(codes.tolist()) if c in set(keys.tolist())]
    for many, cells in ((1, 1 << 20), (1, 1), (1 << 16, 1)):
        monkeypatch.setattr(Keys, "MANY_SYMBOLS", many)
        monkeypatch.setattr(Keys, "MOST_CELLS", cells)
        at, slot = Keys(keys).among(symbols)
        assert at.tolist() == places and (keys[slot] == codes[at]).all()
        assert not len(Keys(keys[:0]).among(symbols)[0]) and not len(Keys(keys).among(symbols[:1])[0])


def test_merges_run_out_softly_or_fail(spark):
    words = spark.createDataFrame([("aaaa", 1), ("abab", 1), ("b", 3)], "word string, n long")
    vocab = train_bpe(spark, words, 100, 1.0)
    assert pieces(vocab)[4:] == ["aa", "ab", "aaaa", "abab", "a", "b"]
    with pytest.raises(ValueError):
        train_bpe(spark, words, 100, 1.0, strict=True)
    assert max(map(len, pieces(train_bpe(spark, words, 100, 1.0, max_piece_length=2))[4:])) == 2


def test_bpe_query_trains_a_whole_vocabulary(spark, tmp_path):
    """Words that need more than 600 pieces all become pieces."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(400)]
    rows = [(i, " ".join([w] * (i % 40 + 1)), "en", "s", 0) for i, w in enumerate(words)]
    spark.createDataFrame(rows, queries.DOCUMENT_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    made = pieces(queries.QUERIES["train_bpe"](spark, str(tmp_path)))
    assert {f"▁{w}" for w in words} <= set(made) and 600 < len(made) <= 8000


def test_word_and_char_scores_equal_library(spark, sentences, tmp_path):
    words = word_counts(sentences[1], mark_words(F.col("text")))
    for model, mine in (("char", simple.train_char(spark, words, 90, 0.9995)), ("word", simple.train_word(spark, words, 300))):
        lib = library(sentences[0], tmp_path, model, 300 if model == "word" else 90)
        theirs = {lib.id_to_piece(i): lib.get_score(i) for i in range(4, lib.get_piece_size())}
        rows = {r["piece"]: r["score"] for r in mine.filter("id >= 4").collect()}
        shared = set(rows) & set(theirs)
        assert len(shared) >= 0.97 * len(theirs)
        assert all(abs(rows[p] - theirs[p]) < 1e-3 for p in shared)


def test_unigram_is_as_good_as_library(spark, sentences, segments, tmp_path):
    mine = train_unigram(spark, segments, 400, seed_size=3000)
    lib = library(sentences[0], tmp_path, "unigram", 400)
    size = lambda vocab: encode.encode_pieces(sentences[1], vocab, "unigram").agg(F.sum(F.size("pieces"))).first()[0]
    theirs = as_table(spark, lib)
    assert mine.count() == 400 and size(mine) <= 1.03 * size(theirs)
    assert len(set(pieces(mine)) & set(pieces(theirs))) > 300
    same = encode.encode_pieces(sentences[1], theirs, "unigram").collect()
    assert sum(r["pieces"] == lib.encode(r["text"], out_type=str) for r in same) >= 0.99 * len(same)


def test_wordpiece_matches_library(spark, sentences, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    words = word_counts(sentences[1], bert_words(bert_normalize(F.col("text"))))
    mine = train_wordpiece(spark, words, 400)
    (tmp_path / "t.txt").write_text("\n".join(sentences[0]) + "\n")
    lib = tokenizers.BertWordPieceTokenizer(lowercase=True)
    lib.train(str(tmp_path / "t.txt"), vocab_size=400, show_progress=False)
    # Equal counts come in no fixed order there.
    assert len(set(pieces(mine)) & set(lib.get_vocab())) >= 390 and mine.count() == 400
    ids = lib.get_vocab()
    theirs = spark.createDataFrame([(i, p, 0.0, "control" if p[0] == "[" and len(p) > 3 else "learned") for p, i in ids.items()], vt.VOCABULARY)
    got = encode.encode_pieces(sentences[1], theirs, "wordpiece").collect()
    expected = [lib.encode(r["text"], add_special_tokens=False).tokens for r in got]
    assert sum(r["pieces"] == e for r, e in zip(got, expected)) >= 0.99 * len(got)


def test_lattice_helpers():
    scores = {"a": -1.0, "b": -1.5, "ab": -1.2, "aba": -4.0}
    table, weights = prefix_table(scores), piece_weights(prefix_table(scores), 2.0)
    assert best_path("abab", table, -9.0) == ["ab", "ab"]
    assert best_path("ab", table, -9.0, whole=False) == ["a", "b"]
    got = expected_pieces("abaz", weights, 1e-4)
    logs = _expected_by_logs("abaz", [_arcs("abaz", i, weights, 1e-4) for i in range(4)])
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 for a, b in zip(got, logs))
    assert abs(sum(len(p) * v for p, v in got) - 4) < 1e-9
    assert merge_pieces(list("aaab"), {"aa": -1.0, "ab": -0.5}) == ["aa", "ab"]


def test_vocab_diff(spark):
    old, new = (vt.vocabulary(spark, [(p, 0.0, "learned") for p in ps]) for ps in ("abc", "axbd"))
    got = {r["piece"]: r["status"] for r in vt.vocab_diff(old, new).collect()}
    assert got == {"a": "kept", "b": "moved", "c": "removed", "d": "added", "x": "added"}
    assert vt.needs_new_decoder(old, new)
