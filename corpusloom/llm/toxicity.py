"""Toxic spans by a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out, mapped, table

# Bounds of the sample that the classifier is fitted on, drawn by a hash of doc_id: documents with and
# without the label, and the longest text taken (for fitting only; scoring takes whole texts).
FIT_TOXIC, FIT_CLEAN, FIT_CHARACTERS = 1500, 3000, 20_000
# A feature marks toxic words if it stands in this many different surroundings in toxic texts, and
# in at most this share of as many clean ones.
MIN_CONTEXTS, MAX_CLEAN_SHARE = 8, 0.02
FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
HASH_SIZE = 1 << 17
PIECE, MOST_PLAIN_PIECES = 32, 9000
_STEPS, _RATE, _DECAY = 90, 0.25, 2e-4
_CACHE = 300_000
_CHUNK = 64
_WORD = re.compile(r"\S+")


def normal(word: str) -> str:
    """A word without case and without the marks around it."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def word_features(word: str) -> list[str]:
    """The word itself, its beginnings and its endings."""
    return [f"w{word}", f"a{word[:3]}", f"b{word[:4]}", f"c{word[:5]}", f"y{word[-3:]}", f"z{word[-4:]}"]


def hashed(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "replace")) & (HASH_SIZE - 1) for f in word_features(word)]


def marking_features(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Features that tell toxic words: many surroundings in toxic texts, next to none in clean ones.

    Surroundings are counted, not texts: the words of a text that was copied a thousand times stand
    in the same few surroundings.
    """
    around, seen = defaultdict(set), defaultdict(int)
    for words in toxic:
        for before, word, after in zip(["", *words], words, [*words[1:], ""]):
            if len(word) > 2:
                place = hash((before, after))
                for f in (f for f in word_features(word)[:4] if f[0] == "w" or len(f) > 4):
                    around[f].add(place)
    candidates = {f: len(places) for f, places in around.items() if len(places) >= MIN_CONTEXTS}
    for words in clean:
        for word in set(words):
            for f in word_features(word)[:4]:
                if f in candidates:
                    seen[f] += 1
    scale = len(toxic) / max(1, len(clean))
    return {f for f, n in candidates.items() if seen[f] * scale <= MAX_CLEAN_SHARE * n}


def _forward_backward(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray):
    """Marginals of the toxic state and of the four moves for padded pieces."""
    n, size = scores.shape
    node, move = np.exp(np.clip(scores, -30, 30)), np.exp(moves)
    f = np.ones((size, n, 2))
    f[0, :, 1] = node[:, 0]
    f[0] /= f[0].sum(1, keepdims=True)
    for t in range(1, size):
        step = f[t - 1] @ move
        step[:, 1] *= node[:, t]
        step /= step.sum(1, keepdims=True)
        f[t] = np.where((t < lengths)[:, None], step, f[t - 1])
    b = np.ones((size, n, 2))
    pairs = np.zeros((2, 2))
    for t in range(size - 2, -1, -1):
        ahead = b[t + 1].copy()
        ahead[:, 1] *= node[:, t + 1]
        inside = t + 1 < lengths
        joint = f[t][:, :, None] * move[None] * ahead[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pairs += joint[inside].sum(0)
        step = ahead @ move.T
        step /= step.sum(1, keepdims=True)
        b[t] = np.where(inside[:, None], step, 1.0)
    both = f * b
    return (both[:, :, 1] / both.sum(2)).T, pairs


def fit_field(pieces: list[tuple[list[str], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights of the toxic state and the 2x2 transition weights, by likelihood with weight decay."""
    known: dict[str, list[int]] = {}
    n = len(pieces)
    index = np.zeros((n, PIECE, 6), np.int64)
    gold, mask = np.zeros((n, PIECE)), np.zeros((n, PIECE), bool)
    for k, (words, tags) in enumerate(pieces):
        for t, word in enumerate(words):
            if word not in known:
                known[word] = hashed(word)
            index[k, t] = known[word]
        gold[k, : len(tags)], mask[k, : len(tags)] = tags, True
    lengths = mask.sum(1)
    tags = gold.astype(int)
    inside = mask[:, 1:]
    counted = np.zeros((2, 2))
    np.add.at(counted, (tags[:, :-1][inside], tags[:, 1:][inside]), 1)
    flat, total = index[mask], max(1, int(mask.sum()))
    weights, moves, bias = np.zeros(HASH_SIZE), np.zeros((2, 2)), -3.0
    past_w, past_m, past_b = np.zeros(HASH_SIZE) + 1e-8, np.zeros((2, 2)) + 1e-8, 1e-8
    for _ in range(_STEPS):
        scores = weights[index].sum(2) + bias
        marginal, pairs = _forward_backward(scores, moves, lengths)
        error = (gold - marginal)[mask]
        slope = np.bincount(flat.ravel(), np.repeat(error, 6), HASH_SIZE) / total - _DECAY * weights / 100
        past_w += slope**2
        weights += _RATE * slope / np.sqrt(past_w)
        slope_m = (counted - pairs) / total - _DECAY * moves
        past_m += slope_m**2
        moves += _RATE * slope_m / np.sqrt(past_m)
        slope_b = error.sum() / total
        past_b += slope_b**2
        bias += _RATE * slope_b / np.sqrt(past_b)
    return np.append(weights, bias), moves


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Toxic-state marginals of joined texts, exactly, however long a text is.

    Texts are cut into chunks whose transfer matrices are multiplied side by side; the messages at
    chunk borders follow text by text, and those inside chunks side by side again.
    """
    if not len(scores):
        return np.empty(0)
    chunks = -(-lengths // _CHUNK)
    first = np.concatenate(([0], np.cumsum(chunks)))
    begin = np.concatenate(([0], np.cumsum(lengths)))
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(scores)) - begin[text]
    row, col = first[text] + within // _CHUNK, within % _CHUNK
    n = int(first[-1])
    node = np.zeros((_CHUNK, n))
    node[col, row] = np.exp(np.clip(scores, -30, 30))
    real = np.zeros((_CHUNK, n), bool)
    real[col, row] = True
    move = np.exp(moves)
    opening = np.zeros(n, bool)
    opening[first[:-1][chunks > 0]] = True

    def forward(f, t):
        # A text's first word has no move before it.
        start = opening & (t == 0)
        a = np.where(start, f[0], f[0] * move[0, 0] + f[1] * move[1, 0])
        b = np.where(start, f[1], f[0] * move[0, 1] + f[1] * move[1, 1]) * node[t]
        a, b = np.where(real[t], a, f[0]), np.where(real[t], b, f[1])
        return a, b

    def normed(a, b):
        s = a + b
        return a / s, b / s

    # Transfer of each chunk: where the two unit vectors go, scaled by a common factor.
    p, q = (np.ones(n), np.zeros(n)), (np.zeros(n), np.ones(n))
    for t in range(_CHUNK):
        p, q = forward(p, t), forward(q, t)
        s = p[0] + p[1] + q[0] + q[1]
        p, q = (p[0] / s, p[1] / s), (q[0] / s, q[1] / s)
    at_start, at_end = np.ones((2, n)) / 2, np.ones((2, n)) / 2
    for k in range(1, int(chunks.max(initial=0))):
        now = first[:-1][chunks > k] + k
        a, b = at_start[:, now - 1]
        f = normed(a * p[0][now - 1] + b * q[0][now - 1], a * p[1][now - 1] + b * q[1][now - 1])
        at_start[:, now] = f
    for k in range(int(chunks.max(initial=0)) - 2, -1, -1):
        now = first[:-1][chunks > k + 1] + k
        a, b = at_end[:, now + 1]
        at_end[:, now] = normed(p[0][now + 1] * a + p[1][now + 1] * b, q[0][now + 1] * a + q[1][now + 1] * b)
    f, ahead = np.empty((_CHUNK, 2, n)), np.empty((_CHUNK, 2, n))
    state = tuple(at_start)
    for t in range(_CHUNK):
        state = normed(*forward(state, t))
        f[t] = state
    state = tuple(at_end)
    for t in range(_CHUNK - 1, -1, -1):
        ahead[t] = state
        a, b = state[0], state[1] * node[t]
        back = normed(move[0, 0] * a + move[0, 1] * b, move[1, 0] * a + move[1, 1] * b)
        state = tuple(np.where(real[t], x, y) for x, y in zip(back, state))
    both = f * ahead
    return (both[:, 1] / both.sum(1))[col, row]


class Field:
    """The fitted field: word scores (remembered, bounded), marginals and document scores."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, scale: np.ndarray):
        self.weights, self.bias, self.moves, self.scale = weights[:-1].astype(np.float32), float(weights[-1]), moves, scale
        self.known: dict[str, float] = {}

    def __reduce__(self):
        return Field, (np.append(self.weights, self.bias), self.moves, self.scale)

    def word_score(self, raw: str) -> float:
        score = self.known.get(raw)
        if score is None:
            if len(self.known) >= _CACHE:
                self.known.clear()
            word = normal(raw[:200])
            score = float(self.weights[hashed(word)].sum()) + self.bias if word else -8.0
            self.known[raw] = score
        return score

    def tag(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of all texts, and the number of words of each."""
        score, scores, lengths = self.word_score, [], []
        for text in texts:
            words = text.split()
            lengths.append(len(words))
            scores.extend(map(score, words))
        lengths = np.array(lengths, np.int64)
        return marginals(np.array(scores, np.float64), lengths, self.moves), lengths

    def evidence(self, texts: list[str]):
        """Per text the logit of its largest marginal and the log of its expected toxic words; the marginals."""
        marginal, lengths = self.tag(texts)
        begin = np.concatenate(([0], np.cumsum(lengths)))
        top, mass = np.zeros(len(texts)), np.zeros(len(texts))
        some = np.flatnonzero(lengths)
        if len(some):
            top[some] = np.maximum.reduceat(marginal, begin[:-1][some])
            mass[some] = np.add.reduceat(np.where(marginal > 0.1, marginal, 0.0), begin[:-1][some])
        top = np.clip(top, 1e-4, 1 - 1e-4)
        return np.stack((np.log(top / (1 - top)), np.log1p(mass), np.ones(len(texts))), 1), marginal, begin

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.scale, -40, 40)))


def fit(texts: list[tuple[str, int]]) -> Field:
    """The field from labelled texts: words are labelled by marking features, then the chain is fitted."""
    split = [([normal(w) for w in t.split()], y) for t, y in texts]
    marks = marking_features([w for w, y in split if y], [w for w, y in split if not y])
    pieces, plain = [], []
    for words, y in split:
        tags = [int(bool(y) and any(f in marks for f in word_features(w)[:4])) for w in words]
        for k in range(0, len(words), PIECE):
            piece = words[k : k + PIECE], tags[k : k + PIECE]
            (pieces if any(piece[1]) else plain).append(piece)
    order = np.random.default_rng(7).permutation(len(plain))[:MOST_PLAIN_PIECES]
    pieces = pieces[:MOST_PLAIN_PIECES] + [plain[k] for k in order]
    if not any(y for _, y in texts) or not pieces:
        return Field(np.append(np.zeros(HASH_SIZE), -8.0), np.zeros((2, 2)), np.array([1.0, 0.0, -4.0]))
    weights, moves = fit_field(pieces)
    field = Field(weights, moves, np.zeros(3))
    field.scale = _calibrate(field.evidence([t for t, _ in texts])[0], np.array([y for _, y in texts], float))
    return field


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of the document score, by Newton steps with a small ridge."""
    scale = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -30, 30)))
        slope = x.T @ (y - p) - 0.5 * scale
        scale = scale + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(x.shape[1]), slope)
    return scale


def fit_on(docs: DataFrame, labels: DataFrame) -> Broadcast:
    """Fit on a bounded, hash-drawn sample of the labelled rows outside the held-out fold; broadcast the field.

    Of conflicting labels of one document the toxic one holds; null labels and ids are left out.
    """
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.filter(~held_out("doc_id", FOLDS, HELD_OUT_FOLD))
    draw = F.xxhash64("doc_id", F.lit(17))
    chosen = rows.filter("toxic = 1").orderBy(draw, "doc_id").limit(FIT_TOXIC).union(
        rows.filter("toxic = 0").orderBy(draw, "doc_id").limit(FIT_CLEAN))
    chosen = {r["doc_id"]: r["toxic"] for r in chosen.collect()}
    spark = docs.sparkSession
    known = spark.createDataFrame(list(chosen.items()), "l_id long, toxic int")
    texts = docs.select("doc_id", "text").filter(f"length(text) <= {FIT_CHARACTERS}").join(F.broadcast(known), F.col("doc_id") == F.col("l_id"))
    sample = sorted({(r["doc_id"], r["text"], r["toxic"]) for r in texts.select("doc_id", "text", "toxic").collect()})
    return spark.sparkContext.broadcast(fit([(t, y) for _, t, y in sample[: FIT_TOXIC + FIT_CLEAN]]))


def tag_documents(docs: DataFrame, field: Broadcast) -> DataFrame:
    """``(doc_id, score, predicted, spans)`` per row: the document score and its offending spans.

    ``spans`` are ``(start, end, probability)`` in code points, one for every run of words with a
    toxic marginal of at least 0.5. Whole texts are tagged by exact forward-backward marginals. A null or empty
    text has no spans and the score of no evidence. Rows are independent: repeated rows and null ids are
    answered as they are; extra columns are ignored; an empty table gives none. A map without a shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, texts = field.value, [t or "" for t in batch.column("text").to_pylist()]
        evidence, marginal, begin = model.evidence(texts)
        scores = model.scores(evidence)
        spans: list[list] = [[] for _ in texts]
        hot = np.flatnonzero(marginal >= 0.5)
        for k in np.unique(np.searchsorted(begin, hot, side="right") - 1).tolist() if len(hot) else []:
            own, last = marginal[begin[k] : begin[k + 1]], -2
            for place, found in enumerate(_WORD.finditer(texts[k])):
                if own[place] >= 0.5:
                    if place == last + 1:
                        start, _, p = spans[k].pop()
                        spans[k].append((start, found.end(), max(p, float(own[place]))))
                    else:
                        spans[k].append((found.start(), found.end(), float(own[place])))
                    last = place
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        spans = [[{"start": a, "end": b, "probability": p} for a, b, p in row] for row in spans]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, kind)],
            ["doc_id", "score", "predicted", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, score double, predicted int, spans array<struct<start:int,end:int,probability:double>>")


def filter_toxic(docs: DataFrame, field: Broadcast) -> DataFrame:
    """The rows of ``docs`` that are not predicted as toxic; null and empty texts stay. A map without a shuffle."""

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = field.value
        scores = model.scores(model.evidence([t or "" for t in batch.column("text").to_pylist()])[0])
        return batch.filter(pa.array(scores < THRESHOLD))

    return mapped(docs, keep, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagged = tag_documents(docs, fit_on(docs, table(spark, sf_dir, "labels")))
    return tagged.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))
