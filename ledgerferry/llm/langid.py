"""Language identification: a linear-chain conditional random field over the words of a text.

Each word has hashed affix, n-gram and lexicon features; neighbouring labels have learned
transition scores, so switches of language inside a text are labelled word by word, by
forward-backward over the whole text. A document's language is that of the largest mean marginal.

Training uses at most TRAIN_DOCS documents of each language: sequences are put together from
pieces of texts of several languages, which makes code-switched text with known labels.

Forward-backward of a long text is cut into segments. The product of a segment's transfer
matrices carries the messages across it, so all segments of many texts run side by side; this
is exact.

Defined results: null text, or text without letters: `und` and score 0; the same everywhere if there
is nothing to learn from; rows are independent, so repeated rows and ids repeat; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerferry.llm.common import WORD, bucket, release, slices, small_batches, tidy, worker_held
from ledgerferry.llm.wordfeatures import ROWS, Adam, Ragged, WordTable, word_features

#: Bounds of the training sample, and the shape of its sequences.
TRAIN_DOCS = 300
SEQUENCE, BATCH, STEPS = 40, 96, 160
PIECE_WORDS = (3, 20)
#: A word of the lexicon was seen this often, and in this share in one language.
LEXICON_COUNT, LEXICON_SHARE = 3, 0.9
SEGMENT = 64
HELD_OUT_MOD, HELD_OUT = 4, 2


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(text, lang) of the first TRAIN_DOCS documents of each language by hash, held-out ones left out.

    Ids are chosen from narrow rows. Of a large language a share by hash that holds about
    twice as many is ranked, so no task gets a whole language.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    named = named.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & (bucket("id", HELD_OUT_MOD) != HELD_OUT))
    spot = F.xxhash64("id")
    share = F.least(F.lit(1.0), 2.0 * TRAIN_DOCS / F.col("rows")) * 2.0**63
    few = named.select("id", "lang").join(F.broadcast(named.groupBy("lang").agg(F.count("*").alias("rows"))), "lang").where(F.abs(spot.cast("double")) <= share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(spot, "id"))
    chosen = few.distinct().withColumn("k", rank).where(F.col("k") <= TRAIN_DOCS).select("id", "lang")
    return named.join(F.broadcast(chosen), ["id", "lang"], "left_semi").groupBy("id", "lang").agg(F.min("text").alias("text")).select("text", "lang")


def fit(docs: DataFrame) -> Model | None:
    """A model from the training sample, which is small enough for the driver."""
    model = train([tuple(r) for r in training_rows(docs).collect()])
    release()
    return model


class Model:
    def __init__(self, labels: list[str], weights: np.ndarray, lexicon: dict[str, int], lexical: np.ndarray, moves: np.ndarray):
        self.labels, self.weights, self.lexicon, self.lexical, self.moves = labels, weights, lexicon, lexical, moves
        self.key = hashlib.sha256(weights.tobytes()).hexdigest()

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of words of like length."""
        known = [self.lexicon.get(w, len(self.labels)) for w in words]
        return self.weights[word_features(words)].sum(1) + self.lexical[known]


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Fit weights and transitions by stochastic gradients of the log-likelihood."""
    texts: dict[str, list[list[str]]] = {}
    for text, lang in sorted(rows, key=lambda r: (r[1], r[0] or "")):
        words = [sys.intern(w) for w in WORD.findall((text or "").lower())]
        if words:
            texts.setdefault(lang, []).append(words)
    labels = sorted(texts)
    if not labels:
        return None
    k, rng = len(labels), np.random.default_rng(seed)
    counts = [Counter(w for words in texts[lang] for w in words) for lang in labels]
    total = sum(counts, Counter())
    lexicon = {w: i for i, c in enumerate(counts) for w, n in c.items() if n >= LEXICON_COUNT and n >= LEXICON_SHARE * total[w]}

    def sequence() -> tuple[list[str], list[int]]:
        words, tags = [], []
        while len(words) < SEQUENCE:
            i = int(rng.integers(k))
            source = texts[labels[i]][int(rng.integers(len(texts[labels[i]])))]
            size = int(rng.integers(*PIECE_WORDS)) if rng.random() < 0.8 else SEQUENCE
            start = int(rng.integers(max(1, len(source) - size + 1)))
            piece = source[start : start + size]
            words += piece
            tags += [i] * len(piece)
        return words[:SEQUENCE], tags[:SEQUENCE]

    p = {"w": np.zeros((ROWS, k), np.float32), "lex": np.zeros((k + 1, k), np.float32), "a": np.zeros((k, k), np.float32)}
    adam = Adam(p, 0.05)
    for _ in range(STEPS):
        made = [sequence() for _ in range(BATCH)]
        flat = [w for words, _ in made for w in words]
        own = sorted(set(flat))
        place = {w: i for i, w in enumerate(own)}
        at = np.array([place[w] for w in flat]).reshape(BATCH, SEQUENCE)
        gold = np.array([tags for _, tags in made])
        features = Ragged.of(own)
        known = np.array([lexicon.get(w, k) for w in own])
        e = (p["w"][features.whole] + features.sums(p["w"]) + p["lex"][known])[at]
        mask = np.ones((BATCH, SEQUENCE), bool)
        marginals, moved = _posteriors(np.exp(e - e.max(2, keepdims=True)).astype(np.float64), mask, np.exp(p["a"].astype(np.float64)), pairs=True)
        wrong = marginals - np.eye(k)[gold]
        by_word = np.zeros((len(own), k))
        np.add.at(by_word, at.ravel(), wrong.reshape(-1, k))
        lex = np.zeros((k + 1, k))
        np.add.at(lex, known, by_word)
        lex[k] = 0  # words outside the lexicon
        moves = moved - np.add.reduce(np.eye(k)[gold[:, :-1]][..., :, None] * np.eye(k)[gold[:, 1:]][..., None, :], axis=(0, 1))
        unique, g = features.gradient(by_word.astype(np.float32))
        both = np.union1d(unique, features.whole)
        total_g = np.zeros((len(both), k), np.float32)
        total_g[np.searchsorted(both, unique)] = g
        np.add.at(total_g, np.searchsorted(both, features.whole), by_word.astype(np.float32))
        adam.step({"w": (both, total_g / BATCH + 1e-4 * p["w"][both]), "lex": (lex / BATCH).astype(np.float32), "a": (moves / BATCH + 1e-3 * p["a"]).astype(np.float32)})
    return Model(labels, p["w"], lexicon, p["lex"], p["a"])


def _posteriors(e: np.ndarray, mask: np.ndarray, a: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None, pairs: bool = False):
    """Marginals of segments (s, t, k) of positive scores, given messages into their two ends."""
    s, t, k = e.shape
    forward = np.empty((t, s, k))
    message = np.full((s, k), 1.0 / k) if start is None else start
    for i in range(t):
        new = (message @ a) * e[:, i]
        new /= new.sum(1, keepdims=True)
        message = np.where(mask[:, i, None], new, message)
        forward[i] = message
    back = np.ones((s, k)) if end is None else end
    out, moved = np.empty((s, t, k)), np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        product = forward[i] * back
        out[:, i] = product / product.sum(1, keepdims=True)
        weighted = e[:, i] * back
        if pairs and i:
            joint = forward[i - 1][:, :, None] * a * weighted[:, None, :]
            moved += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        new = weighted @ a.T
        new /= new.sum(1, keepdims=True)
        back = np.where(mask[:, i, None], new, back)
    return (out, moved) if pairs else out


def marginals(e: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label marginals (n, k) of words (n, k), the words of texts one after the other.

    Segments of SEGMENT words run side by side. Messages into each come from the products of the
    transfer matrices of those before and after it in its text.
    """
    n, k = e.shape
    a = np.exp(moves.astype(np.float64))
    e = np.exp(e - e.max(1, keepdims=True)).astype(np.float64)
    lengths = lengths[lengths > 0]
    count = -(-lengths // SEGMENT)
    doc = np.repeat(np.arange(len(lengths)), count)
    order = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)  # in its text
    begin = np.repeat(np.cumsum(lengths) - lengths, count) + order * SEGMENT
    size = np.minimum(SEGMENT, np.repeat(lengths, count) - order * SEGMENT)
    at = np.minimum(begin[:, None] + np.arange(SEGMENT), n - 1)
    mask = np.arange(SEGMENT) < size[:, None]
    cube = e[at]
    start, end = np.full((len(doc), k), np.nan), np.ones((len(doc), k))
    # A text begins as if every label before it were as likely, through the transitions.
    start[order == 0] = 1.0 / k
    if count.max() > 1:
        product = np.broadcast_to(np.eye(k), (len(doc), k, k)).copy()
        for i in range(SEGMENT):
            new = (product.reshape(-1, k) @ a).reshape(-1, k, k) * cube[:, i, None, :]
            new /= new.sum((1, 2), keepdims=True)
            product = np.where(mask[:, i, None, None], new, product)
        for j in range(1, count.max()):
            here = np.flatnonzero(order == j)
            message = np.einsum("sk,skl->sl", start[here - 1], product[here - 1])
            start[here] = message / message.sum(1, keepdims=True)
        last = np.repeat(count, count) - 1 - order  # segments that follow in the text
        for j in range(1, count.max()):
            here = np.flatnonzero(last == j)
            message = np.einsum("skl,sl->sk", product[here + 1], end[here + 1])
            end[here] = message / message.sum(1, keepdims=True)
    return _posteriors(cube, mask, a, start, end)[mask]


def _labelled(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[tuple]:
    """For slices of rows: ids, lists of words, lengths, and marginals of all their words."""
    for batch in slices(batches):
        texts = [WORD.findall((t or "").lower()) for t in batch.column(1).to_pylist()]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        if model is None or not lengths.sum():
            yield batch.column(0), texts, lengths, np.zeros((0, 0))
            continue
        table = worker_held(__name__, model.key, lambda: WordTable(model.scores, len(model.labels)))
        rows = table.look_up([w for t in texts for w in t])
        yield batch.column(0), texts, lengths, marginals(table.rows[rows], lengths, model.moves)


def label_words(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, its words, and the label of each."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, lengths, m in _labelled(batches, held.value):
            best = [held.value.labels[i] for i in m.argmax(1)] if len(m) else ["und"] * int(lengths.sum())
            cuts = np.concatenate([[0], np.cumsum(lengths)])
            labels = [best[cuts[i] : cuts[i + 1]] for i in range(len(texts))]
            yield pa.record_batch([ids, pa.array(texts, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string()))], ["id", "words", "labels"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, words array<string>, labels array<string>")


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (the mean marginal), n_words, n_switches."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, lengths, m in _labelled(batches, held.value):
            lang, score, switches = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            if len(m):
                some = np.flatnonzero(lengths)
                first = (np.cumsum(lengths) - lengths)[some]
                mean = np.add.reduceat(m, first, axis=0) / lengths[some, None]
                best = m.argmax(1)
                change = np.concatenate([[0], (best[1:] != best[:-1]).astype(np.int64)])
                change[first] = 0
                switches[some] = np.add.reduceat(change, first)
                score[some] = np.clip(mean.max(1), 0.0, 1.0)
                for i, k in zip(some, mean.argmax(1), strict=True):
                    lang[i] = held.value.labels[k]
            yield pa.record_batch([ids, pa.array(lang, pa.string()), pa.array(score), pa.array(lengths), pa.array(switches)], ["id", "lang_pred", "score", "n_words", "n_switches"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, lang_pred string, score double, n_words long, n_switches long")


def digest(predicted: DataFrame) -> DataFrame:
    held = (bucket("doc_id", HELD_OUT_MOD) == HELD_OUT).alias("held_out")
    return predicted.withColumnRenamed("id", "doc_id").select("doc_id", held, "lang_pred", "score", "n_words", "n_switches")
