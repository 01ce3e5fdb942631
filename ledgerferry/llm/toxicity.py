"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input joins an embedding of the word with one of its characters (affixes and n-grams,
hashed). Two recurrent networks read a window of words, one from either end; attention weighs
their states into one vector, and a logistic unit scores it. A text's score is that of its worst
window; windows of WINDOW words overlap by half, and together they cover the whole text.

Labels belong to whole texts, so training picks the window of a toxic text that the network
now finds worst, and the windows of clean texts it finds worst beside random ones. It starts from
log-odds of features in toxic against clean texts. The training sample has at most TRAIN_TOXIC
and TRAIN_CLEAN texts.

Defined results: null text, or text without letters, scores 0; without both labels to learn from all
texts score 0; rows are independent, so repeated rows and ids repeat; an empty table gives no
rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import WORD, bounded_sample, bucket, release, sigmoid, slices, small_batches, tidy, worker_held
from ledgerferry.llm.wordfeatures import ROWS, Adam, Ragged, WordTable, word_features

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN = 4, 8, 8
#: Bounds of the training sample, and the course of training.
TRAIN_TOXIC, TRAIN_CLEAN = 800, 1_600
BATCH, ROUNDS, STEPS = 128, 4, 100
HELD_OUT_MOD, HELD_OUT = 5, 0
#: From this score on a text counts as toxic.
LIMIT = 0.5
#: Windows that run side by side, and words whose features are looked up at a time.
SIDE, CHUNK = 1_024, 8_192
#: Training texts whose windows are scored together.
GROUP = 128


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, label) of the first labelled documents by hash, held-out ones left out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    known = known.where(F.col("id").isNotNull() & (bucket("id", HELD_OUT_MOD) != HELD_OUT))
    order: Column = F.struct(F.xxhash64("id"), "id", "label")
    chosen = bounded_sample(known.where("label = 1").distinct(), order, TRAIN_TOXIC).unionByName(bounded_sample(known.where("label = 0").distinct(), order, TRAIN_CLEAN))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")


def windows_of(length: int) -> np.ndarray:
    """Starts of the windows of a text; the last one ends with the text."""
    if length <= WINDOW:
        return np.zeros(min(length, 1), np.int64)
    return np.append(np.arange(0, length - WINDOW, STRIDE), length - WINDOW)


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """A network from the training sample, which is small enough for the driver."""
    network = train([tuple(r) for r in training_rows(docs, labels).collect()])
    release()
    return network


class Network:
    """Parameters, and both passes over batches of windows."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.key = hashlib.sha256(b"".join(p[k].tobytes() for k in sorted(p))).hexdigest()

    @classmethod
    def fresh(cls, odds: np.ndarray, seed: int) -> Network:
        """Small random numbers; the first part of both embeddings holds the features' log-odds."""
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        p = {"word": small(ROWS, WORD_DIM) * 0.1, "char": small(ROWS, CHAR_DIM) * 0.1}
        for k in ("word", "char"):
            p[k][:, 0] = odds
            p[k][0] = 0
        for d in "fb":
            p |= {f"x{d}": small(WORD_DIM + CHAR_DIM, 3 * HIDDEN), f"h{d}": small(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"att": small(2 * HIDDEN, HIDDEN), "v": small(HIDDEN), "out": small(2 * HIDDEN), "bias": np.full(1, -1.0, np.float32)}
        return cls(p)

    def inputs(self, features: np.ndarray) -> np.ndarray:
        """Word and character embeddings of words, from their features (the word itself first)."""
        return np.concatenate([self.p["word"][features[:, 0]], self.p["char"][features[:, 1:]].sum(1) / 8], 1)

    def inputs_of(self, words: Ragged) -> np.ndarray:
        return np.concatenate([self.p["word"][words.whole], words.sums(self.p["char"]) / 8], 1)

    def all_inputs(self, words: Ragged) -> np.ndarray:
        """The same for a whole vocabulary, in pieces: the embeddings of all features are large."""
        return np.concatenate([self.inputs_of(words.take(np.arange(s, min(s + CHUNK, len(words))))) for s in range(0, len(words), CHUNK)])

    def gates_of(self, x: np.ndarray) -> np.ndarray:
        """What inputs add to the gates of both directions."""
        return np.concatenate([x @ self.p["xf"] + self.p["bf"], x @ self.p["xb"] + self.p["bb"]], 1)

    def gates(self, words: list[str]) -> np.ndarray:
        return self.gates_of(self.inputs(word_features(words)))

    def _run(self, g: np.ndarray, mask: np.ndarray | None, d: str, keep: list | None = None) -> np.ndarray:
        """States (t, b, h) of one direction over gate inputs (t, b, 3h)."""
        t, b, _ = g.shape
        u, h, n = self.p[f"h{d}"], np.zeros((b, HIDDEN), np.float32), HIDDEN
        states = np.empty((t, b, n), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            inner = h @ u
            zr = g[i, :, : 2 * n] + inner[:, : 2 * n]
            np.tanh(zr * np.float32(0.5), out=zr)
            zr = zr * np.float32(0.5) + np.float32(0.5)
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(g[i, :, 2 * n :] + r * inner[:, 2 * n :])
            out = new + z * (h - new)
            if mask is not None:
                out *= mask[i, :, None]
            if keep is not None:
                keep.append((i, h, z, r, new, inner[:, 2 * n :]))
            states[i] = h = out
        return states

    def forward(self, g: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logits of windows from gate inputs (t, b, 6h) and a mask (t, b), None if all full."""
        f, b = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._run(g[:, :, : 3 * HIDDEN], mask, "f", f), self._run(g[:, :, 3 * HIDDEN :], mask, "b", b)], 2)
        u = np.tanh(states @ self.p["att"])
        s = u @ self.p["v"]
        if mask is not None:
            s = np.where(mask > 0, s, -1e9)
        w = np.exp(s - s.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tb,tbh->bh", w, states)
        if keep is not None:
            keep |= {"f": f, "b": b, "states": states, "u": u, "w": w, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"]

    def backward(self, keep: dict, mask: np.ndarray, dlogit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters above the gates, and of the gate inputs."""
        p, n, grads = self.p, HIDDEN, {}
        states, u, w = keep["states"], keep["u"], keep["w"]
        grads["out"], grads["bias"] = keep["pooled"].T @ dlogit, dlogit.sum(keepdims=True)
        dpooled = dlogit[:, None] * p["out"]
        dstates = w[:, :, None] * dpooled
        dw = np.einsum("tbh,bh->tb", states, dpooled)
        ds = w * (dw - (w * dw).sum(0))
        grads["v"] = np.einsum("tb,tbh->h", ds, u)
        du = ds[:, :, None] * p["v"] * (1 - u * u)
        grads["att"] = np.einsum("tbi,tbj->ij", states, du)
        dstates += du @ p["att"].T
        dg = np.zeros((*states.shape[:2], 6 * n), np.float32)
        for d, part in (("f", 0), ("b", 1)):
            own, hidden, gh = dstates[:, :, part * n : part * n + n], p[f"h{d}"], np.zeros_like(p[f"h{d}"])
            dh = np.zeros(own.shape[1:], np.float32)
            for i, h, z, r, new, inner in reversed(keep[d]):
                dout = (own[i] + dh) * mask[i, :, None]
                dz = dout * (h - new) * z * (1 - z)
                dn = dout * (1 - z) * (1 - new * new)
                dr = dn * inner * r * (1 - r)
                dinner = np.concatenate([dz, dr, dn * r], 1)
                gh += h.T @ dinner
                dh = dout * z + dinner @ hidden.T
                dg[i, :, part * 3 * n : part * 3 * n + 3 * n] = np.concatenate([dz, dr, dn], 1)
            grads[f"h{d}"] = gh
            grads[f"b{d}"] = dg[:, :, part * 3 * n : part * 3 * n + 3 * n].sum((0, 1))
        return grads, dg

    def score_windows(self, gates: np.ndarray, rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Logits of windows: rows of `gates` for all words, first word and size of each window."""
        out = np.empty(len(starts), np.float32)
        full = sizes == WINDOW
        for here in (np.flatnonzero(full), np.flatnonzero(~full)):
            for k in range(0, len(here), SIDE):
                own = here[k : k + SIDE]
                at = starts[own] + np.arange(WINDOW)[:, None]
                if full[own[0]]:
                    out[own] = self.forward(gates[rows[at]], None)
                else:
                    mask = (np.arange(WINDOW)[:, None] < sizes[own]).astype(np.float32)
                    g = gates[rows[np.minimum(at, len(rows) - 1)]]
                    out[own] = self.forward(g, mask)
        return out


def log_odds(features: Ragged, docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of each feature row: log of its share of toxic over its share of clean documents."""
    counts = np.zeros((2, ROWS))
    for words, label in zip(docs, labels, strict=True):
        counts[label, features.take(np.unique(words)).rows()] += 1
    n = np.bincount(labels, minlength=2)
    odds = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    odds[(counts.sum(0) < 3)] = 0
    odds[0] = 0
    return odds.astype(np.float32)


def train(rows: list[tuple[str, int]], seed: int = 11) -> Network | None:
    """Fit a network to labelled texts."""
    place: dict[str, int] = {}
    docs, marks = [], []
    for text, y in sorted(rows, key=lambda r: (r[1], r[0] or "")):
        own = np.array([place.setdefault(w, len(place)) for w in WORD.findall((text or "").lower())], np.int64)
        if len(own):
            docs.append(own)
            marks.append(y)
    labels = np.array(marks, np.int64)
    if len(set(marks)) < 2:
        return None
    features = Ragged.of(list(place))
    del place
    net, rng = Network.fresh(log_odds(features, docs, labels), seed), np.random.default_rng(seed)
    adam = Adam(net.p, 0.01)
    flat = np.concatenate(docs)
    base = np.cumsum([0, *map(len, docs)])
    spots = [base[i] + windows_of(len(d)) for i, d in enumerate(docs)]
    owner = np.repeat(np.arange(len(docs)), list(map(len, spots)))
    starts = np.concatenate(spots)
    sizes = np.minimum(WINDOW, base[owner + 1] - starts)
    first = np.cumsum([0, *map(len, spots)])
    # To begin with, a window is as bad as the sum of its words' log-odds.
    inputs = net.all_inputs(features)
    odds = np.maximum(inputs[:, 0] + inputs[:, WORD_DIM], 0)
    total = np.concatenate([[0], np.cumsum(odds[flat])])
    logits = total[starts + sizes] - total[starts]
    for _ in range(ROUNDS):
        worst = np.array([first[i] + logits[first[i] : first[i + 1]].argmax() for i in range(len(docs))])
        toxic, clean = worst[labels == 1], worst[labels == 0]
        other = np.flatnonzero(labels[owner] == 0)
        for _ in range(STEPS):
            own = np.concatenate([rng.choice(toxic, BATCH // 2), rng.choice(clean, BATCH // 4), rng.choice(other, BATCH // 4)])
            at = np.minimum(starts[own] + np.arange(WINDOW)[:, None], len(flat) - 1)
            mask = (np.arange(WINDOW)[:, None] < sizes[own]).astype(np.float32)
            unique, spot = np.unique(flat[at], return_inverse=True)
            spot = spot.reshape(at.shape)
            used = features.take(unique)
            x = net.inputs_of(used)
            side = np.concatenate([net.p["xf"], net.p["xb"]], 1)
            g = (x @ side + np.concatenate([net.p["bf"], net.p["bb"]]))[spot]
            keep: dict = {}
            logit = net.forward(g, mask, keep)
            wrong = ((sigmoid(logit) - (labels[owner[own]] == 1)) / BATCH).astype(np.float32)
            grads, dg = net.backward(keep, mask, wrong)
            by_word = np.zeros((len(unique), 6 * HIDDEN), np.float32)
            np.add.at(by_word, spot.ravel(), dg.reshape(-1, 6 * HIDDEN))
            dside, dx = x.T @ by_word, by_word @ side.T
            grads["xf"], grads["xb"] = dside[:, : 3 * HIDDEN], dside[:, 3 * HIDDEN :]
            grads["word"] = (used.whole, dx[:, :WORD_DIM])
            grads["char"] = used.gradient(dx[:, WORD_DIM:] / 8)
            adam.step(grads)
        logits = np.concatenate([_logits(net, features, docs[s : s + GROUP]) for s in range(0, len(docs), GROUP)])
    return Network(net.p)


def _logits(net: Network, features: Ragged, docs: list[np.ndarray]) -> np.ndarray:
    """Logits of all windows of some training texts."""
    unique, rows = np.unique(np.concatenate(docs), return_inverse=True)
    lengths = np.array(list(map(len, docs)))
    spots = [windows_of(n) for n in lengths]
    owner = np.repeat(np.arange(len(docs)), list(map(len, spots)))
    starts = np.concatenate(spots)
    base = np.cumsum(lengths) - lengths
    return net.score_windows(net.gates_of(net.all_inputs(features.take(unique))), rows, base[owner] + starts, np.minimum(WINDOW, lengths[owner] - starts))


def _worst(network: Network | None, column: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: its score, its number of windows, and the first word of its worst one."""
    texts = [WORD.findall((t or "").lower()) for t in column]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    best, spot = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    spots = [windows_of(n) for n in lengths]
    count = np.fromiter(map(len, spots), np.int64, len(texts))
    if network is None or not count.sum():
        return best, count, spot
    words = worker_held(__name__, network.key, lambda: WordTable(network.gates, 6 * HIDDEN))
    rows = words.look_up([w for t in texts for w in t])
    base = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(texts)), count)
    starts = np.concatenate(spots)
    logits = network.score_windows(words.rows, rows, base[owner] + starts, np.minimum(WINDOW, lengths[owner] - starts))
    some = np.flatnonzero(count)
    first = (np.cumsum(count) - count)[some]
    best[some] = sigmoid(np.maximum.reduceat(logits, first))
    spot[some] = starts[np.lexsort((starts, -logits, owner))[first]]
    return best, count, spot


def score(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, n_windows, and the first word of its worst window."""
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = _worst(held.value, batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), *map(pa.array, values)], ["id", "score", "n_windows", "worst_word"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, score double, n_windows long, worst_word long")


def keep_clean(docs: DataFrame, network: Network | None, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The documents that score below the limit, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_worst(held.value, batch.column(at).to_pylist())[0] < limit))

    return small_batches(docs).mapInArrow(tidy(run), docs.schema)


def digest(scored: DataFrame) -> DataFrame:
    held = (bucket("doc_id", HELD_OUT_MOD) == HELD_OUT).alias("held_out")
    return scored.withColumnRenamed("id", "doc_id").select("doc_id", held, "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"), "n_windows", "worst_word")
