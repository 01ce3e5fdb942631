import random
import zlib

import numpy as np
import pytest

from ledgerferry.llm import toxicity
from ledgerferry.llm.wordfeatures import ROWS, Ragged, by_width, word_features
from tests.llm.support import AWKWARD, documents, no_documents

CALM = ["river", "stone", "walk", "green", "table", "window", "paper", "morning", "quiet", "garden", "reader", "letter"]
FOUL = ["scumbag", "vermin", "wretch"]


def prose(n, seed, foul=0):
    rng = random.Random(seed)
    words = [rng.choice(CALM) for _ in range(n)]
    for _ in range(foul):
        words[rng.randrange(n)] = rng.choice(FOUL) + rng.choice(["", "s", "ly"])
    return " ".join(words)


@pytest.fixture(scope="module")
def network():
    rows = [(prose(80, i), 0) for i in range(120)] + [(prose(80, 1000 + i, 3), 1) for i in range(60)]
    return toxicity.train(rows)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(np.zeros(1 << 17, np.float32), 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g, mask = rng.normal(size=(6, 3, 6 * toxicity.HIDDEN)).astype(np.float64), np.ones((6, 3))
    mask[4:, 1] = 0

    def loss():
        return float(net.forward(g, mask).sum())

    keep = {}
    net.forward(g, mask, keep)
    grads, dg = net.backward(keep, mask, np.ones(3))
    for name in ("hf", "hb", "att", "v", "out", "bias"):
        flat, at = net.p[name].reshape(-1), rng.integers(net.p[name].size)
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        down = loss()
        flat[at] = old
        assert abs((up - down) / 2e-3 - grads[name].reshape(-1)[at]) < 1e-3, name
    old = g[2, 0, 5]
    g[2, 0, 5] = old + 1e-3
    up = loss()
    g[2, 0, 5] = old - 1e-3
    assert abs((up - loss()) / 2e-3 - dg[2, 0, 5]) < 1e-3


def test_windows_overlap_and_cover_the_text():
    for n in (0, 1, 31, 32, 33, 48, 100, 1_000):
        starts = toxicity.windows_of(n)
        seen = {w for s in starts for w in range(s, min(s + toxicity.WINDOW, n))}
        assert seen == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_toxic_texts_are_told_wherever_the_words_stand(spark, network):
    texts = [prose(60, 7), prose(60, 8, 3), prose(4_000, 9), prose(4_000, 10) + " " + " ".join(FOUL), *AWKWARD]
    rows = {r["doc_id"]: r for r in toxicity.digest(toxicity.score(documents(spark, texts), network)).collect()}
    assert [rows[i]["predicted"] for i in range(4)] == [0, 1, 0, 1]
    assert rows[3]["worst_word"] >= 4_000 - toxicity.WINDOW
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[4]["score"] == rows[5]["score"] == 0
    assert rows[8]["score"] == rows[9]["score"]
    kept = toxicity.keep_clean(documents(spark, texts), network)
    assert kept.columns == documents(spark, texts).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["score"] < toxicity.LIMIT}


def test_a_text_scores_alike_alone_and_among_others(spark, network):
    texts = [prose(40 + i, i, i % 2) for i in range(50)]
    one = {r["id"]: r["score"] for r in toxicity.score(documents(spark, texts).repartition(7), network).collect()}
    other = {r["id"]: r["score"] for r in toxicity.score(documents(spark, texts).coalesce(1), network).collect()}
    assert np.allclose([one[i] for i in range(50)], [other[i] for i in range(50)], atol=1e-5)


def test_held_out_and_null_labels_are_not_learned_from(spark):
    ids = list(range(60))
    labels = spark.createDataFrame([(i, 0, i % 2 if i < 50 else None) for i in ids], "doc_id long, quality int, toxic int")
    got = toxicity.training_rows(documents(spark, [f"t{i}" for i in ids]), labels).collect()
    expected = {(f"t{i}", i % 2) for i in ids[:50] if zlib.crc32(str(i).encode()) % 5}
    assert {tuple(r) for r in got} == expected


def test_nothing_to_learn_and_empty_tables(spark, network):
    assert toxicity.train([]) is None and toxicity.train([("a", 1), ("b", 1)]) is None
    assert {r["score"] for r in toxicity.score(documents(spark, AWKWARD), None).collect()} == {0.0}
    assert toxicity.score(no_documents(spark), network).collect() == []


def test_features_do_not_depend_on_the_company_of_a_word():
    words = ["a", "ab", "straße", "x" * 40, "niño"]
    alone = {w: sorted(set(word_features([w])[0].tolist()) - {0}) for w in words}
    for group in by_width(words):
        for w, row in zip(group, word_features(group), strict=True):
            assert sorted(set(row.tolist()) - {0}) == alone[w]
    ragged, table = Ragged.of(words), np.random.default_rng(1).normal(size=(ROWS, 3))
    table[0] = 0
    for i, w in enumerate(words):  # a long word trains on all its features, too
        row = word_features([w])[0]
        assert ragged.whole[i] == row[0] and np.allclose(ragged.sums(table)[i], table[row[1:]].sum(0))
        one = ragged.take(np.array([i]))
        assert np.allclose(one.sums(table), ragged.sums(table)[i]) and set(one.rows()) == set(row) - {0}
    rows, g = ragged.take(np.array([3, 0])).gradient(np.ones((2, 2)))
    assert g.sum() == 2 * ragged.counts[[3, 0]].sum() and (ragged.counts > 48).any()
