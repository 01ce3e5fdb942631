import itertools
import random
import zlib

import numpy as np
import pytest

from ledgerferry.llm import langid
from tests.llm.support import AWKWARD, documents, no_documents

WORDS = {
    "aa": ["the", "thing", "water", "reading", "stone", "other", "weather", "thought"],
    "bb": ["der", "straße", "wasser", "lesung", "schön", "andere", "gedacht", "zeit"],
    "cc": ["agua", "piedra", "corazón", "leyendo", "otros", "pensado", "tiempo", "niño"],
}


def prose(lang, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    return langid.train([(prose(lang, 60, f"{lang}{i}"), lang) for lang in WORDS for i in range(40)])


def chain(e, a):
    """Marginals of a short chain by enumeration of all labellings."""
    n, k = e.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = sum(e[i, y] for i, y in enumerate(path)) + sum(a[x, y] for x, y in zip(path, path[1:]))
        weight += np.log(np.exp(a[:, path[0]]).sum())  # any label before the first
        for i, y in enumerate(path):
            out[i, y] += np.exp(weight)
    return out / out.sum(1, keepdims=True)


def test_marginals_equal_enumeration_whatever_the_segments(monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(3, 3))
    lengths = np.array([5, 0, 1, 7, 2])
    e = rng.normal(size=(15, 3)) * 2
    expected = np.concatenate([chain(e[s : s + n], a) for s, n in ((0, 5), (5, 1), (6, 7), (13, 2))])
    for segment in (1, 2, 3, 64):
        monkeypatch.setattr(langid, "SEGMENT", segment)
        assert np.allclose(langid.marginals(e, lengths, a), expected)


def test_whole_texts_and_switches(spark, model):
    texts = [prose("aa", 50, 1), prose("bb", 3_000, 2), prose("cc", 1, 3) + " tiempo agua", *AWKWARD]
    rows = {r["id"]: r for r in langid.predict(documents(spark, texts), model).collect()}
    assert [rows[i]["lang_pred"] for i in range(3)] == ["aa", "bb", "cc"]
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text or ""):
            assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
        else:
            assert rows[i]["lang_pred"] in model.labels and 0 <= rows[i]["score"] <= 1
    mixed = prose("aa", 20, 5) + " " + prose("cc", 20, 6)
    row = langid.label_words(documents(spark, [mixed]), model).first()
    assert row["labels"] == ["aa"] * 20 + ["cc"] * 20


def test_held_out_rows_are_not_learned_from(spark):
    texts = [prose("aa", 20, i) for i in range(80)]
    docs = documents(spark, texts, lang=["aa" if zlib.crc32(str(i).encode()) % 4 != 2 else "leak" for i in range(80)])
    assert {r["lang"] for r in langid.training_rows(docs).collect()} == {"aa"}
    digest = langid.digest(langid.predict(docs, None)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in digest)


def test_the_sample_is_bounded_for_each_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_DOCS", 10)
    docs = documents(spark, ["a"] * 600, lang=["aa"] * 580 + ["bb"] * 20)
    counts = {}
    for r in langid.training_rows(docs).collect():
        counts[r["lang"]] = counts.get(r["lang"], 0) + 1
    assert counts["aa"] <= 10 and 5 <= counts["bb"] <= 10


def test_nothing_to_learn_and_an_empty_table(spark, model):
    assert langid.train([]) is None and langid.train([(None, "aa"), ("1 2", "bb")]) is None
    assert {r["lang_pred"] for r in langid.predict(documents(spark, AWKWARD), None).collect()} == {"und"}
    assert langid.predict(no_documents(spark), model).collect() == []
    assert langid.training_rows(no_documents(spark)).collect() == []
