import random

import numpy as np
import pytest

from ledgerferry.llm import jaccard
from tests.llm.support import AWKWARD, documents, no_documents


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def expected(ids, texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if ids[i] is None or ids[j] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return sorted((ids[i] is not None, ids[i] or 0, len(sets[i]), None if ids[i] is None else min(x for x in groups[find(i)] if x is not None)) for i in range(len(ids)))


def corpus(seed, n):
    """Near copies of several degrees, exact copies, shared passages, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(20)] for _ in range(3)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            w = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = w[rng.randrange(4) :]
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 30, 80, 120]))]
            if kind > 0.7:
                w = w + rng.choice(passages)
        text = (" " if rng.random() < 0.8 else "\t\n").join(w)
        texts.append(text.upper() if rng.random() < 0.1 else text)
    return texts


def got(df):
    rows = jaccard.digest(jaccard.join(df)).collect()
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows)


@pytest.mark.parametrize(("seed", "paired", "block"), [(1, 64, 2_000_000), (2, 2, 2_000_000), (3, 64, 60), (4, 2, 60)])
def test_components_equal_brute_force(spark, monkeypatch, seed, paired, block):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    texts = [*AWKWARD, *corpus(seed, 160)]
    ids = [1_000 - i for i in range(len(texts))]
    ids[-1] = ids[-2] = None
    assert got(documents(spark, texts, ids)) == expected(ids, texts)


def test_repeated_rows_a_join_by_key_and_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_MEMBERS", 0)
    texts = ["a b c d e f g h i j k l"] * 3 + ["a b c d e f g h i j k l m"] * 2 + ["other words stand here alone"]
    ids = [5, 5, 4, 9, 9, 7]
    assert got(documents(spark, texts, ids)) == expected(ids, texts)
    assert got(no_documents(spark)) == []


def test_texts_that_share_an_id_keep_their_own_components(spark):
    texts = corpus(11, 120)
    ids = [i % 40 for i in range(120)]
    assert got(documents(spark, texts, ids)) == expected(ids, texts)


def test_frequent_shingles_go_last_but_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "REPORT", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    texts = corpus(9, 120)
    assert got(documents(spark, texts)) == expected(list(range(120)), texts)


def test_words_follow_bytes_and_lower_only_ascii():
    for text in ("", "  a b\tC\x0bd  e f\n", "Ä ä A a", "a\xa0b c d e f", "x" * 3_000_000 + " y z", "ab " * 500_000):
        w, h = words(text), jaccard.word_hashes(text.encode())
        assert len(w) == len(h)
        seen = {}
        for a, b in zip(w, h.tolist(), strict=True):
            assert seen.setdefault(a, b) == b
        assert len(set(seen.values())) == len(seen)
    assert len(jaccard.shingles("Ä b c d e")) == 1
    assert (jaccard.shingles("A B C D E") == jaccard.shingles("a  b\nc d e")).all()
    assert (jaccard.shingles("Ä b c d e") != jaccard.shingles("ä b c d e")).all()


def test_bitmaps_never_overstate_the_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**63, rng.integers(0, 200)).astype(np.uint64)]))
        if len(b):
            assert jaccard.apart(jaccard.bitmap(a), jaccard.bitmap(b)) <= len(np.setxor1d(a, b))


def test_heap_merge_counts_and_skips():
    rng = random.Random(6)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        for need in (1, 2, 3, 5):
            counts = {x: sum(x in own for own in lists) for x in range(40)}
            assert dict(jaccard.heap_merge(lists, need)) == {x: c for x, c in counts.items() if c >= need}


@pytest.mark.parametrize("sides", [False, True])
def test_search_joins_what_links(sides):
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 10**6, 60)) for _ in range(4)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) < 0.93], rng.integers(0, 10**6, 3)])).astype(np.uint64) for b in base for _ in range(12)]
    side = [i % 2 for i in range(len(sets))] if sides else None

    def classes(pairs):
        root = list(range(len(sets)))
        for _ in sets:
            for i, j in pairs:
                root[i] = root[j] = min(root[i], root[j])
        return root

    true = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if (side is None or side[i] != side[j]) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    found = jaccard.search(sets, side)
    assert classes(found) == classes(true) and len(found) < len(sets)
