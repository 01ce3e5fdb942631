import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerferry.llm import collocations as C
from tests.llm.support import AWKWARD, documents, no_documents


def brute(rows, least, top):
    """Counts every phrase, every cut and every longer phrase by itself."""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            words[lang] += len(w)
            for n in (1, 2, 3, 4):
                for i in range(len(w) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in cands.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    if 100 * a >= 80 * f[p[i : i + n]]:
                        covered.add(p[i : i + n])
        scored = []
        for p, a in cands.items():
            if p not in covered:
                s, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def made(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "ß", "x'y", "W3"]
    fixed = ["the Licence is granted free of charge to any person", "a a a a a a", "ring one two three ring one two three ring one two three", "one, two; three one two"]
    rows = []
    for i in range(n):
        parts = [rng.choice([*fixed, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12)))]) for _ in range(rng.randint(1, 5))]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([". ", " ", "\n", "\t", "!? "]).join(parts)))
    return rows


def mined(spark, rows, **kw):
    docs = documents(spark, [t for _, t in rows], lang=[x for x, _ in rows])
    return sorted(tuple(r) for r in C.collocations(docs, **kw).collect())


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 5, 2_000), (2, 30, 2_000), (3, 3, 25)])
def test_equals_brute_force(spark, seed, least, top):
    rows = made(seed)
    assert mined(spark, rows, least=least, top=top) == brute(rows, least, top)


def test_small_pieces_sketch_and_paths(spark, monkeypatch):
    """Many flushes, a sketch in which words collide, and paths in several rows give the same."""
    rows = made(4) + [("en", " ".join(f"p{i}" for i in range(90)))] * 7
    expected = brute(rows, 5, 2_000)
    for name, value in (("PART", 8), ("SHARD_WORDS", 1)):
        monkeypatch.setattr(C, name, value)
    assert mined(spark, rows, least=5) == expected


def test_sql_says_the_same(spark):
    rows = made(5, 900)
    docs = documents(spark, [t for _, t in rows], lang=[x for x, _ in rows])
    found = sorted(tuple(r) for r in C.collocations(docs).collect())
    con = duckdb.connect()
    con.register("documents", docs.select("text", "lang").toArrow())
    assert found == sorted(con.execute(C.ORACLE).fetchall()) and len(found) > 20


def test_awkward_rows_and_empty_tables(spark):
    rows = [("en", t) for t in AWKWARD] * 4
    assert mined(spark, rows, least=4) == brute(rows, 4, 2_000)
    assert C.collocations(no_documents(spark)).collect() == []
    assert mined(spark, [("en", "nothing is here often")]) == []


def test_shorter_counts_follow_from_flow(spark, monkeypatch):
    """Only runs of four words, and shorter ones at the ends of pieces, are counted; the rest is derived."""
    rows = made(6)
    texts = documents(spark, [t for _, t in rows], lang=[x for x, _ in rows])
    batch = C._texts(texts, "text", "lang").toArrow().combine_chunks().to_batches()[0]
    counter = C._Counter(np.full(C.SKETCH // 8, 255, np.uint8), np.full(1 << (C.MAP_BITS - 3), 255, np.uint8))
    counter.add(batch, {})
    runs = [r for b in counter.flush(3) for x in b.column(1).to_pylist() for r in pa.ipc.open_stream(x).read_all().to_pylist()]
    assert {(len(r["node"].split(" ")), r["next"] is not None) for r in runs} == {(1, False), (2, False), (3, False), (3, True)}
    monkeypatch.setattr(C, "FLUSH", 200)
    counts = {(r["lang"], r["phrase"]): r["f"] for r in C.phrase_counts(C._texts(texts, "text", "lang"), 5).where("n > 0").collect()}
    every = {}
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            for n in (1, 2, 3, 4):
                for i in range(len(w) - n + 1):
                    key = ("und" if lang is None else lang, " ".join(w[i : i + n]))
                    every[key] = every.get(key, 0) + 1
    assert counts == {k: v for k, v in every.items() if v >= 5}


def test_paths_join_edges_without_branches(spark):
    rows = [("en", "the licence is granted free of charge to any person")] * 6 + [("en", "q r q r q r q r q r")] * 3
    counts = C.phrase_counts(C._texts(documents(spark, [t for _, t in rows]), "text", "lang"), 3)
    paths = [r["words"] for r in C.compact(counts).collect()]
    assert "the licence is granted free of charge to any person".split() in paths
    assert sorted(w for w in paths if "q" in w) == [["q", "r", "q", "r"], ["r", "q", "r", "q"]]  # a ring stays single


def test_products_may_pass_64_bits(spark):
    """Flow of a size that no test table has goes through the same expressions."""
    big = 9_000_000_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "", 0, big), ("en", "a", 1, big), ("en", "b", 1, big - 7), ("en", "a b", 2, big - 9)], "lang string, phrase string, n int, f long"
    )
    row = C.ranked(C.candidates(C.compact(counts), counts), counts, 10).collect()
    assert [tuple(r) for r in row] == [("en", 1, "a b", big - 9, big, big - 7, big, 2_000_000 * (big - 9) // (2 * big - 7))]
