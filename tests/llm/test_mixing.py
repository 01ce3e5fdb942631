import math
import random
from collections import Counter

import duckdb
import pytest

from ledgerferry.llm import mixing
from tests.llm.support import AWKWARD, documents, no_documents


def test_counts_equal_the_inverted_distribution(spark):
    sources = ["hot"] * 300 + ["rare"] * 5 + [None] * 45 + [""] * 50
    docs = documents(spark, ["t"] * 400, source=sources)
    rates = {r["source"]: r for r in mixing.source_rates(docs).collect()}
    n = Counter(sources)
    scale = 400 / sum(v**mixing.ALPHA for v in n.values())
    for source, count in n.items():
        assert math.isclose(rates[source]["rate"], count**mixing.ALPHA * scale / count)
    us = docs.select("doc_id", "source", mixing.uniform(mixing.hashed("count", docs["doc_id"])).alias("u")).collect()
    got = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    for r in us:
        rate, k, term = rates[r["source"]]["rate"], 0, math.exp(-rates[r["source"]]["rate"])
        total = term
        while total <= r["u"]:
            k += 1
            term *= rate / k
            total += term
        assert got[r["doc_id"]] == k


def test_sources_reach_their_weights_on_average(spark):
    docs = documents(spark, ["t"] * 6_000, source=["a"] * 5_000 + ["b"] * 1_000)
    got = Counter(r["source"] for r in mixing.mix(docs, weights={"a": 1.0, "b": 3.0}).select("source").collect())
    assert abs(got["a"] - 1_500) < 200 and abs(got["b"] - 4_500) < 300
    assert {r["source"] for r in mixing.mix(docs, weights={"b": 1.0}).select("source").collect()} == {"b"}
    assert mixing.mix(docs, weights={}).count() == 0


def test_large_means(spark):
    row = spark.range(1).select(mixing.poisson_cdf(mixing.F.lit(900.0)).alias("c")).first()
    assert math.isclose(row["c"][-1], 1.0, rel_tol=1e-9)
    assert row["c"][900] == pytest.approx(0.5088, abs=1e-3)


def test_whole_rows_repeat_and_the_order_is_shuffled_but_the_same_every_time(spark):
    texts = [*AWKWARD, *["t"] * 300]
    docs = documents(spark, texts)
    out = mixing.mix(docs)
    assert set(docs.columns) < set(out.columns)
    rows = out.collect()
    for r in rows:
        assert r["text"] == texts[r["doc_id"]] and 1 <= r["copy"] <= r["repeats"]
    keys = [r["shuffle_key"] for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert [r["doc_id"] for r in rows] != sorted(r["doc_id"] for r in rows)
    assert [tuple(r) for r in mixing.mix(docs.repartition(5)).collect()] == [tuple(r) for r in rows]


def test_repeated_and_null_ids_and_an_empty_table(spark):
    docs = documents(spark, ["a"] * 40, ids=[None] * 10 + [7] * 10 + list(range(20)), source=["s"] * 40)
    got = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert got[None] % 10 == 0 and got[7] % 11 == 0
    assert mixing.mix(no_documents(spark)).collect() == []


def test_many_sources_are_joined_instead_of_broadcast(spark, monkeypatch):
    docs = documents(spark, ["t"] * 200, source=[f"s{random.Random(i).randrange(9)}" for i in range(200)])
    few = [tuple(r) for r in mixing.mix(docs).collect()]
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert [tuple(r) for r in mixing.mix(docs).collect()] == few


def test_the_sql_says_the_same(spark, tmp_path):
    docs = documents(spark, [f"text {i}" for i in range(300)]).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    columns = mixing.mix(docs).columns
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({mixing.ORACLE}) ORDER BY shuffle_key").fetchall()
    assert [tuple(r) for r in mixing.mix(docs).collect()] == expected
