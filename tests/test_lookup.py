from ledgerferry.operators.latest import latest
from ledgerferry.operators.lookup import chain_levels, lookup, require
from ledgerferry.sources import ledger as ledger_store


def ledger(spark, *rows):
    return spark.createDataFrame(
        rows, "pk string, sk string, result string, v2_value string, seq long, batch_id long"
    )


def test_lookup_takes_the_latest_success(spark):
    rows = ledger(
        spark,
        ("organization", "success#1", "success", "old", 9, 0),
        ("organization", "success#1", "success", "new", 1, 1),
        ("organization", "failed#2", "failed", None, 1, 1),
        ("user", "success#2", "success", "other", 1, 1),
    )
    records = spark.createDataFrame([("1",), ("2",), ("",), (None,)], "org string")
    found = require(
        lookup(records, rows, org_v2=("organization", "org")), "organization", "org", "org_v2"
    )
    got = {r["org"]: (r["org_v2"], r["failure"]) for r in found.collect()}
    assert got == {
        "1": ("new", None),
        "2": (None, "v2_not_found:organization:2"),
        "": (None, "v2_not_found:organization:"),
        None: (None, "v2_not_found:organization:"),
    }


def test_latest_is_one_row_per_key(spark):
    rows = ledger(spark, *[("a", "success#1", "success", str(i), i, i % 3) for i in range(30)])
    assert [(r["v2_value"], r["batch_id"]) for r in latest(rows).collect()] == [("29", 2)]


def test_levels_of_long_chains_and_cycles(spark):
    chain = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(40)]
    cycle = [("c1", "c2"), ("c2", "c1"), ("below", "c1"), ("self", "self")]
    stray = [("lost", "nobody")]
    nodes = spark.createDataFrame(chain + cycle + stray, "id string, lead string")
    got = {r["id"]: r["level"] for r in chain_levels(nodes, "id", "lead").collect()}
    assert all(got[f"n{i}"] == i for i in range(40))
    assert [got[x] for x in ("c1", "c2", "below", "self", "lost")] == [None, None, None, None, 0]


def test_the_ledger_is_not_shuffled_before_it_is_shrunk(spark, monkeypatch):
    """Broadcasts by size are off: the keys asked for go to the ledger, as literals if they are few."""
    rows = ledger(spark, *[("organization", f"success#{i}", "success", f"v{i}", 0, 0) for i in range(500)])
    records = spark.createDataFrame([("1",), (None,), (None,)], "org string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        point = lookup(records, rows, org_v2=("organization", "org"))
        assert "success#1" in point._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.setattr(ledger_store, "POINT_KEYS", 0)
        found = lookup(records, rows, org_v2=("organization", "org"))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    semi = plan[plan.index("LeftSemi") :]
    ledger_side = semi[: semi.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in ledger_side
    for way in (point, found):
        assert sorted((r["org"] or "", r["org_v2"]) for r in way.collect()) == [("", None), ("", None), ("1", "v1")]


def test_rows_of_other_entities_are_not_read(spark):
    """A key that two entities share gives the wanted one's id, and the scan leaves the other out."""
    rows = spark.createDataFrame(
        [("user", "success#1", "success", "u", 1, 0), ("deal_note", "success#1", "success", "n", 2, 0)],
        "pk string, sk string, result string, v2_value string, seq long, batch_id long",
    )
    found = lookup(spark.createDataFrame([("1",)], "key string"), rows, id=("user", "key"))
    assert [r["id"] for r in found.collect()] == ["u"]
    assert "pk IN (user)" in found._jdf.queryExecution().optimizedPlan().toString() or "= user)" in found._jdf.queryExecution().optimizedPlan().toString()
