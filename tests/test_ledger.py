import pytest

from ledgerferry.operators.lookup import lookup
from ledgerferry.schemas import LEDGER
from ledgerferry.sources import ledger as L
from ledgerferry.sources.ledger import LedgerStore, Run


def rows(spark, keys, batch, entity="organization", value="v"):
    made = [
        (entity, f"success#{k}", str(k), "success", "p" * 40, f"{value}{batch}-{k}", None, None, batch * 1000 + i, batch)
        for i, k in enumerate(keys)
    ]
    return spark.createDataFrame(made, LEDGER)


def many(spark, n, batch=0, entity="organization"):
    return spark.range(n).selectExpr(
        f"'{entity}' AS pk", "concat('success#', id) AS sk", "CAST(id AS STRING) AS v1_value", "'success' AS result", "repeat('p', 20) AS payload",
        f"concat('v{batch}-', id) AS v2_value", "CAST(NULL AS STRING) AS errorMsg", "CAST(NULL AS STRING) AS response", "id AS seq", f"CAST({batch} AS BIGINT) AS batch_id",
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_exchange_above(plan, scan):
    """No exchange between the scans of a table and the join above them."""
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i, line in enumerate(lines):
        if scan in line:
            at, level = i, depth[i]
            while "Join" not in lines[at]:
                at = max(k for k in range(at) if depth[k] < level)
                level = depth[at]
                if "Exchange" in lines[at]:
                    return False
    return True


@pytest.fixture
def no_size_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_keys_join_the_buckets_where_they_lie(spark, tmp_path, no_size_broadcast):
    store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=4)
    store.commit(0, many(spark, 301_000).unionByName(many(spark, 50, entity="user")))
    store.compact()
    store.commit(1, many(spark, 10, batch=1))
    records = spark.range(300_500).selectExpr("CAST(id AS STRING) AS org", "CAST(id % 60 AS STRING) AS lead")
    found = lookup(records, store.view(), org_v2=("organization", "org"), lead_v2=("user", "lead"))
    plan = plan_of(found)
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert no_exchange_above(plan, "Bucketed: true")
    values = {r["org"]: (r["org_v2"], r["lead_v2"]) for r in found.filter("org IN ('5', '300499', '55')").collect()}
    assert values == {"5": ("v1-5", "v0-5"), "300499": ("v0-300499", "v0-19"), "55": ("v0-55", None)}
    assert found.filter("org_v2 IS NULL").count() == 0


def test_a_session_that_did_not_write_a_run_reads_its_buckets(spark, tmp_path, no_size_broadcast):
    store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=4)
    store.commit(0, many(spark, 1_000))
    store.compact()
    (run,) = store.runs()
    spark.sql(f"DROP TABLE {store._name(run)}")  # what a new session's catalog looks like
    again = LedgerStore(spark, str(tmp_path / "ledger"))
    view = again.view()
    joined = view.tables[0].join(spark.range(900).selectExpr("concat('success#', id) AS sk"), "sk", "left_semi")
    assert "Bucketed: true" in plan_of(joined) and no_exchange_above(plan_of(joined), "Bucketed: true")
    assert joined.count() == 900 and again.current().count() == 1_000


def scanned_rows(df):
    """Rows that the scans of a collected frame handed on, by the scan's own metric."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if hasattr(node, "executedPlan") and node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage")):
            todo.append(node.plan())
    return total


def test_few_keys_skip_row_groups_and_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "ROW_GROUP", 1 << 16)
    monkeypatch.setattr(L, "BLOOM_KEYS", 2_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=4)
        # Interleaved keys: every row group spans nearly all keys, so only the Bloom filters tell them apart.
        scattered = many(spark, 60_000).selectExpr("pk", "concat('success#', CAST(reverse(CAST(seq AS STRING)) AS STRING)) AS sk", *LEDGER.names[2:])
        store.commit(0, scattered)
        store.commit(1, rows(spark, range(100_000, 100_050), 1))
        store.merge(fanout=2)
        store.commit(2, many(spark, 40_000, batch=2).withColumn("pk", L.F.lit("user")))
        asked = spark.createDataFrame([("organization", "success#100007"), ("user", "success#31999"), ("user", "success#nobody")], "pk string, sk string")
        found = store.view().successes(asked, 3, "v2_value")
        assert sorted(tuple(r)[:3] for r in found.collect()) == [
            ("organization", "success#100007", "v1-100007"), ("user", "success#31999", "v2-31999"),
        ]
        assert scanned_rows(found) < 100_050 / 8  # one bucket of four, and in it few row groups
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ways_of_looking_up_agree(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=3)
    for batch in range(5):
        store.commit(batch, rows(spark, range(batch * 5, batch * 5 + 12), batch).unionByName(rows(spark, range(4), batch, "user")))
        store.merge(fanout=2)
    assert {r.level for r in store.runs()} > {0}
    records = spark.createDataFrame([(str(i) if i % 7 else None, str(i % 5)) for i in range(40)] + [("", "x'y")], "org string, lead string")
    wanted = {"a": ("organization", "org"), "b": ("user", "lead")}
    answers = []
    for point, few in ((200, 200), (0, 200), (0, 0)):
        monkeypatch.setattr(L, "POINT_KEYS", point)
        monkeypatch.setattr(L, "MAX_BROADCAST_KEYS", few)
        answers.append(sorted(map(repr, lookup(records, store.view(), **wanted).collect())))
        answers.append(sorted(map(repr, lookup(records, store.rows(), **wanted).collect())))
    assert all(a == answers[0] for a in answers) and "v4-2" in "".join(answers[0])


def test_runs_are_merged_level_by_level(spark, tmp_path):
    """27 batches, three runs at a time: each row is written again at most once for each level."""
    store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=2)
    written, expected = 0, {}
    for batch in range(27):
        keys = range(batch, batch + 4)
        store.commit(batch, rows(spark, keys, batch))
        expected |= {f"success#{k}": f"v{batch}-{k}" for k in keys}
        for run in store.merge(fanout=3):
            written += store.spark.read.parquet(store._data(run)).count()
        runs = store.runs()
        assert all(sum(r.level == level for r in runs) < 3 for level in range(4))
        assert [r.first for r in runs[1:]] == [r.last + 1 for r in runs[:-1]] and runs[0].first == 0 and runs[-1].last == batch
    assert [r.level for r in store.runs()] == [3] and written <= 27 * 4 * 3
    assert {r["sk"]: r["v2_value"] for r in store.current().collect()} == expected


def test_half_made_merges_and_cleaning(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"), buckets=2)
    for batch in range(4):
        store.commit(batch, rows(spark, [batch], batch))
    before = store.current().collect()
    # A merge that died after its data and before its marker is not seen, and can be made again.
    lost = Run(0, 3, 1, 2)
    rows(spark, [99], 9).write.parquet(store._data(lost))
    assert sorted(store.current().collect()) == sorted(before)
    (made,) = store.merge(fanout=4)
    assert made == lost and sorted(store.current().collect()) == sorted(before)
    store.clean(keep=1)
    assert sorted(store.current().collect()) == sorted(before)
    kept = sorted(p.name for p in (tmp_path / "ledger" / "data").iterdir())
    assert kept == sorted([f"version={Run(3, 3).name}", f"version={lost.name}"])
    assert all(store.is_committed(b) for b in range(4)) and not store.is_committed(4)
    assert [r.first for r in store.runs(before=3)] == [0, 1, 2]  # the merged run holds a later batch


def test_names_of_runs():
    for run in (Run(5, 5), Run(0, 12, 2, 64)):
        assert Run.parse(run.name) == run
    assert Run(0, 3, 1, 8).covers(Run(3, 3)) and not Run(0, 3, 1, 8).covers(Run(0, 3, 1, 4)) and not Run(0, 3, 1, 8).covers(Run(4, 4))
