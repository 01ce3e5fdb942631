import json
import os

import pytest

from ledgerferry import LedgerStore, preview, run_batch, start_migration
from ledgerferry.config import MigrationConfig
from ledgerferry.operators.deliver import TokenUnavailable, deliver, send_with_retry
from ledgerferry.plans.entities import SPECS, build_requests
from ledgerferry.operators.decode import decode
from ledgerferry.sources.changes import stream_json
from tests.support import envelopes, image, make_transport, records

BATCH = [
    {"pk": "organization", "sk": "101", "organization_is_active": "yes", "teamCode": "t-9", "n": 5},
    {"pk": "organization", "sk": "102"},
    {"pk": "user_group", "sk": "7", "organization_id": "101", "group_name": "N", "user_ids": "[1, 2]"},
    {"pk": "user_group", "sk": "8", "organization_id": "999"},
    {"pk": "user_group", "sk": "9", "organization_id": 101, "user_ids": None},
    {"pk": "account", "sk": "1", "organization_id": "101", "user_group_id": "7", "commission": 3.9},
    {"pk": "account", "sk": "2", "organization_id": "101", "commission": "3.5"},
    {"pk": "account", "sk": "3", "organization_id": "101", "user_group_id": "77"},
    {"pk": "account", "sk": "4", "organization_id": "102"},
    {"pk": "user", "sk": "1", "organization_id": "101", "date_of_birth": "1990-01-01", "agent_title": True},
    {"pk": "user", "sk": "2", "organization_id": "101", "team_lead_user_id": "1"},
    {"pk": "user", "sk": "3", "organization_id": "101", "team_lead_user_id": "2"},
    {"pk": "user", "sk": "4", "organization_id": "101", "team_lead_user_id": "5"},
    {"pk": "user", "sk": "5", "organization_id": "101", "team_lead_user_id": "4"},
    {"pk": "user", "sk": "6", "organization_id": "101", "team_lead_user_id": 6},
    {"pk": "lender", "sk": "5", "lender_buydown_ratio": 2.7, "lender_address": [{"a": 1.5}],
     "lender_business_development_manager": [{"name": "q"}, {"name": "bad"}]},
    {"pk": "lender", "sk": "6", "lender_buydown_ratio": 1, "lender_address": []},
    {"pk": "lender", "sk": "102", "lender_buydown_ratio": 1, "lender_address": [{}]},
    {"pk": "contact", "sk": "1", "email_id": "a@x", "last_name": "L1",
     "role_based_attributes": [{"role": "realtor"}]},
    {"pk": "contact", "sk": "2", "email_id": "a@x", "first_name": "F2",
     "role_based_attributes": [{"role": "Client"}]},
    {"pk": "contact", "sk": "3", "email_id": "a@x", "first_name": "F3"},
    {"pk": "contact", "sk": "4", "first_name": "F4"},
    {"pk": "deal", "sk": "1", "x": {"y": 1}},
    {"pk": "deal", "sk": "2", "fees": [{"fee_id": "1", "amount": 2}],
     "documents": [{"deal_id": "2", "loan_document_map": {"a": 1},
                    "docs": [{"document_name": "d", "document_path": "p/q"}]}, {"docs": []}]},
    {"pk": "deal_note", "sk": "nid", "t": "n"},
    {"pk": "deal_task", "sk": "1"},
    {"pk": "contact_note", "sk": "1"},
    {"pk": "contact_task", "sk": "1"},
    {"pk": "zzz", "sk": "1"},
]


@pytest.fixture(scope="module")
def migrated(spark, tmp_path_factory):
    store = LedgerStore(spark, str(tmp_path_factory.mktemp("ledger")))
    deep = {"k": {"k": {"k": {"k": {"k": {"k": "end"}}}}}}
    images = [image(**r) for r in [*BATCH, {"pk": "deal_note", "sk": "deep", "v": deep}]]
    batch = envelopes(spark, [*images, '{"broken":', None])
    transport = make_transport(failing={"102"}, flaky={"101"}, no_id={"nid"}, unreadable={"1#fees"})
    config = MigrationConfig(renames={"teamCode": "team_id"})
    result = run_batch(batch, 0, store, transport, config)
    rows = {(r["pk"], r["sk"]): r for r in store.current().collect()}
    log = {(r["step"], r["base_key"]): r for r in result.log.collect()}
    return store, result, rows, log, batch, transport


def body(row):
    return json.loads(json.loads(row["payload"])["api_request"])


def test_organizations(migrated):
    _, _, rows, log, *_ = migrated
    row = rows["organization", "success#101"]
    assert body(row) == {"organization_is_active": True, "n": 5.0, "team_id": "t-9"}
    assert (row["v2_value"], row["v1_value"]) == ("v2-101", "101")
    assert rows["organization", "failed#102"]["errorMsg"] == "HTTP 500"


def test_lookups(migrated):
    _, _, rows, _, *_ = migrated
    assert body(rows["user_group", "success#7"]) == {
        "organization_id": "v2-101", "group_name": "N", "user_ids": ["1", "2"],
    }
    assert body(rows["user_group", "success#9"])["user_ids"] == []
    failed = rows["user_group", "failed#8"]
    assert failed["errorMsg"] == "v2_not_found:organization:999"
    assert json.loads(failed["payload"]) == {"pk": "user_group", "sk": "8", "organization_id": "999"}
    account = body(rows["account", "success#1"])
    assert (account["commission"], account["user_group_id"]) == (3, "v2-7")
    other = body(rows["account", "success#3"])
    assert (other["commission"], other["user_group_id"], other["is_archived"]) == (0, None, False)
    assert rows["account", "failed#4"]["errorMsg"] == "v2_not_found:organization:102"


def test_team_leads_of_the_same_batch(migrated):
    _, _, rows, _, *_ = migrated
    data = {k: json.loads(r["payload"]).get("data") for (p, k), r in rows.items() if p == "user"}
    assert data["success#1"] == {
        "organization_id": "v2-101", "date_of_birth": 631152000, "agent_title": "True",
    }
    assert data["success#2"]["team_lead_user_id"] == "v2-1"
    assert data["success#3"]["team_lead_user_id"] == "v2-2"
    assert data["success#6"]["team_lead_user_id"] == 6.0
    assert rows["user", "failed#4"]["errorMsg"] == "v2_not_found:user:5"
    assert rows["user", "failed#5"]["errorMsg"] == "v2_not_found:user:4"


def test_lender_and_managers(migrated):
    _, _, rows, _, *_ = migrated
    info = json.loads(rows["lender", "success#5"]["payload"])["data"]
    assert info["lender_basic_info"]["is_lender_type"] is True
    assert info["lender_basic_info"]["lender_buydown_ratio"] == 2
    assert info["lender_address"] == {"a": 1.5}
    manager = rows["lender", "success#5#bdm#0"]
    assert manager["v1_value"] == "5"
    assert body(manager)["record_create_list"][0]["lender_id"] == "L-5"
    assert json.loads(rows["lender", "failed#5#bdm#1"]["response"]) == {"statusCode": 500}
    assert rows["lender", "failed#102#bdm"]["errorMsg"] == "parent_failed:lender:102"


def test_deal_children(migrated):
    _, _, rows, log, *_ = migrated
    assert json.loads(rows["deal", "success#1"]["payload"]) == {"x": {"y": 1.0}}
    assert json.loads(rows["deal", "success#2#document#docs#0#0"]["payload"]) == {
        "name": "d", "type": None, "size": 1024, "storage_path": "s3://documents/p/q",
    }
    assert ("deal", "success#2#document#1") in rows
    assert body(rows["deal", "success#2#fees#0"])["record_create_list"] == [
        {"fee_id": "1", "amount": 2.0, "description": None}
    ]


def test_absent_lists_are_still_sent(migrated):
    _, result, *_ = migrated
    reasons = {(r["base_key"], r["reason"]) for r in result.unresolved().collect()}
    assert reasons == {("nid", "no_id"), ("1#fees", "Invalid response format")}


def test_contact_merge(migrated):
    _, _, rows, log, *_ = migrated
    contact = json.loads(rows["contact", "success#a@x"]["payload"])
    assert (contact["first_name"], contact["last_name"]) == ("F2", "L1")
    assert [r["role"] for r in contact["role_based_attributes"]] == ["Client", "realtor"]


def test_nothing_is_lost(migrated):
    _, result, *_ = migrated
    reasons = sorted((r["pk"] or "", r["reject_reason"]) for r in result.quarantine().collect())
    assert reasons == [
        ("", "undecodable"),
        ("account", "bad_integer"),
        ("contact", "missing_key"),
        ("contact", "no_roles"),
        ("lender", "no_address"),
    ]
    assert [r["pk"] for r in result.unrouted().collect()] == ["zzz"]


def test_deep_records_migrate(migrated):
    _, _, rows, *_ = migrated
    assert "end" in rows["deal_note", "success#deep"]["payload"]


def test_replay_changes_nothing_and_compaction_keeps_the_state(migrated):
    store, _, rows, _, batch, transport = migrated

    def refuse():
        raise AssertionError("a finished step must not be sent again")

    run_batch(batch, 0, store, refuse)
    again = {(r["pk"], r["sk"]): r for r in store.current().collect()}
    assert again == rows
    store.compact()
    assert {(r["pk"], r["sk"]): r for r in store.current().collect()} == rows
    assert store.is_committed(0)


def test_contact_state_moves_on_success_only(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    contact = {"pk": "contact", "sk": "1", "email_id": "m"}

    def role(name):
        return [{"role": name}]

    first = records(spark, {**contact, "first_name": "A", "role_based_attributes": role("realtor")})
    run_batch(first, 0, store, make_transport())
    lost = records(spark, {**contact, "last_name": "X", "role_based_attributes": role("client")}, first_seq=5)
    run_batch(lost, 1, store, make_transport(failing={"m"}))
    last = records(spark, {**contact, "gender": "f", "role_based_attributes": role("solicitor")}, first_seq=9)
    run_batch(last, 2, store, make_transport())
    rows = {r["sk"]: json.loads(r["payload"]) for r in store.current().collect()}
    assert rows.keys() == {"success#m", "failed#m"}
    state = rows["success#m"]
    assert (state["first_name"], state["gender"], state["last_name"]) == ("A", "f", None)
    assert [r["role"] for r in state["role_based_attributes"]] == ["solicitor", "realtor"]


def test_retries():
    calls = []

    def unauthorized(request, attempt):
        calls.append(attempt)
        return 401, ""

    assert send_with_retry(unauthorized, {}, 2) == (401, "", 2, None)
    assert calls == [0, 1]
    assert send_with_retry(unauthorized, {}, 0) == (None, None, 0, None)

    def no_token(request, attempt):
        if attempt:
            raise TokenUnavailable
        return 401, ""

    assert send_with_retry(no_token, {}, 2)[3] == "Failed to obtain new auth token"

    def broken(request, attempt):
        raise OSError("connection reset")

    assert send_with_retry(broken, {}, 2) == (None, None, 1, "connection reset")


def test_stream_equals_one_batch_and_survives_a_restart(spark, tmp_path):
    images = [image(pk="deal_note", sk=str(i % 7), v=i) for i in range(30)]
    for part in range(3):
        folder = tmp_path / "changes" / f"part{part}"
        batch = envelopes(spark, images[part * 10 : part * 10 + 10], first_seq=part * 10)
        batch.coalesce(1).write.json(str(folder))

    def state(store):
        return {(r["sk"], r["payload"], r["seq"]) for r in store.current().collect()}

    def run(store, fail_on=None):
        def open_transport():
            if fail_on is not None and fail_on.exists():
                raise RuntimeError("target is down")
            return make_transport()()

        return start_migration(
            stream_json(spark, str(tmp_path / "changes" / "*"), 1),
            store,
            open_transport,
            str(tmp_path / "checkpoint"),
            available_now=True,
            fanout=2,
        )

    store = LedgerStore(spark, str(tmp_path / "stream"))
    down = tmp_path / "down"
    down.touch()
    with pytest.raises(Exception):
        run(store, down).awaitTermination()
    down.rename(tmp_path / "up")
    run(store, down).awaitTermination()

    whole = LedgerStore(spark, str(tmp_path / "whole"))
    run_batch(envelopes(spark, images), 0, whole, make_transport())
    assert state(store) == state(whole)


def test_preview_shows_rows_and_writes_nothing(spark):
    assert preview(envelopes(spark, ["{}"] * 30)).count() == 20


def open_log(path):
    """A transport that notes what it is sent, in order, in a file per task."""

    def open_transport():
        import uuid

        target = path / uuid.uuid4().hex

        def send(request, attempt):
            with target.open("a") as f:
                f.write(f"{request['base_key']} {request['seq']}\n")
            return 200, '{"data": {"application_id": "x"}}'

        return send

    return open_transport


@pytest.mark.parametrize("partitions", [None, 5])
def test_changes_of_a_record_are_sent_in_order(spark, tmp_path, partitions):
    changes = [{"pk": "deal_note", "sk": str(i % 3), "v": i} for i in range(60)]
    lost = [{"pk": "deal_note", "v": i} for i in range(40)]
    batch = records(spark, *changes, *lost).repartition(7, "seq")
    requests = build_requests(decode(batch), SPECS["deal_note"], MigrationConfig())
    delivered = deliver(requests, open_log(tmp_path), partitions=partitions)
    tasks = delivered.selectExpr("spark_partition_id() AS task", "reject_reason").distinct().collect()
    assert len({r["task"] for r in tasks if r["reject_reason"]}) > 2
    for file in tmp_path.iterdir():
        file.unlink()
    delivered.write.format("noop").mode("overwrite").save()
    sent = {}
    for file in tmp_path.iterdir():
        for line in file.read_text().splitlines():
            key, seq = line.split()
            sent.setdefault(key, []).append((file.name, int(seq)))
    assert sorted(sent) == ["0", "1", "2"]
    for key, calls in sent.items():
        assert len({name for name, _ in calls}) == 1
        assert [seq for _, seq in calls] == [i for i in range(60) if str(i % 3) == key]


def test_malformed_lists_are_set_aside(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    deals = [
        {"pk": "deal", "sk": "1", "fees": "none", "participants": {"a": 1}, "credit_pull": [1]},
        {"pk": "deal", "sk": "2", "documents": [{"deal_id": "2", "docs": "x"}], "fees": None},
        {"pk": "deal", "sk": "3", "documents": "x"},
    ]
    repeated = '{"pk":{"S":"deal"},"sk":{"S":"4"},"fees":{"L":[{"M":{"fee_id":{"S":"f"},"amount":{"N":"2"},"fee_id":{"S":"g"}}}]}}'
    batch = envelopes(spark, [*[image(**d) for d in deals], repeated])
    result = run_batch(batch, 0, store, make_transport())
    reasons = sorted((r["sk"], r["reject_reason"]) for r in result.quarantine().collect())
    assert reasons == [
        ("1", "bad_list:credit_pull"), ("1", "bad_list:fees"), ("1", "bad_list:participants"),
        ("2", "bad_list:docs"), ("3", "bad_list:documents"),
    ]
    log = {r["base_key"]: r for r in result.log.collect()}
    assert '\\"amount\\":2.0' in log["4#fees"]["payload"]
    assert body(log["4#fees"])["record_create_list"][0]["fee_id"] == "g"
    assert json.loads(log["2#document#0"]["payload"])["deal_id"] == "2"


def test_records_without_a_result_are_unresolved(spark, tmp_path):
    def open_transport():
        def send(request, attempt):
            if not request["bulk"]:
                return 200, '{"data": {"application_id": "x"}}'
            result = [{"statusCode": 200, "data": {"application_id": "b"}}]
            return 200, json.dumps({"api_response": json.dumps({"result": result})})

        return send

    store = LedgerStore(spark, str(tmp_path / "ledger"))
    fees = [{"fee_id": str(i)} for i in range(3)]
    result = run_batch(records(spark, {"pk": "deal", "sk": "1", "fees": fees}), 0, store, open_transport)
    lost = [(r["step"], r["result_pos"]) for r in result.unresolved().collect() if r["reason"] == "no_result"]
    assert sorted(lost) == [("fees", 1), ("fees", 2)]


def test_reports_are_kept_when_intermediates_go(spark, tmp_path):
    for k in range(4):
        batch = envelopes(spark, [image(pk="deal_note", sk=str(k)), image(pk="zzz", sk="1"), "{bad"], k * 10)
        batch.coalesce(1).write.mode("append").json(str(tmp_path / "changes"))
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    job = start_migration(
        stream_json(spark, str(tmp_path / "changes"), 1), store, make_transport(), str(tmp_path / "checkpoint"),
        available_now=True, fanout=2, keep_batches=1,
    )
    job.awaitTermination()
    assert len(list((tmp_path / "ledger" / "reports" / "quarantine").glob("batch=*[0-9]"))) == 4
    assert sum(p.is_dir() for p in (tmp_path / "ledger" / "batches").iterdir()) == 1
    assert {r["sk"] for r in store.current().collect()} == {f"success#{k}" for k in range(4)}
    assert store.is_committed(0)


def test_a_step_has_the_tasks_of_its_own_records(spark, tmp_path):
    """A wave of a few team leads does not take the tasks of all records of the batch."""
    notes = [{"pk": "deal_note", "sk": str(i)} for i in range(120)]
    leads = [{"pk": "user", "sk": f"u{i}", "organization_id": "o", "team_lead_user_id": f"u{i - 1}" if i else None} for i in range(3)]
    made = [{"pk": "organization", "sk": "o"}, *leads, *notes]
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    result = run_batch(records(spark, *made), 0, store, make_transport(), MigrationConfig(records_per_task=6))
    folders = {name.split("-")[0]: int(name.split("-")[-1]) for name in os.listdir(f"{store.batch_dir(0)}/outbox")}
    assert folders["0"] == 21 and {n for step, n in folders.items() if step != "0"} == {8}
    found = {r["sk"] for r in store.current("result").filter("pk = 'user'").collect()}
    assert found == {f"success#u{i}" for i in range(3)} and len(result.steps) == len(folders)
