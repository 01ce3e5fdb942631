import json

import pytest

from ledgerferry import Children, EntityRegistry, EntitySpec, ForeignKey, LedgerStore, MigrationConfig, run_batch
from ledgerferry.functions.jsontext import json_object, quote
from ledgerferry.functions.tagged import as_json, attr
from ledgerferry.operators.deliver import AWAITED, new_id, put_id
from ledgerferry.plans.children import BulkList, bulk_child, expand
from ledgerferry.plans.entities import app_request, id_text, pass_through
from ledgerferry.plans.registry import DEFAULT
from tests.support import make_transport, records


def delivery_jobs(store, batch=0):
    return len([p for p in store.spark._jvm.java.io.File(store.batch_dir(batch)).list() if p.startswith("log_") and p.endswith(".done") and not p.startswith(".")])


def users(*leads, organization="101"):
    return [
        {"pk": "user", "sk": f"u{i}", "organization_id": organization, **({"team_lead_user_id": lead} if lead else {})}
        for i, lead in enumerate(leads)
    ]


def payloads(store, entity="user"):
    return {r["sk"]: (r["payload"], r["errorMsg"]) for r in store.current().filter(f"pk = '{entity}'").collect()}


def test_steps_follow_from_foreign_keys():
    steps = DEFAULT.order()
    assert [s for s in steps if "user_group" in s] == [["user", "user_group"]]
    assert steps[0] == sorted(set(DEFAULT.names) - {"user", "user_group", "account"}) and steps[2] == ["account"]
    assert DEFAULT.chain("user").column == "team_lead_v2" and DEFAULT.chain("account") is None


def test_keys_in_a_circle_are_refused():
    spec = lambda other: EntitySpec("mock", pass_through, keys=(ForeignKey(other, id_text("o"), "o_v2"),))
    with pytest.raises(ValueError, match="circle: a, b"):
        EntityRegistry({"a": spec("b"), "b": EntitySpec("mock", pass_through)}).with_entity("b", spec("a"))


def test_an_entity_of_the_applications_own(spark, tmp_path):
    """A twelfth entity with two foreign keys, one to a chained entity, and a child list."""
    manager = ForeignKey("user", id_text("manager_id"), "manager_v2")
    organization = ForeignKey("organization", id_text("organization_id"), "organization_v2", required="false")

    def payload(config):
        return json_object({"manager": quote("manager_v2"), "org": quote("organization_v2"), "name": as_json(attr("name"))})

    rooms = BulkList("rooms", "bulk", ("room_id", "size"))

    def room_requests(offices, config):
        child = bulk_child("'rooms'", rooms, config.endpoint("bulk"), lambda body: app_request(config, "room", body), "concat(sk, '#rooms')")
        return expand(offices, child)

    registry = DEFAULT.with_entity("office", EntitySpec("mock", payload, keys=(manager, organization)), room_requests)
    assert registry.order()[-1] == ["account", "office"]
    batch = records(
        spark,
        {"pk": "office", "sk": "1", "manager_id": "u2", "organization_id": "101", "name": "N", "rooms": [{"room_id": "r", "size": 2}, {"room_id": "s"}]},
        {"pk": "office", "sk": "2", "manager_id": "nobody", "rooms": "x"},
        {"pk": "organization", "sk": "101"},
        *users(None, "u0", "u1"),
    )
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    result = run_batch(batch, 0, store, make_transport(), registry=registry)
    rows = {r["sk"]: r for r in store.current().filter("pk = 'office'").collect()}
    assert json.loads(rows["success#1"]["payload"]) == {"manager": "v2-u2", "org": "v2-101", "name": "N"}
    assert rows["failed#2"]["errorMsg"] == "v2_not_found:user:nobody"
    assert rows["success#1#rooms#1"]["v2_value"] == "v2-1#rooms-1"
    assert [r["reject_reason"] for r in result.quarantine().collect()] == ["bad_list:rooms"]
    assert result.unrouted().count() == 0


def test_children_may_wait_for_the_answer(spark, tmp_path):
    def stamps(notes, responses, config):
        joined = notes.join(responses, ["sk", "seq"])
        columns = ["pk", "sk", "sk AS base_key", "seq", "'stamp' AS step", "'' AS pos", "false AS bulk", "'e' AS endpoint", "CAST(map() AS map<string,string>) AS headers"]
        return joined.selectExpr(*columns, "response AS payload", "CAST(NULL AS STRING) AS failure", "CAST(NULL AS STRING) AS reject_reason", "CAST(NULL AS INT) AS n_items")

    registry = EntityRegistry({"deal_note": DEFAULT.specs["deal_note"]}, (Children("deal_note", stamps, answered=True),))
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    result = run_batch(records(spark, {"pk": "deal_note", "sk": "7"}), 0, store, make_transport(), registry=registry)
    stamp = next(r for r in result.log.collect() if r["step"] == "stamp")
    assert json.loads(stamp["payload"])["data"]["application_id"] == "v2-7"


def test_a_long_chain_goes_out_in_few_jobs(spark, tmp_path):
    """200 leads, one above the other: waves double, so log2 of the depth is enough."""
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    chain = users(None, *[f"u{i}" for i in range(199)])
    side = [{"pk": "user", "sk": f"s{i}", "organization_id": "101", "team_lead_user_id": f"u{i * 9}"} for i in range(20)]
    run_batch(records(spark, *chain, *side, {"pk": "organization", "sk": "101"}), 0, store, make_transport())
    found = payloads(store)
    assert len(found) == 220
    for i in range(1, 200):
        assert json.loads(found[f"success#u{i}"][0])["data"]["team_lead_user_id"] == f"v2-u{i - 1}"
    assert all(json.loads(found[f"success#s{i}"][0])["data"]["team_lead_user_id"] == f"v2-u{i * 9}" for i in range(20))
    assert delivery_jobs(store) <= 12


def test_what_follows_a_failed_lead_fails_inside_a_wave(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    chain = users(None, *[f"u{i}" for i in range(11)])
    batch = records(spark, *chain, {"pk": "organization", "sk": "101"})
    result = run_batch(batch, 0, store, make_transport(failing={"u5"}))
    found = payloads(store)
    assert set(found) == {*(f"success#u{i}" for i in range(5)), *(f"failed#u{i}" for i in range(5, 12))}
    assert found["failed#u5"][1] == "HTTP 500" and found["failed#u6"][1] == "v2_not_found:user:u5"
    assert json.loads(found["failed#u9"][0]) == {"pk": "user", "sk": "u9", "organization_id": "101", "team_lead_user_id": "u8"}
    jobs = delivery_jobs(store)

    def refuse():
        raise AssertionError("a finished step must not be sent again")

    run_batch(batch, 0, store, refuse)
    assert payloads(store) == found and delivery_jobs(store) == jobs and result.log.count() == 13


def test_broad_chains_go_depth_by_depth(spark, tmp_path):
    """A wave that would give one task more than its share of records is a single depth."""
    tree = users(None, "u0", "u1", *["u2"] * 30)
    batch = records(spark, *tree, {"pk": "organization", "sk": "101"})
    jobs = []
    for share in (20_000, 10):
        store = LedgerStore(spark, str(tmp_path / f"ledger{share}"))
        run_batch(batch, 0, store, make_transport(), MigrationConfig(records_per_task=share, delivery_partitions=4))
        assert sum(k.startswith("success") for k in payloads(store)) == len(tree)
        jobs.append(delivery_jobs(store))
    assert jobs == [4, 5]


def test_ids_are_put_into_texts_as_deep_as_they_lie():
    odd = 'a"b\\cé'
    plain = json.dumps({"x": AWAITED})
    once = json.dumps({"body": plain})
    twice = json.dumps({"outer": once, "y": AWAITED})
    assert json.loads(put_id(plain, odd)) == {"x": odd}
    assert json.loads(json.loads(put_id(once, odd))["body"]) == {"x": odd}
    out = json.loads(put_id(twice, odd))
    assert out["y"] == odd and json.loads(json.loads(out["outer"])["body"]) == {"x": odd}


def test_new_ids_of_answers():
    assert new_id('{"data": {"application_id": "x"}}') == "x"
    assert new_id('{"data": {"application_id": 5}}') == "5"
    assert new_id('{"data": {"application_id": true}}') == "True"
    assert new_id('{"data": {"application_id": ""}}') is None and new_id("[]") is None


