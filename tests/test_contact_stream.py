import json

import pytest

from ledgerferry import LedgerStore, run_batch
from ledgerferry.sources.changes import stream_json
from ledgerferry.streaming.contacts import start_contacts
from tests.support import envelopes, image, make_transport

ROLES = ["realtor", "Client", "solicitor", "other"]


def contacts():
    rows = []
    for i in range(24):
        role = [{"role": ROLES[i % 4]}] if i % 7 else None
        rows.append(image(pk="contact", sk=str(i), email_id=f"m{i % 5}", first_name="" if i % 3 else f"F{i}", gender=f"g{i}", role_based_attributes=role))
    return [*rows, image(pk="contact", sk="lost"), image(pk="contact", sk="lost2"), image(pk="deal", sk="1"), '{"bad']


def written(log):
    return sorted((r["base_key"] or "", r["seq"], r["payload"], r["reject_reason"] or "", r["v2_value"] or "") for r in log)


def test_state_equals_the_batch_flow_also_after_a_restart(spark, tmp_path):
    images = contacts()
    for part in range(3):
        envelopes(spark, images[part * 10 : part * 10 + 10], part * 10).coalesce(1).write.mode("append").json(str(tmp_path / "changes"))
    sent = tmp_path / "sent"
    plain = make_transport(failing={"m3"})

    def transport():
        send = plain()

        def noted(request, attempt):
            with open(sent, "a") as f:
                f.write(f"{request.get('idempotency_key')}\n")
            return send(request, attempt)

        return noted

    store = LedgerStore(spark, str(tmp_path / "stream"))
    logs = {}

    def run(fail_at=None):
        def on_log(log, batch_id):
            if batch_id == fail_at:
                raise RuntimeError("stopped")
            logs[batch_id] = log.collect()

        job = start_contacts(
            stream_json(spark, str(tmp_path / "changes"), 1), store, transport, str(tmp_path / "checkpoint"), available_now=True, on_log=on_log
        )
        job.awaitTermination()

    with pytest.raises(Exception, match="stopped"):
        run(fail_at=1)
    assert set(logs) == {0}
    run()
    assert set(logs) == {0, 1, 2}
    keys = sent.read_text().split()
    assert len(keys) == len(set(keys)) > 15  # the batch that was run again took its answers from the journal

    whole = LedgerStore(spark, str(tmp_path / "whole"))
    batches = [envelopes(spark, images[p * 10 : p * 10 + 10], p * 10) for p in range(3)]
    expected = [r for k, b in enumerate(batches) for r in run_batch(b, k, whole, plain).log.filter("pk = 'contact'").collect()]
    assert written([r for log in logs.values() for r in log]) == written(expected)
    state = lambda s: {(r["sk"], r["payload"]) for r in s.current().filter("pk = 'contact'").collect()}
    assert state(store) == state(whole)
    last = json.loads(next(r["payload"] for r in store.current().collect() if r["sk"] == "success#m1"))
    assert len(last["role_based_attributes"]) > 1
