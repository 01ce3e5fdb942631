"""Helpers: change records from plain dicts, and a recording-free deterministic target."""

import json

from ledgerferry.schemas import ENVELOPE


def tag(value):
    if value is None:
        return {"NULL": True}
    if isinstance(value, bool):
        return {"BOOL": value}
    if isinstance(value, (int, float)):
        return {"N": str(value)}
    if isinstance(value, str):
        return {"S": value}
    if isinstance(value, list):
        return {"L": [tag(x) for x in value]}
    return {"M": {k: tag(v) for k, v in value.items()}}


def image(**record):
    return json.dumps({k: tag(v) for k, v in record.items()})


def envelopes(spark, images, first_seq=0):
    """Images (JSON text or None) as a change batch, numbered in order."""
    rows = [("INSERT", first_seq + i, (x,)) for i, x in enumerate(images)]
    return spark.createDataFrame(rows, ENVELOPE)


def records(spark, *dicts, first_seq=0):
    return envelopes(spark, [image(**d) for d in dicts], first_seq)


def make_transport(failing=(), flaky=(), no_id=(), unreadable=()):
    """Target system: keys fail for good, need a second attempt, or answer without id."""

    def open_transport():
        def send(request, attempt):
            key = request["base_key"]
            if key in flaky and attempt == 0:
                return 401, ""
            if key in failing:
                return 500, "{}"
            if key in unreadable:
                return 200, '{"ok": 1}'
            if key in no_id:
                return 200, '{"status": "ok"}'
            if request["bulk"]:
                body = json.loads(json.loads(request["payload"])["api_request"])
                results = [
                    {"statusCode": 200, "data": {"application_id": f"v2-{key}-{i}"}}
                    if "bad" not in json.dumps(item)
                    else {"statusCode": 500}
                    for i, item in enumerate(body["record_create_list"])
                ]
                return 200, json.dumps({"api_response": json.dumps({"result": results})})
            ids = {"application_id": f"v2-{key}", "loan_lender_application_id": f"L-{key}"}
            return 200, json.dumps({"data": ids})

        return send

    return open_transport
