import json

import pytest

from ledgerferry.functions.responses import (
    bulk_error,
    bulk_results,
    bulk_total,
    parse_bodies,
    single_outcome,
    with_new_id,
)
from ledgerferry.operators.deliver import accepted_id


def wrapped(inner):
    return json.dumps({"api_response": inner if isinstance(inner, str) else json.dumps(inner)})


SINGLE = [
    (wrapped({"statusCode": "200", "result": {"application_id": "A1"}}), True, "A1"),
    (wrapped({"statusCode": 200}), False, None),
    (wrapped("{oops"), False, None),
    ('{"api_response": null}', False, None),
    ('{"error": null}', False, None),
    ('{"status": true, "data": {"loan_lender_application_id": "L1"}}', True, "L1"),
    ('{"status": "ok"}', True, None),
    ('{"status": "down"}', False, None),
    ('{"status": 1}', False, None),
    ('{"data": {"application_id": "A2"}}', True, "A2"),
    ('{"data": {"application_id": 12}}', True, "12"),
    ('{"result": {}, "data": {"application_id": "z"}}', True, "z"),
    ('{"result": [1], "data": {"application_id": "z"}}', True, None),
    ('{"data": {"application_id": "", "loan_lender_application_id": "q\\"r"}}', True, 'q"r'),
    ('[1]', True, None),
    ('["error"]', False, None),
    ('"all good"', True, None),
    ('"an error"', False, None),
    ("5", False, None),
    ("not json", False, None),
]


def test_single_outcomes(spark):
    bodies = spark.createDataFrame([(i, body) for i, (body, _, _) in enumerate(SINGLE)], "i int, body string")
    outcomes = parse_bodies(bodies).selectExpr("i", f"{single_outcome()} AS o").selectExpr("i", "o.*")
    rows = {r["i"]: r for r in with_new_id(outcomes).collect()}
    got = [(rows[i]["is_success"], rows[i]["v2_value"]) for i in range(len(SINGLE))]
    assert got == [(ok, v2) for _, ok, v2 in SINGLE]
    assert rows[2]["error"] == "Failed to parse api response"


@pytest.mark.parametrize(
    ("body", "successes", "error", "total"),
    [
        (
            json.dumps(
                {
                    "api_response": json.dumps(
                        {"result": [{"statusCode": 200}, {"statusCode": 500}, {"statusCode": "200"}]}
                    ),
                    "total_records_count": 3,
                }
            ),
            [True, False, False],
            None,
            3,
        ),
        (wrapped({}), [], None, 0),
        (wrapped({"result": None}), None, "Failed to parse api response", 0),
        (wrapped({"result": [1]}), None, "Failed to parse api response", 0),
        ('{"ok": 1}', None, "Invalid response format", 0),
    ],
)
def test_bulk_outcomes(spark, body, successes, error, total):
    row = (
        parse_bodies(spark.createDataFrame([(body,)], "body string"))
        .selectExpr(
            f"{bulk_results()} AS r",
            f"{bulk_error()} AS e",
            f"{bulk_total('total_records_count')} AS t",
        )
        .first()
    )
    assert (None if row["r"] is None else [x["is_success"] for x in row["r"]]) == successes
    if successes is None:
        assert row["e"] == error
    assert row["t"] == total


REPEATED = [
    ('{"data": {"application_id": "a", "application_id": "b"}}', True, "b"),
    ('{"error": 1, "status": "ok", "data": {"application_id": "a"}}', False, None),
    ('{"status": "down", "status": "ok", "data": {"application_id": "a"}}', True, "a"),
    ('{"status": null, "data": {"application_id": "a"}}', False, None),
    ('{"status": ["OK"], "data": {"application_id": "a"}}', False, None),
    ('{"data": {"application_id": 0, "loan_lender_application_id": true}}', True, "True"),
    ('{"data": {"application_id": NaN}}', False, None),
    (wrapped({"statusCode": "200", "error": 1, "result": {"application_id": "A"}}), True, "A"),
    (wrapped("[1]"), False, None),
    ("null", False, None),
]


def test_contacts_follow_the_rule_of_the_ledger(spark):
    cases = [*SINGLE, *REPEATED]
    bodies = spark.createDataFrame([(i, body) for i, (body, _, _) in enumerate(cases)], "i int, body string")
    outcomes = parse_bodies(bodies).selectExpr("i", f"{single_outcome()} AS o").selectExpr("i", "o.*")
    rows = {r["i"]: r for r in with_new_id(outcomes).collect()}
    for i, (body, ok, v2) in enumerate(cases):
        assert (rows[i]["is_success"], rows[i]["v2_value"]) == (ok, v2), body
        assert accepted_id(body) == bool(ok and v2), body
