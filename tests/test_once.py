import json
import re

from ledgerferry.operators.decode import decode
from ledgerferry.operators.once import once
from tests.support import envelopes, image


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_expressions_stand_in_a_projection_once(spark):
    rows = once(spark.range(4), twice="id * 2", text="concat('n', id)")
    found = plan(rows.filter("twice > 2 AND text <> 'n3'").selectExpr("twice + twice AS a", "text"))
    assert len(re.findall(r"\* 2", found)) == 1
    assert re.search(r"Generate inline\(__once#\d+\)", found)
    kept = once(spark.range(4), where="twice > 2", twice="if(id = 3, NULL, id * 2)")
    assert [(r["id"], r["twice"]) for r in kept.collect()] == [(2, 4)]


def test_parsed_images_are_not_a_column(spark):
    deep = {"a": {"b": [{"c": "x"}, 2]}, "pk": "deal", "sk": "1"}
    changes = envelopes(spark, [image(**deep), "{", "{}", None, image(pk="p", sk="2")])
    decoded = decode(changes)
    parsed = [line for line in plan(decoded).splitlines() if "from_json" in line]
    assert len(parsed) == 1 and "map_from_entries" in parsed[0]
    rows = sorted(decoded.collect(), key=lambda r: r["seq"])
    assert [(r["seq"], r["sk"], r["reject_reason"]) for r in rows] == [(0, "1", None), (1, None, "undecodable"), (4, "2", None)]
    assert json.loads(rows[0]["attrs"]["a"]["text"]) == {"b": [{"c": "x"}, 2]}
