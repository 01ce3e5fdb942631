import json

import pytest

from ledgerferry.operators.decode import accepted, decode, decode_deep
from ledgerferry.operators.routing import route, unrouted
from tests.support import envelopes, image, records, tag


def quarantine(decoded):
    return decoded.filter("reject_reason IS NOT NULL")


def attrs_of(row):
    return {k: (v["tag"], v["text"]) for k, v in row["attrs"].items()}


def test_values_of_every_tag(spark):
    raw = (
        '{"pk":{"S":"deal"},"sk":{"N":"7"},"t":{"BOOL":true},"z":{"NULL":true},'
        '"ss":{"SS":["a","b"]},"ns":{"NS":["1","2.5"]},"bin":{"B":"eA=="},'
        '"m":{ "M" : {"x":{"S":"q\\"{é"},"e":{"M":{}},"l":{"L":[]},"n":{"N":"5"}}}}'
    )
    row = decode(envelopes(spark, [raw])).first()
    attrs = attrs_of(row)
    assert (row["pk"], row["sk"], row["reject_reason"]) == ("deal", "7", None)
    assert attrs["t"] == ("BOOL", "true")
    assert attrs["z"] == ("NULL", None)
    assert attrs["ss"] == ("SS", '["a","b"]')
    assert attrs["ns"] == ("NS", "[1.0,2.5]")
    assert attrs["bin"] == ("B", "eA==")
    assert json.loads(attrs["m"][1]) == {"x": 'q"{é', "e": {}, "l": [], "n": 5.0}


def test_null_texts_only_at_top_level_and_exact(spark):
    row = decode(
        records(spark, {"a": "", "b": "null", "c": "NULL", "d": "Null", "e": " ", "f": {"g": ""}})
    ).first()
    attrs = attrs_of(row)
    assert [attrs[k][0] for k in "abc"] == ["NULL"] * 3
    assert (attrs["d"], attrs["e"]) == (("S", "Null"), ("S", " "))
    assert attrs["f"] == ("M", '{"g":""}')


@pytest.mark.parametrize(
    ("raw", "reason"),
    [
        ('{"a":', "undecodable"),
        ("[1]", "undecodable"),
        ('{"a":{"N":"x"}}', "bad_attribute"),
        ('{"a":{"Q":"x"}}', "bad_attribute"),
        ('{"a":{"M":{"b":{"Q":1}}}}', "bad_attribute"),
        ('{"a":{"L":[{"N":"NaN"}]}}', "bad_attribute"),
    ],
)
def test_undecodable_records_are_kept_with_reason(spark, raw, reason):
    decoded = decode(envelopes(spark, [raw]))
    assert [(r["raw"], r["reject_reason"]) for r in quarantine(decoded).collect()] == [
        (raw, reason)
    ]


def test_records_without_image_are_dropped(spark):
    assert decode(envelopes(spark, [None, "{}", '{"SizeBytes":{"N":"1"}}'])).count() == 0


def test_last_value_of_a_repeated_key_and_hidden_attribute(spark):
    raw = '{"a":{"S":"1"},"SizeBytes":{"N":"3"},"a":{"S":"2"}}'
    assert attrs_of(decode(envelopes(spark, [raw])).first()) == {"a": ("S", "2")}


def test_any_depth_is_decoded(spark):
    value = {"leaf": [1.5, None, "x"]}
    for i in range(12):
        value = {"k": value, "s": "t"} if i % 2 else [value, True]
    decoded = decode(envelopes(spark, [image(pk="deal", sk="1", v=value), image(pk="deal")]))
    assert [r["reject_reason"] for r in quarantine(decoded).collect()] == ["too_deep"]
    deep = decode_deep(decoded).first()
    assert (deep["pk"], deep["sk"]) == ("deal", "1")
    assert json.loads(deep["attrs"]["v"]["text"]) == value


def wrapped(value, depth):
    for i in range(depth):
        value = {"M": {"k": value, "s": {"S": "\u0001"}}} if i % 2 else {"L": [value, {"BOOL": True}]}
    return value


def test_a_value_is_read_alike_at_every_depth(spark):
    """Also odd ones: numbers that are no text, several tags, repeated keys, a bad tag."""
    leaves = [
        '{"N":100000.0}', '{"N":"5","S":"q"}', '{"S":5}', '{"BOOL":"true"}', '{"N":"1e22"}', '{"N":"-0.00000015"}', '{"N":"x"}', '{"Q":1}',
        '{"NS":["1","2.5"]}', '{"SS":["\\u0001"]}', '{"M":{"a":{"S":"1"},"b":{"S":"2"},"a":{"S":"3"}}}', '{"M":{}}', '{"L":[]}', '{"M":5}', '{"NULL":true}', "{}",
    ]
    depths, rows = [*range(1, 13), 17, 40], []
    for depth in depths:
        rows += [f'{{"pk":{{"S":"deal"}},"v":{json.dumps(wrapped({"S": "@"}, depth)).replace(json.dumps({"S": "@"}), leaf)}}}' for leaf in leaves]
    decoded = decode(envelopes(spark, rows))
    deep = decode_deep(decoded).collect()
    done = {r["seq"]: r for r in [*decoded.filter("NOT reject_reason <=> 'too_deep'").collect(), *deep]}
    assert len(done) == len(rows) and len(deep) > 100
    for j, leaf in enumerate(leaves):
        seen = set()
        for i, depth in enumerate(depths):
            row = done[i * len(leaves) + j]
            text = row["attrs"]["v"]["text"] if row["attrs"] else None
            start, end = json.dumps(json.loads("1")), None
            if text is not None:
                around = [""] * 2
                for k in range(depth):
                    around = ["{\"k\":" + around[0], around[1] + ",\"s\":\"\\u0001\"}"] if k % 2 else ["[" + around[0], around[1] + ",true]"]
                start, end = around
                assert text.startswith(start) and text.endswith(end), (leaf, depth, text)
                text = text[len(start) : len(text) - len(end)]
            seen.add((row["reject_reason"], text))
        assert len(seen) == 1, (leaf, seen)


def test_unknown_and_missing_pk_are_unrouted(spark):
    routed = route(
        decode(records(spark, {"pk": "zzz", "sk": "1"}, {"sk": "2"}, {"pk": "deal", "sk": "3"}))
    )
    assert sorted(r["sk"] for r in unrouted(routed).collect()) == ["1", "2"]
