import pytest

from ledgerferry.functions.jsontext import lit
from ledgerferry.functions.scalars import (
    not_found_message,
    priority_of,
    storage_path,
    to_boolean,
    to_epoch_seconds,
    to_integer,
    to_string_array,
)
from ledgerferry.functions.tagged import truthy


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} AS v").first()["v"]


def text(x):
    return "CAST(NULL AS STRING)" if x is None else lit(x)


def attribute(tag, x):
    return f"named_struct('tag', {lit(tag)}, 'text', {text(x)})"


@pytest.mark.parametrize(
    ("given", "expected"),
    [("TRUE", True), (" y ", True), ("1", True), ("0", False), ("maybe", False), ("", None),
     (" \t", None), (None, None)],
)
def test_boolean(spark, given, expected):
    assert value(spark, to_boolean(text(given))) is expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("1990-01-01", 631152000),
        ("1990-01-01T10:00:00.900Z", 631188000),
        ("1990-01-01 10:00", 631188000),
        ("1969-12-31T23:59:59.500Z", 0),
        ("1969-12-31T23:59:59.000Z", -1),
        ("2021-03-14T02:30:00ZZ", 1615689000),
        ("1990-01-01T10:00:00+05:00", None),
        ("01/02/1990", None),
        ("1990", None),
        ("1990-1-1", None),
        ("1990-02-30", None),
        ("1990-01-01T24:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_epoch(spark, given, expected):
    assert value(spark, to_epoch_seconds(text(given))) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("[1444,1548, 1494]", ["1444", "1548", "1494"]), ("1,2", ["1", "2"]), ("[]", []),
     ("[a b,c]", ["ab", "c"]), (None, [])],
)
def test_string_array(spark, given, expected):
    assert value(spark, to_string_array(text(given))) == expected


@pytest.mark.parametrize(
    ("tag", "given", "expected"),
    [("N", "3.9", 3), ("N", "-3.9", -3), ("N", "1E2", 100), ("S", " 12 ", 12), ("S", "3.5", None),
     ("S", "x", None), ("BOOL", "true", 1), ("M", "{}", None)],
)
def test_integer(spark, tag, given, expected):
    assert value(spark, to_integer(attribute(tag, given))) == expected


@pytest.mark.parametrize(
    ("tag", "given", "expected"),
    [("S", "false", True), ("BOOL", "false", False), ("N", "0.0", False), ("N", "2", True),
     ("NULL", None, False), ("M", "{}", False), ("L", "[1]", True)],
)
def test_truthy(spark, tag, given, expected):
    assert value(spark, truthy(attribute(tag, given))) is expected


def test_texts(spark):
    assert value(spark, storage_path("s3://x/", "'a/b'")) == "s3://x/a/b"
    assert value(spark, storage_path("s3://x", text(None))) is None
    assert value(spark, not_found_message("user", "'9'")) == "v2_not_found:user:9"
    assert value(spark, priority_of("'B'", ("a", "b"))) == 2
    assert value(spark, priority_of("'z'", ("a", "b"))) == 3
