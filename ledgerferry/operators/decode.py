"""From change envelopes to decoded records: project, untag, normalise, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerferry.functions.jsontext import lit, lits
from ledgerferry.functions.tagged import (
    BAD_VALUE,
    TOO_DEEP,
    attr,
    decode_value,
    last_wins,
    open_deep,
    text_of,
)
from ledgerferry.operators.once import once
from ledgerferry.schemas import TAGGED_MAP
from ledgerferry.sources.storage import cut

HIDDEN_ATTRIBUTES = ("SizeBytes",)

UNDECODABLE = "undecodable"
BAD_ATTRIBUTE = "bad_attribute"
TOO_DEEP_REASON = "too_deep"


NESTED = "v.tag IN ('M', 'L', 'NS')"
DEEP = f"(v.tag IN ('M', 'L') AND contains(v.text, {TOO_DEEP}))"


def decode(
    changes: DataFrame,
    image: str = "dynamodb.NewImage",
    order: str = "seq",
    event: str = "eventName",
) -> DataFrame:
    """Decode every change record that carries a new image.

    Records without one (or with an empty one) are dropped; records that cannot be
    decoded stay, with `reject_reason` and their raw text, so that nothing is lost.
    """
    return _judged(_attributes(changes, image, order, event))


def _attributes(changes: DataFrame, image: str, order: str, event: str) -> DataFrame:
    """Images with their attributes; values below NATIVE_DEPTH levels stand in them as they came."""
    images = changes.selectExpr(
        f"CAST({order} AS BIGINT) AS seq", f"{event} AS event_name", f"{image} AS raw"
    ).filter("raw IS NOT NULL")
    # The parsed map is bound inside the expression: as a column it would be copied out and read back.
    entries = (
        f"transform(filter({last_wins('t')}, e -> e.key NOT IN ({lits(HIDDEN_ATTRIBUTES)})),"
        f" e -> struct(e.key, {decode_value('e.value')}))"
    )
    return once(
        images,
        where="attrs IS NULL OR size(attrs) > 0",
        attrs=f"transform(array(from_json(raw, {lit(TAGGED_MAP)})), t -> map_from_entries({entries}))[0]",
    )


def _judged(attributes: DataFrame) -> DataFrame:
    reason = (
        f"CASE WHEN attrs IS NULL THEN '{UNDECODABLE}'"
        f" WHEN exists(map_values(attrs), v -> v.tag IS NULL"
        f" OR ({NESTED} AND contains(v.text, {BAD_VALUE}))) THEN '{BAD_ATTRIBUTE}'"
        f" WHEN exists(map_values(attrs), v -> {DEEP}) THEN '{TOO_DEEP_REASON}' END"
    )
    return once(attributes, reject_reason=reason).selectExpr(
        "seq",
        "event_name",
        f"{key_text('pk')} AS pk",
        f"{key_text('sk')} AS sk",
        "if(reject_reason IS NULL, attrs, NULL) AS attrs",
        "if(reject_reason IS NULL, NULL, raw) AS raw",
        "reject_reason",
    )


def key_text(name: str) -> str:
    """Text of a scalar attribute used as a key."""
    return text_of(attr(name), "S", "N")


def decode_deep(rejected: DataFrame, directory: str | None = None) -> DataFrame:
    """Decode the records `decode` set aside as too deep, at any depth.

    The same expressions read them, NATIVE_DEPTH levels a round, so a value's reading does not
    depend on how deep it lies. Rounds are cut by tables written below `directory`; only rows
    with that reason take part, and their number does not change the plans.
    """
    deep = rejected.filter(f"reject_reason = '{TOO_DEEP_REASON}'")
    rows = cut(_attributes(deep, "raw", "seq", "event_name"), directory)
    unread = f"exists(map_values(attrs), v -> {DEEP})"
    while not rows.filter(unread).isEmpty():
        opened = f"transform_values(attrs, (k, v) -> if({DEEP}, named_struct('tag', v.tag, 'text', {open_deep('v.text')}), v))"
        rows = cut(once(rows.withColumnRenamed("attrs", "was"), attrs=opened.replace("(attrs,", "(was,", 1)).drop("was"), directory)
    return _judged(rows)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter("reject_reason IS NULL")
