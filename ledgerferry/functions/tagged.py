"""Type-tagged JSON: decoding values and reading decoded attributes."""

from __future__ import annotations

from collections.abc import Callable

from ledgerferry.functions.jsontext import json_object_of, lit, lits, number, quote_field
from ledgerferry.schemas import NATIVE_DEPTH, tagged_value

# The texts a top-level string is emptied for, and the number syntax.
NULL_TEXTS = ("null", "NULL", "")
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Marks inside an untagged text; neither can occur in JSON text itself. What lies too deep
# stands between two of the second kind, as its tag and its raw text.
BAD_VALUE = "'\\u0000'"
TOO_DEEP = "'\\u0001'"


def last_wins(tagged: str) -> str:
    """Entries of a map in which, of a repeated key, the last value counts."""
    keys = f"map_keys({tagged})"
    return (
        f"if(size({keys}) = size(array_distinct({keys})), map_entries({tagged}),"
        f" filter(map_entries({tagged}), (x, p) ->"
        f" NOT array_contains(slice({keys}, p + 2, size({tagged})), x.key)))"
    )


def is_number(text: str) -> str:
    return f"({text} RLIKE {lit(NUMBER_PATTERN)})"


def set_json(value: str) -> str:
    """Plain JSON array of a set value (string, number or binary set)."""
    member = f"CASE WHEN {is_number('n')} THEN {number('n')} END"
    numbers = f"array_join(transform({value}.NS, n -> {member}), ',', {BAD_VALUE})"
    return (
        f"CASE WHEN {value}.SS IS NOT NULL THEN to_json({value}.SS)"
        f" WHEN {value}.BS IS NOT NULL THEN to_json({value}.BS)"
        f" WHEN {value}.NS IS NOT NULL THEN concat('[', {numbers}, ']') END"
    )


def scalar_json(value: str) -> str:
    """Plain JSON of a scalar or set value; null for anything else."""
    return (
        f"CASE WHEN {value}.S IS NOT NULL THEN {quote_field(value + '.S')}"
        f" WHEN {value}.N IS NOT NULL"
        f" THEN CASE WHEN {is_number(value + '.N')} THEN {number(value + '.N')} END"
        f" WHEN {value}.BOOL IS NOT NULL THEN CAST({value}.BOOL AS STRING)"
        f" WHEN {value}.`NULL` IS NOT NULL THEN 'null'"
        f" WHEN {value}.B IS NOT NULL THEN {quote_field(value + '.B')}"
        f" ELSE {set_json(value)} END"
    )


def nested_json(value: str, depth: int = NATIVE_DEPTH) -> str:
    """Plain JSON of an `M` or `L` value, marked where it is malformed or too deep.

    Maps and lists share one member list per level, so the expression grows by a constant
    per level.
    """
    e, m = f"e{depth}", f"m{depth}"
    members = (
        f"coalesce("
        f"transform({last_wins(f'{value}.M')}, {e} ->"
        f" struct(concat({quote_field(e + '.key')}, ':') AS lead, {e}.value AS value)),"
        f"transform({value}.L, {e} ->"
        f" struct('' AS lead, {e} AS value)))"
    )
    inner = f"{m}.value"
    unread = f"concat({TOO_DEEP}, if({inner}.M IS NOT NULL, 'M', 'L'), coalesce({inner}.M, {inner}.L), {TOO_DEEP})"
    deeper = nested_json(inner, depth - 1) if depth > 1 else unread
    member = (
        f"concat({m}.lead, CASE WHEN {inner}.M IS NOT NULL OR {inner}.L IS NOT NULL"
        f" THEN {deeper} ELSE {scalar_json(inner)} END)"
    )
    body = f"coalesce(array_join(transform({members}, {m} -> {member}), ',', {BAD_VALUE}), {BAD_VALUE})"
    is_map = f"{value}.M IS NOT NULL"
    return f"concat(if({is_map}, '{{', '['), {body}, if({is_map}, '}}', ']'))"


def open_deep(text: str) -> str:
    """An untagged text with what was too deep read some levels further."""
    parts = f"split({text}, {TOO_DEEP})"
    value = f"from_json(concat('{{\"', left(p, 1), '\":', substr(p, 2), '}}'), {lit(tagged_value(NATIVE_DEPTH))})"
    opened = f"transform(array({value}), t -> {nested_json('t')})[0]"
    return f"array_join(transform({parts}, (p, i) -> if(i % 2 = 0, p, {opened})), '')"


def decode_value(value: str) -> str:
    """Tagged value -> attribute struct<tag, text>; a malformed one has no tag."""

    def attribute(tag: str, text: str) -> str:
        return f"named_struct('tag', {tag}, 'text', CAST({text} AS STRING))"

    none = "CAST(NULL AS STRING)"
    nested = nested_json(value)
    return (
        f"CASE WHEN {value}.S IN ({lits(NULL_TEXTS)}) THEN {attribute(lit('NULL'), none)}"
        f" WHEN {value}.S IS NOT NULL THEN {attribute(lit('S'), value + '.S')}"
        f" WHEN {value}.N IS NOT NULL THEN"
        f" {attribute(f'if({is_number(value + ".N")}, {lit("N")}, {none})', value + '.N')}"
        f" WHEN {value}.BOOL IS NOT NULL THEN {attribute(lit('BOOL'), value + '.BOOL')}"
        f" WHEN {value}.`NULL` IS NOT NULL THEN {attribute(lit('NULL'), none)}"
        f" WHEN {value}.M IS NOT NULL OR {value}.L IS NOT NULL THEN"
        f" {attribute(f'if({value}.M IS NOT NULL, {lit("M")}, {lit("L")})', nested)}"
        f" WHEN {value}.B IS NOT NULL THEN {attribute(lit('B'), value + '.B')}"
        f" WHEN {value}.SS IS NOT NULL THEN {attribute(lit('SS'), f'to_json({value}.SS)')}"
        f" WHEN {value}.NS IS NOT NULL THEN {attribute(lit('NS'), set_json(value))}"
        f" WHEN {value}.BS IS NOT NULL THEN {attribute(lit('BS'), f'to_json({value}.BS)')}"
        f" ELSE {attribute(none, none)} END"
    )


def attr(name: str) -> str:
    """Decoded attribute of that name; null when the record does not carry it."""
    return f"try_element_at(attrs, {lit(name)})"


def has(name: str) -> str:
    """True when the record carries the attribute, even as a null."""
    return f"map_contains_key(attrs, {lit(name)})"


def text_of(attribute: str, *tags: str) -> str:
    """Text of an attribute that has one of these tags."""
    return f"CASE WHEN {attribute}.tag IN ({lits(tags)}) THEN {attribute}.text END"


def as_json(attribute: str) -> str:
    """Plain JSON of a decoded attribute; numbers leave as doubles."""
    return (
        f"CASE WHEN {attribute}.tag IN ('S', 'B') THEN {quote_field(attribute + '.text')}"
        f" WHEN {attribute}.tag = 'N' THEN {number(attribute + '.text')}"
        f" ELSE {attribute}.text END"
    )


def truthy(attribute: str) -> str:
    """False for missing, null, empty, zero and false values; true for the rest."""
    return (
        f"coalesce(CASE {attribute}.tag"
        f" WHEN 'N' THEN try_cast({attribute}.text AS DOUBLE) <> 0"
        f" WHEN 'BOOL' THEN {attribute}.text = 'true'"
        f" WHEN 'NULL' THEN false"
        f" ELSE {attribute}.text NOT IN ('', '{{}}', '[]') END, false)"
    )


def record_json(
    drop: tuple[str, ...] = (),
    overrides: dict[str, Callable[[str], str]] | None = None,
    rename: dict[str, str] | None = None,
) -> str:
    """JSON of the whole record without some keys, some values replaced, some keys renamed.

    An override sees the decoded attribute and applies only where the key is present.
    A renamed key moves to the end and replaces a key that already has the new name.
    """
    overrides, rename = overrides or {}, rename or {}
    value = as_json("e.value")
    if overrides:
        cases = "".join(
            f" WHEN {lit(name)} THEN {replace('e.value')}" for name, replace in overrides.items()
        )
        value = f"CASE e.key{cases} ELSE {value} END"

    kept = "map_entries(attrs)"
    if drop or rename:
        hidden = [f"e.key NOT IN ({lits((*drop, *rename))})"]
        hidden += [f"NOT ({has(old)} AND e.key = {lit(new)})" for old, new in rename.items()]
        kept = f"filter({kept}, e -> {' AND '.join(hidden)})"
    entries = f"transform({kept}, e -> named_struct('key', e.key, 'json', {value}))"
    moved = [
        f"if({has(old)}, array(named_struct('key', {lit(new)}, 'json', {as_json(attr(old))})),"
        f" CAST(array() AS array<struct<key:string,json:string>>))"
        for old, new in rename.items()
    ]
    return json_object_of(f"concat({', '.join([entries, *moved])})" if moved else entries)
