"""Scalar conversions. Bad input gives null, never an error."""

from __future__ import annotations

from ledgerferry.functions.jsontext import lit, lits

# Words read as true, accepted date syntax, whitespace.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?Z*$"
WHITESPACE = " \t\n\r\f\x0b"


def strip(text: str) -> str:
    """Text without surrounding whitespace of any kind."""
    return f"btrim({text}, {lit(WHITESPACE)})"


def to_boolean(text: str) -> str:
    """Null or blank text -> null, a true word in any case -> true, other text -> false."""
    return (
        f"CASE WHEN {strip(text)} <> '' THEN lower({strip(text)}) IN ({lits(TRUE_WORDS)}) END"
    )


def to_epoch_seconds(text: str) -> str:
    """ISO date or date-time, read as UTC -> epoch seconds, truncated toward zero.

    Computed from the fields, so that the session time zone has no say in it.
    """

    def field(start: int) -> str:
        # An absent field is nulled first: a failing cast costs an exception per row.
        return f"coalesce(try_cast(nullif(substring({text}, {start}, 2), '') AS INT), 0)"

    hour, minute, second = field(12), field(15), field(18)
    days = f"unix_date(try_cast(substring({text}, 1, 10) AS DATE))"
    seconds = f"CAST({days} AS BIGINT) * 86400 + {hour} * 3600 + {minute} * 60 + {second}"
    # A fraction before 1970 moves the second up, toward zero.
    has_fraction = f"{text} RLIKE {lit(r'\.\d*[1-9]')}"
    return (
        f"CASE WHEN {text} RLIKE {lit(DATE_PATTERN)} AND NOT startswith({text}, '0000')"
        f" AND {hour} < 24 AND {minute} < 60 AND {second} < 60"
        f" THEN {seconds} + CASE WHEN {has_fraction} AND {days} < 0 THEN 1 ELSE 0 END END"
    )


def to_string_array(text: str) -> str:
    """`"[1444, 1548]"` -> `["1444","1548"]`; null -> empty array."""
    inner = f"replace(btrim({text}, '[]'), ' ', '')"
    return f"coalesce(filter(split({inner}, ','), x -> x <> ''), CAST(array() AS array<string>))"


def truncated(text: str) -> str:
    """Decimal text -> bigint without its fraction."""
    return f"try_cast(try_cast({text} AS DECIMAL(38,18)) AS BIGINT)"


def integral(text: str) -> str:
    """Integral text -> bigint; null for a text with a fraction."""
    return f"CASE WHEN {strip(text)} RLIKE {lit(r'^[+-]?\d+$')} THEN try_cast({strip(text)} AS BIGINT) END"


def to_integer(attribute: str) -> str:
    """Integer of a decoded attribute: numbers are truncated, text must be integral."""
    return (
        f"CASE {attribute}.tag WHEN 'N' THEN {truncated(attribute + '.text')}"
        f" WHEN 'S' THEN {integral(attribute + '.text')}"
        f" WHEN 'BOOL' THEN CAST(if({attribute}.text = 'true', 1, 0) AS BIGINT) END"
    )


def ledger_key(result: str, key: str) -> str:
    """`success#<key>` or `failed#<key>`."""
    return f"concat({lit(result + '#')}, {key})"


def storage_path(base: str, path: str) -> str:
    """`<base>/<path>`; null when there is no path."""
    return f"concat({lit(base.rstrip('/') + '/')}, {path})"


def not_found_message(entity: str, key: str) -> str:
    """Failure text of a required lookup that found nothing."""
    return f"concat({lit(f'v2_not_found:{entity}:')}, coalesce({key}, ''))"


def priority_of(text: str, priority: tuple[str, ...]) -> str:
    """1-based place in a priority list; one past the end when unknown or null."""
    place = f"array_position(array({lits(priority)}), lower({text}))"
    return f"CAST(coalesce(nullif({place}, 0), {len(priority) + 1}) AS INT)"
