"""SQL expressions that assemble JSON text.

All functions of this package take SQL expressions as text and return one, for
`selectExpr` and `expr`: a payload is one long expression, and handing it to Spark as a
whole costs one call instead of thousands of column operations on the driver.

Payloads are built from attributes whose names and types differ from record to record,
so they are assembled from typed text fragments rather than from a fixed struct. A SQL
null fragment stands for a JSON null.
"""

from __future__ import annotations


def lit(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(texts: tuple[str, ...]) -> str:
    """Comma-separated SQL string literals."""
    return ", ".join(lit(t) for t in texts)


def quote(text: str) -> str:
    """JSON string of a text; JSON null for null."""
    # Only the array's own brackets can be trimmed: a string fragment ends in quotes.
    return f"btrim(to_json(array({text})), '[]')"


# What JSON escapes in a string.
ESCAPED = lit(r'["\\\x00-\x1f]')


def quote_field(name: str) -> str:
    """The same as `quote`, for a column or field: most texts hold nothing to escape, and a
    look at them costs a tenth of writing JSON. `name` is evaluated several times."""
    return (
        f"CASE WHEN {name} IS NULL THEN 'null' WHEN {name} RLIKE {ESCAPED} THEN {quote(name)}"
        f" ELSE concat('\"', {name}, '\"') END"
    )


def number(text: str) -> str:
    """JSON number of a decimal text, as a double."""
    return f"CAST(try_cast({text} AS DOUBLE) AS STRING)"


def json_object(fields: dict[str, str]) -> str:
    """JSON object of named fragments; null fragments keep their key."""
    parts = []
    for i, (name, value) in enumerate(fields.items()):
        lead = "{" if i == 0 else ","
        parts.append(f"{lit(f'{lead}\"{name}\":')}, coalesce({value}, 'null')")
    return f"concat({', '.join(parts)}, '}}')"


def json_object_of(entries: str) -> str:
    """JSON object of an array<struct<key, json>>."""
    member = f"concat({quote_field('f.key')}, ':', coalesce(f.json, 'null'))"
    return f"concat('{{', array_join(transform({entries}, f -> {member}), ','), '}}')"


def json_array_of(items: str) -> str:
    """JSON array of an array<string> of fragments."""
    return f"concat('[', array_join({items}, ',', 'null'), ']')"
