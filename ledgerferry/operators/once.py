"""Computing an expensive expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerferry.functions.jsontext import lit

HELD = "__once"


def once(rows: DataFrame, where: str = "", **columns: str) -> DataFrame:
    """Add columns that later steps use as they are.

    A projected expression is copied into every filter that is pushed below it and into
    every expression that refers to it. What a generator produces is not: it is computed
    once, for the columns and filters above it alike. The expressions themselves stand in a
    projection below the generator, which is compiled; a generator's own arguments are
    interpreted. It is an outer one, as others get a filter on their argument, which would be
    a second copy. `where` is a condition on the new columns; rows that fail it are dropped.
    """
    fields = ", ".join(f"{lit(name)}, {value}" for name, value in columns.items())
    held = rows.selectExpr("*", f"array(named_struct({fields})) AS {HELD}")
    kept = [f"`{name}`" for name in rows.columns]
    added = held.selectExpr(*kept, f"inline_outer({HELD})")
    return added.filter(where) if where else added
