"""The latest version of every key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, *values: str) -> DataFrame:
    """Latest row per (pk, sk), with the wanted columns only.

    An aggregate rather than a window: versions of one key are combined before the
    shuffle, so a key that makes up a large part of the rows costs no more than others.
    """
    wanted = [c for c in (values or rows.columns) if c not in ("pk", "sk")]
    tie = [c for c in ("payload", "v2_value") if c in wanted]
    return (
        rows.groupBy("pk", "sk")
        .agg(
            F.expr(
                f"max_by(struct({', '.join(wanted)}),"
                f" struct({', '.join(['batch_id', 'seq', *tie])}))"
            ).alias("row")
        )
        .selectExpr("pk", "sk", *[f"row.{c} AS {c}" for c in wanted])
    )
