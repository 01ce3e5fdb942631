"""Running aggregates over ordered keyed rows that survive a hot key.

A plain window puts all rows of one key in one task. Here the rows of keys that have more
than `max_rows` are range-partitioned by key, order and a tie-break, and cut into pieces of at
most `max_rows`. Each piece runs its own window; what earlier pieces of a key carry over is
computed from one row per piece: a prefix scan in two levels. Keys below the bound, which is all
of them in ordinary data, take the plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerferry.sources.storage import cut

MAX_ROWS_PER_TASK = 5_000_000
PIECE = "__piece"
TIE = "__tie"
SPOT = "__spot"


@dataclass(frozen=True)
class Ordered:
    """Rows ready for running aggregates; `pieces` is False when no key is hot."""

    rows: DataFrame
    key: str
    order: str
    pieces: bool

    @property
    def group(self) -> list[str]:
        return [self.key, PIECE] if self.pieces else [self.key]

    def window(self, *, preceding_only: bool = False, descending: bool = False) -> WindowSpec:
        # Nulls come first, and last when descending; equal orders follow the rows' hash.
        columns = [self.order, TIE] if TIE in self.rows.columns else [self.order]
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in columns]
        return (
            Window.partitionBy(*self.group)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1 if preceding_only else Window.currentRow)
        )

    def with_rows(self, rows: DataFrame) -> Ordered:
        return Ordered(rows, self.key, self.order, self.pieces)


def ordered(
    rows: DataFrame, key: str, order: str, max_rows: int = MAX_ROWS_PER_TASK
) -> Ordered:
    """Measure the keys (counts combine before the shuffle) and cut the hot ones.

    Ranges are sampled over (key, order, hash of the row, number of the row), so equal and null
    orders are cut as well, and rows that are alike in all but the last. A range's rows are then
    numbered, and every `max_rows` of them begin a piece: the bound holds exactly, however uneven
    the ranges are. Nulls sort first. The pieces are written before they are used, so that no
    task that runs again cuts otherwise.
    """
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    rows = rows.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    hot = cut(
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    ).select(F.col(key).alias("__hot_key"), "n")
    total = hot.agg(F.sum("n")).first()[0]
    if not total:
        return Ordered(rows, key, order, False)

    is_hot = rows[key].eqNullSafe(hot["__hot_key"])
    ranges = -(-2 * total // max_rows)
    place = [F.col(key).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col(TIE), F.col(SPOT)]
    spread = (
        rows.join(hot, is_hot, "left_semi")
        .withColumn(SPOT, F.monotonically_increasing_id())
        .repartitionByRange(ranges, *place)
        .withColumn("__range", F.spark_partition_id())
    )
    number = F.row_number().over(Window.partitionBy("__range").orderBy(*place))
    # Pieces of a key ascend with its order: first by range, then within it.
    piece = F.col("__range") * F.lit(1 << 32) + F.floor((number - 1) / max_rows) + 1
    pieced = cut(cut(spread).withColumn(PIECE, piece.cast("long")).drop("__range", SPOT))
    calm = rows.join(hot, is_hot, "left_anti").withColumn(PIECE, F.lit(0).cast("long"))
    return Ordered(calm.unionByName(pieced), key, order, True)


def carry(
    data: Ordered,
    columns: dict[str, tuple[Column, Callable[[Column], Column], Callable[[Column, Column], Column]]],
    *,
    preceding_only: bool = False,
    descending: bool = False,
) -> DataFrame:
    """Add running aggregates.

    `columns` maps an output name to (row expression, aggregate, combine). The aggregate
    must be associative; `combine(carried, local)` joins what earlier pieces carry over
    with the piece's own running value (either may be null).
    """
    w = data.window(preceding_only=preceding_only, descending=descending)
    local = data.rows.select(
        "*", *[agg(value).over(w).alias(name) for name, (value, agg, _) in columns.items()]
    )
    if not data.pieces:
        return local

    totals = (
        data.rows.filter(F.col(PIECE) > 0)
        .groupBy(*data.group)
        .agg(*[agg(value).alias(name) for name, (value, agg, _) in columns.items()])
    )
    order = F.col(PIECE).desc() if descending else F.col(PIECE).asc()
    before = Window.partitionBy(data.key).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = totals.select(
        F.col(data.key).alias("__key"),
        F.col(PIECE).alias("__at"),
        *[
            agg(F.col(name)).over(before).alias(f"__carried_{name}")
            for name, (_, agg, _) in columns.items()
        ],
    )
    joined = local.join(
        carried,
        local[data.key].eqNullSafe(carried["__key"]) & (local[PIECE] == carried["__at"]),
        "left",
    )
    kept = [c for c in local.columns if c not in columns]
    return joined.select(
        *[local[c] for c in kept],
        *[
            combine(F.col(f"__carried_{name}"), local[name]).alias(name)
            for name, (_, _, combine) in columns.items()
        ],
    )
