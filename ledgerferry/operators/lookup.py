"""Resolving old ids to new ids: point reads of the ledger as equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerferry.functions.jsontext import lit
from ledgerferry.functions.scalars import ledger_key, not_found_message
from ledgerferry.operators.latest import latest
from ledgerferry.sources.ledger import LedgerView, as_view
from ledgerferry.sources.storage import cut


def lookup(
    records: DataFrame,
    ledger_rows: DataFrame | LedgerView,
    value: str = "v2_value",
    **wanted: tuple[str, str],
) -> DataFrame:
    """Left join `records` to ledger success rows, one join per wanted column.

    `wanted` maps a new column to (entity, key expression); a blank key finds nothing. The keys
    asked for are written once, so that counting them does not compute the records again; by
    their number the ledger is read at points, shrunk by a broadcast, or joined by key where
    its buckets lie. What is shuffled is rows asked for, however large the ledger is. Records
    without a key get one that no ledger row has, and spread over all tasks.
    """
    view = as_view(ledger_rows)
    keys = {
        column: f"CASE WHEN {key} <> '' THEN {ledger_key('success', key)} END"
        for column, (_, key) in wanted.items()
    }
    plain = [f.name for f in records.schema if isinstance(f.dataType, T.AtomicType)]
    nothing = f"concat('\\u0000', pmod(xxhash64({', '.join(f'`{c}`' for c in plain) or '0'}), 4096))"
    pairs = ", ".join(
        f"named_struct('pk', {lit(entity)}, 'sk', {keys[column]})"
        for column, (entity, _) in wanted.items()
    )
    asked = records.selectExpr(f"inline(array({pairs}))").filter("sk IS NOT NULL").distinct()
    asked = cut(asked, view.scratch)
    entities = tuple(sorted({entity for entity, _ in wanted.values()}))
    found = latest(view.successes(asked, asked.count(), value, entities), value)
    joined = records.selectExpr(
        "*", *[f"coalesce({key}, {nothing}) AS key_{column}" for column, key in keys.items()]
    )
    for column, (entity, _) in wanted.items():
        answers = found.filter(f"pk = {lit(entity)}").selectExpr(
            f"sk AS key_{column}", f"{value} AS {column}"
        )
        joined = joined.join(answers, f"key_{column}", "left").drop(f"key_{column}")
    return joined


def require(
    records: DataFrame, entity: str, key: str, found: str, where: str = "true"
) -> DataFrame:
    """Set `failure` on records whose required lookup found nothing; the first one counts."""
    missing = (
        f"CASE WHEN coalesce({found}, '') = '' AND {where}"
        f" THEN {not_found_message(entity, key)} END"
    )
    if "failure" not in records.columns:
        return records.selectExpr("*", f"{missing} AS failure")
    return records.withColumn("failure", F.expr(f"coalesce(failure, {missing})"))


def attach_parent(children: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Give children what the parent's response said (equi-join on the parent's key).

    Children of a parent that was never sent have nothing to attach to and drop out.
    """
    return children.join(parents, on)


def chain_levels(
    nodes: DataFrame, node: str, leader: str, directory: str | None = None
) -> DataFrame:
    """Add `level`, how many leaders of the same table stand above a node, and the topmost
    one, `root` (the node itself at level 0).

    `node` is unique; a leader that is null or not in the table ends the chain. Nodes on
    or below a cycle get neither. Pointer doubling: a round replaces every pointer by
    its target's pointer, so a chain of n nodes takes log2(n) rounds, and finished nodes
    are not joined again. As long as a chain without a cycle is unfinished, every round
    finishes some node; a round that finishes none leaves only cycles. Rounds are cut by
    tables written below `directory`, so no plan grows with depth.
    """
    links = nodes.selectExpr(f"{node} AS node", f"{leader} AS up")
    known = links.selectExpr("node AS up", "true AS is_known")
    state = cut(
        links.join(known, "up", "left").selectExpr(
            "node",
            "if(is_known, up, NULL) AS up",
            "CAST(if(is_known, 1, 0) AS BIGINT) AS level",
            "if(is_known, NULL, node) AS root",
        ),
        directory,
    )
    active, before = state.agg(F.count("up")).first()[0], None
    while active and active != before:
        target = state.selectExpr("node AS up", "up AS next_up", "level AS more", "root")
        moved = (
            state.filter("up IS NOT NULL")
            .drop("root")
            .join(target, "up")
            .selectExpr("node", "next_up AS up", "level + more AS level", "root")
        )
        state = cut(state.filter("up IS NULL").unionByName(moved), directory)
        active, before = state.agg(F.count("up")).first()[0], active
    levels = state.selectExpr(f"node AS {node}", "if(up IS NULL, level, NULL) AS level", "root")
    return nodes.join(levels, node, "left")
