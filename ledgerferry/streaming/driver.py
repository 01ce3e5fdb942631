"""The micro-batch job: a stream of changes in, ledger versions out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerferry.config import MigrationConfig
from ledgerferry.operators.deliver import OpenTransport
from ledgerferry.plans.flow import BatchResult, run_batch
from ledgerferry.plans.registry import DEFAULT, EntityRegistry
from ledgerferry.sources.ledger import FANOUT, LedgerStore
from ledgerferry.sources.storage import write_once

# Batch interval, and rows a preview shows.
BATCH_INTERVAL = "100 seconds"
PREVIEW_ROWS = 20
# Committed batches whose intermediates are kept.
KEEP_BATCHES = 10


def write_reports(store: LedgerStore, result: BatchResult) -> None:
    """What a batch could not process, as tables below `reports`, before anything is removed."""
    tables = {
        "quarantine": result.quarantine(),
        "unrouted": result.unrouted(),
        "unresolved": result.unresolved(),
    }
    for kind, rows in tables.items():
        if rows is not None:
            write_once(rows, f"{store.root}/reports/{kind}/batch={result.batch_id}")


def preview(changes: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First rows of a raw batch; nothing is delivered or recorded."""
    return changes.limit(n)


def start_migration(
    changes: DataFrame,
    store: LedgerStore,
    open_transport: OpenTransport,
    checkpoint: str,
    config: MigrationConfig | None = None,
    available_now: bool = False,
    on_batch: Callable[[BatchResult], None] | None = None,
    fanout: int = FANOUT,
    keep_batches: int = KEEP_BATCHES,
    registry: EntityRegistry = DEFAULT,
) -> StreamingQuery:
    """Start the job. An error in a batch fails the query, so that no batch is lost: a
    restart with the same checkpoint runs the failed batch again under the same id.

    Quarantined, unrouted and unresolved records are written as tables, before `on_batch` sees
    the result; then runs of the ledger are merged, `fanout` of a level at a time (0: never), and
    intermediates of older batches are removed."""

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        result = run_batch(batch, batch_id, store, open_transport, config, registry=registry)
        write_reports(store, result)
        if on_batch:
            on_batch(result)
        store.merge(fanout)
        store.clean(keep_batches)

    writer = changes.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
    return writer.trigger(**trigger).start()
