"""Contacts as a keyed state: each contact's accepted payload is kept by the stream itself.

The batch flow looks a contact's state up in the ledger for every batch. Here the state store holds
it, one payload for each contact, and a micro-batch touches the contacts it brings only. State and
offsets are one checkpoint: a batch that failed is run again from the state before it, and asks the
journal of its requests for the answers it has had already.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerferry.config import MigrationConfig
from ledgerferry.operators.decode import accepted, decode
from ledgerferry.operators.deliver import OpenTransport, Sender, send_contact
from ledgerferry.operators.merge import Contact
from ledgerferry.operators.outbox import outbox_path
from ledgerferry.plans.entities import SPECS, build_requests
from ledgerferry.plans.outcomes import ledger_rows, settle
from ledgerferry.schemas import DELIVERY, REQUEST
from ledgerferry.sources.ledger import LedgerStore
from ledgerferry.streaming.driver import BATCH_INTERVAL

DELIVERED = T.StructType([*REQUEST.fields, *DELIVERY.fields])


def contact_requests(changes: DataFrame, entity: str = "contact", config: MigrationConfig | None = None) -> DataFrame:
    """Requests of the contact records of a stream or batch of changes."""
    records = accepted(decode(changes)).filter(F.col("pk") == entity)
    return build_requests(records, SPECS[entity], config or MigrationConfig())


def deliver_with_state(
    requests: DataFrame, open_transport: OpenTransport, max_attempts: int = 2, outbox: str | None = None
) -> DataFrame:
    """Merge and send a stream of contact requests; columns as `deliver` gives them.

    Of a micro-batch, a contact's requests go in the order of `seq`; requests that cannot be sent
    are spread by their order number, so that rows without a key do not meet in one group. Journals
    go below the folder `outbox`, batch by batch.
    """
    opened: list = []

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if not opened:
            batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
            opened.append(Sender(open_transport, max_attempts, f"{outbox}/{batch}" if outbox else None))
        rows = [json.loads(text) for part in parts for text in part["request"]]
        rows.sort(key=lambda r: (r.get("seq") is not None, r.get("seq") or 0, r.get("sk") or "", r.get("payload") or ""))
        now = Contact.of(json.loads(state.get[0])) if state.exists else None
        out = []
        for row in rows:
            delivered, now = send_contact({f: row.get(f) for f in REQUEST.names}, now, opened[0])
            out.append(json.dumps(delivered, ensure_ascii=False))
        if now is not None:
            state.update((now.text,))
        yield pd.DataFrame({"delivered": out})

    alone = "(failure IS NOT NULL OR reject_reason IS NOT NULL)"
    keyed = requests.select(
        F.expr(f"if({alone}, concat('\\u0000', seq), base_key)").alias("contact"),
        F.to_json(F.struct(*REQUEST.names), {"ignoreNullFields": "false"}).alias("request"),
    )
    delivered = keyed.groupBy("contact").applyInPandasWithState(
        fold, "delivered string", "payload string", "append", GroupStateTimeout.NoTimeout
    )
    return delivered.select(F.from_json("delivered", DELIVERED).alias("d")).select("d.*")


def start_contacts(
    changes: DataFrame,
    store: LedgerStore,
    open_transport: OpenTransport,
    checkpoint: str,
    config: MigrationConfig | None = None,
    available_now: bool = False,
    on_log: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the job. Each micro-batch is evaluated once, into a table, and then committed to the
    ledger; one that is run again is evaluated again, since its state has to move."""
    config = config or MigrationConfig()

    def process(batch: DataFrame, batch_id: int) -> None:
        settled, path = settle(batch), f"{store.batch_dir(batch_id)}/log_contacts"
        settled.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        log = store.spark.read.schema(settled.schema).parquet(path)
        if not store.is_committed(batch_id):
            store.commit(batch_id, ledger_rows(log, batch_id))
        if on_log:
            on_log(log, batch_id)

    requests = contact_requests(changes, config=config)
    outbox = outbox_path(f"{store.root}/outbox/contacts") if config.outbox else None
    delivered = deliver_with_state(requests, open_transport, config.max_attempts, outbox)
    writer = delivered.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
    return writer.outputMode("append").trigger(**trigger).start()
