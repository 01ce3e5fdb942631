"""ledgerferry: replay a change stream of one system into another, set-at-a-time on Spark."""

import sys

from pyspark import cloudpickle

from ledgerferry.config import MigrationConfig
from ledgerferry.plans.entities import EntitySpec, ForeignKey
from ledgerferry.plans.flow import BatchResult, run_batch
from ledgerferry.plans.registry import Children, EntityRegistry
from ledgerferry.sources.ledger import LedgerStore
from ledgerferry.streaming.driver import preview, start_migration

# The few functions that run inside Python tasks travel with the job, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "BatchResult",
    "Children",
    "EntityRegistry",
    "EntitySpec",
    "ForeignKey",
    "LedgerStore",
    "MigrationConfig",
    "preview",
    "run_batch",
    "start_migration",
]
