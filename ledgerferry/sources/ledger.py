"""The mapping ledger: a table of outcomes keyed by (pk, sk), latest row wins.

Each batch adds one run of rows, partitioned by pk and result so that a lookup of one entity's
successes reads nothing else. A run counts once its marker exists, so a half-written one is
never seen, and a replayed batch replaces its own run.

Runs are merged level by level: `fanout` runs of a level become one of the next, so a row is
written again once for each level, a logarithm of the number of batches. Merged runs are bucketed
by sk: a lookup of many keys joins them bucket by bucket, without a shuffle of the ledger. All
runs are sorted by sk and carry Bloom filters on it: a lookup of few keys skips the row groups,
and the buckets, that cannot hold them. Readers take runs that no other run covers.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerferry.functions.jsontext import lit, lits
from ledgerferry.operators.latest import latest
from ledgerferry.schemas import LEDGER
from ledgerferry.sources.storage import children, exists, mark, remove

PARTITIONS = ("pk", "result")
# Runs of a level that are merged into one, and buckets of a merged run.
FANOUT, BUCKETS = 8, 64
# Bytes of a row group, and the keys its Bloom filter is laid out for.
ROW_GROUP, BLOOM_KEYS = 32 << 20, 200_000
# Keys that go into the scan as literals; the parser of filters sees them in groups of GROUP.
POINT_KEYS, GROUP = 200, 10
# Keys of a lookup that are broadcast, some tens of MB; more are joined by key.
MAX_BROADCAST_KEYS = 200_000


@dataclass(frozen=True, order=True)
class Run:
    """Rows of the batches first to last, after `level` merges."""

    first: int
    last: int
    level: int = 0
    buckets: int = 0

    @property
    def name(self) -> str:
        if not self.level:
            return f"delta-{self.first:020d}"
        return f"run-{self.level}-{self.first:020d}-{self.last:020d}-{self.buckets}"

    @classmethod
    def parse(cls, name: str) -> Run:
        kind, *numbers = name.split("-")
        if kind == "delta":
            return cls(int(numbers[0]), int(numbers[0]))
        level, first, last, buckets = map(int, numbers)
        return cls(first, last, level, buckets)

    def covers(self, other: Run) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


@dataclass(frozen=True)
class LedgerView:
    """Ledger rows to look keys up in: plain frames, and bucketed tables. `scratch` is where
    lookups may write."""

    frames: list[DataFrame]
    tables: list[DataFrame] = field(default_factory=list)
    scratch: str | None = None

    def plus(self, *frames: DataFrame) -> LedgerView:
        return LedgerView([*self.frames, *frames], self.tables, self.scratch)

    def rows(self) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b), [f.select(*LEDGER.names) for f in (*self.frames, *self.tables)])

    def successes(self, asked: DataFrame, n_asked: int, value: str, entities: tuple[str, ...] | None = None) -> DataFrame:
        """Rows (pk, sk, value, seq, batch_id) of successes whose (pk, sk) is among `asked`, whose
        entities are among `entities` if these are given: rows of others are not shuffled.

        Few keys become literals of the scan, more a broadcast; beyond MAX_BROADCAST_KEYS the
        bucketed tables are joined where they lie, entity by entity.
        """
        columns = ["pk", "sk", value, "seq", "batch_id"]
        wanted = "result = 'success'" + (f" AND pk IN ({lits(entities)})" if entities else "")
        frames, tables = ([f.filter(wanted).select(*columns) for f in side] for side in (self.frames, self.tables))
        if n_asked <= POINT_KEYS:
            keys: dict[str, list[str]] = {}
            for row in asked.select("pk", "sk").collect():
                keys.setdefault(row["pk"], []).append(row["sk"])
            found = [f.filter(among(keys)) for f in (*frames, *tables)]
        elif n_asked <= MAX_BROADCAST_KEYS:
            few = F.broadcast(asked)
            found = [f.join(few, ["pk", "sk"], "left_semi") for f in (*frames, *tables)]
        else:
            found = [f.join(asked, ["pk", "sk"], "left_semi") for f in frames]
            named = [r["pk"] for r in asked.select("pk").distinct().collect()] if tables else []
            for entity in named:
                own = asked.filter(f"pk = {lit(entity)}").select("sk")
                found += [t.filter(f"pk = {lit(entity)}").join(own, "sk", "left_semi") for t in tables]
        return reduce(lambda a, b: a.unionByName(b), [f.select(*columns) for f in found])


def among(keys: dict[str, list[str]]) -> str:
    """Condition on (pk, sk), in groups that the scan hands on to the file format as equalities."""
    entities = []
    for entity, own in sorted(keys.items()):
        groups = [f"sk IN ({lits(tuple(own[i : i + GROUP]))})" for i in range(0, len(own), GROUP)]
        entities.append(f"(pk = {lit(entity)} AND ({' OR '.join(groups)}))")
    return " OR ".join(entities) or "false"


def as_view(ledger_rows: DataFrame | LedgerView) -> LedgerView:
    return ledger_rows if isinstance(ledger_rows, LedgerView) else LedgerView([ledger_rows])


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def batch_dir(self, batch_id: int) -> str:
        return f"{self.root}/batches/{batch_id:020d}"

    def _marker(self, run: Run) -> str:
        return f"{self.root}/markers/{'run' if run.level else 'delta'}/{run.name}"

    def _data(self, run: Run) -> str:
        return f"{self.root}/data/version={run.name}"

    def _runs(self, kind: str) -> list[Run]:
        return sorted(map(Run.parse, children(self.spark, f"{self.root}/markers/{kind}")))

    def is_committed(self, batch_id: int) -> bool:
        return exists(self.spark, self._marker(Run(batch_id, batch_id)))

    def runs(self, before: int | None = None) -> list[Run]:
        """The committed runs that readers take, oldest first: those that no other one covers."""
        merged = self._runs("run")
        known = [r for r in (*self._runs("delta"), *merged) if before is None or r.last < before]
        return sorted(r for r in known if not any(m.covers(r) for m in known if m.level))

    def view(self, before: int | None = None, scratch: str | None = None) -> LedgerView:
        """All committed rows, several versions of a key included."""
        runs = self.runs(before)
        deltas = [self._data(r) for r in runs if not r.level]
        reader = self.spark.read.schema(LEDGER).option("basePath", f"{self.root}/data")
        small = reader.parquet(*deltas) if deltas else self.spark.createDataFrame([], LEDGER)
        return LedgerView([small.select(*LEDGER.names)], [self._table(r) for r in runs if r.level], scratch)

    def rows(self, before: int | None = None) -> DataFrame:
        return self.view(before).rows()

    def current(self, *values: str) -> DataFrame:
        """Latest row of every key, whole or with some of its columns."""
        return latest(self.rows(), *values).select("pk", "sk", *values) if values else latest(self.rows()).select(*LEDGER.names)

    def commit(self, batch_id: int, rows: DataFrame) -> None:
        """Upsert a batch's outcome rows: whole-row replace by (pk, sk)."""
        run = Run(batch_id, batch_id)
        # The aggregate's shuffle hashes (pk, sk), so it evens out file sizes and splits an entity
        # that dominates the batch; the session merges small partitions.
        writer = latest(rows).select(*LEDGER.names).sortWithinPartitions(*PARTITIONS, "sk").write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*PARTITIONS)
        writer.options(**bloom()).parquet(self._data(run))
        mark(self.spark, self._marker(run))

    def merge(self, fanout: int = FANOUT) -> list[Run]:
        """Merge the oldest `fanout` runs of every level that has so many; the runs made."""
        made: list[Run] = []
        level = 0
        while level <= max((r.level for r in self.runs()), default=-1):
            own = [r for r in self.runs() if r.level == level][:fanout]
            if fanout > 1 and len(own) == fanout:
                made.append(self._merge(own))
            else:
                level += 1
        return made

    def compact(self) -> None:
        """Merge everything committed so far into one run."""
        runs = self.runs()
        if runs and (len(runs) > 1 or not runs[0].level):
            self._merge(runs)

    def _merge(self, runs: list[Run]) -> Run:
        run = Run(runs[0].first, runs[-1].last, max(r.level for r in runs) + 1, self.buckets)
        reader = self.spark.read.schema(LEDGER)
        parts = [reader.option("basePath", self._data(r)).parquet(self._data(r)).select(*LEDGER.names) for r in runs]
        rows = latest(reduce(lambda a, b: a.unionByName(b), parts)).select(*LEDGER.names)
        # One task for each bucket, by the hash that bucketing goes by.
        spread = rows.repartition(run.buckets, "sk").write.format("parquet").mode("overwrite")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(run)}")
        writer = spread.bucketBy(run.buckets, "sk").sortBy("sk").options(**bloom())
        writer.option("path", self._data(run)).saveAsTable(self._name(run))
        mark(self.spark, self._marker(run))
        return run

    def _name(self, run: Run) -> str:
        """The catalog's name of a merged run: the bucket layout is known to Spark by it alone."""
        return f"ledger_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}_{re.sub('-', '_', run.name)}"

    def _table(self, run: Run) -> DataFrame:
        """A merged run with its buckets. A session that has not made it registers the files."""
        name = self._name(run)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet"
                f" CLUSTERED BY (sk) SORTED BY (sk) INTO {run.buckets} BUCKETS LOCATION {lit(self._data(run))}"
            )
        return self.spark.table(name).select(*LEDGER.names)

    def clean(self, keep: int) -> None:
        """Remove what committed batches no longer need, but for the last `keep` of them.

        That is their intermediate tables, and runs that others cover. Markers of batches stay,
        so a batch that was committed is known as such for good.
        """
        deltas, shown = self._runs("delta"), set(self.runs())
        for run in deltas[: -keep or None]:
            remove(self.spark, self.batch_dir(run.first))
            if run not in shown:
                remove(self.spark, self._data(run))
        for run in self._runs("run"):
            if run not in shown:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(run)}")
                remove(self.spark, self._data(run))
                remove(self.spark, self._marker(run))


def bloom() -> dict[str, str]:
    """Options of the file format for keys that can be skipped to."""
    return {
        "parquet.block.size": str(ROW_GROUP),
        "parquet.bloom.filter.enabled#sk": "true",
        "parquet.bloom.filter.expected.ndv#sk": str(BLOOM_KEYS),
        "parquet.enable.dictionary#sk": "false",
    }


def outcome_count(rows: DataFrame) -> DataFrame:
    """Rows per entity and result."""
    return rows.groupBy("pk", "result").agg(F.count(F.lit(1)).alias("n"))
