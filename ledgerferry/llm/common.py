"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Hashable, Iterator
from functools import cache
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
#: The module on which workers keep what they hold.
HELD = "ledgerferry_held"

#: Runs of letters, the words of the language and toxicity models.
WORD = re.compile(r"[^\W\d_]+")
#: Rows that a task holds as Python objects at a time.
SLICE = 256


#: Rows that Spark hands to Python at a time; texts may be long.
ARROW_ROWS = 512


def small_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batch size before texts go through Python."""
    conf = df.sparkSession.conf
    now = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df


def release() -> None:
    """Give freed memory back to the system, where the C library can.

    Workers are kept between tasks and the driver between jobs; what one of them needed for
    a while would otherwise count against the next.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _held() -> dict[str, dict[Hashable, object]]:
    """What a worker holds between tasks: by operator, then by the operator's own key.

    Functions travel to workers by value, and module variables with them, anew for each task. So this
    hangs on a module of its own that only the worker knows.
    """
    place = sys.modules.setdefault(HELD, types.ModuleType(HELD))
    return place.__dict__.setdefault("held", {})


def worker_held(owner: str, key: Hashable, make: Callable[[], T]) -> T:
    """A table or model that a worker keeps for the next task of the same operator.

    An operator holds one at a time. What other operators held is dropped when a task of this one begins.
    """
    own = _held().setdefault(owner, {})
    if key not in own:
        own.clear()
        own[key] = make()
    return own[key]


def drop_held(owner: str) -> None:
    """Drop what workers hold for other operators."""
    held = _held()
    others = [name for name in held if name != owner]
    for name in others:
        del held[name]
    if others:
        release()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that drops what other operators held, and gives memory back when it is done."""
    owner = run.__module__

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held(owner)
        yield from run(batches)
        release()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of few rows, so that long texts do not pile up in memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; an id of null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def bounded_sample(df: DataFrame, order: Column, rows: int) -> DataFrame:
    """At most `rows` rows, the first by `order`: the same rows however the table is laid out."""
    return df.orderBy(order).limit(rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerferry-{application}-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, the folder that driver and executors share.

    Only where that is unset and Spark runs inside one process, as in tests, a folder of its own
    takes its place.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own_dir(context.applicationId)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: what follows does not recompute it."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
