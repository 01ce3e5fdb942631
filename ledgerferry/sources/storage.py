"""Written tables: where intermediate results go and how a finished one is recognised."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`.

    Only where it is unset and Spark runs inside one process, as in tests, a folder of its
    own takes its place; executors elsewhere would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_scratch(spark.sparkContext.applicationId)


@cache
def _own_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerferry-{application_id}-")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(rows: DataFrame, directory: str | None = None) -> DataFrame:
    """Write below `directory` and read back, so that later plans neither grow nor recompute."""
    spark = rows.sparkSession
    path = f"{directory}/cut-{uuid.uuid4().hex}" if directory else new_scratch_path(spark, "cut")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    jvm_path, fs = _path(spark, path)
    fs.create(jvm_path, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm_path, fs = _path(spark, path)
    out = fs.create(jvm_path, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    jvm_path, fs = _path(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; empty when there is none."""
    jvm_path, fs = _path(spark, path)
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))


def remove(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _path(spark, path)
    fs.delete(jvm_path, True)


def write_table(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_once(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table unless a finished one is there already, and read it back.

    The marker lies beside the table and is written after all tasks committed. A step with a
    side effect that was finished before a crash is thus not repeated after it. Overwriting
    is static whatever the session says: what a crash left behind goes.
    """
    spark = rows.sparkSession
    if not exists(spark, f"{path}.done"):
        write_table(rows, path, partition_by)
        mark(spark, f"{path}.done")
    return spark.read.schema(rows.schema).parquet(path)
