"""Reading change records, as a stream or at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerferry.schemas import ENVELOPE


def stream_json(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of JSON envelopes from the earliest file on. Any other Spark streaming
    source that delivers the envelope columns does as well."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)
