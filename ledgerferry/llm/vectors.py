"""Rows of vectors as bytes, and as numpy matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 2_048


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector) of the rows whose vector takes part: vector as little-endian doubles.

    Left out are null ids and vectors that are null, empty, zero, or hold null or non-finite parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                ids, dims, out = [], [], []
                part = batch.slice(start, SLICE)
                column = part.column(1)
                # One conversion for all values; offsets cut it into vectors.
                values = column.flatten().cast(pa.float64())
                numbers = values.to_numpy(zero_copy_only=False)
                lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                for i, (doc, n, end) in enumerate(zip(part.column(0).to_pylist(), lengths, ends, strict=True)):
                    v = numbers[end - n : end]
                    if doc is not None and n and np.isfinite(v).all() and v.any():
                        ids.append(doc)
                        dims.append(int(n))
                        out.append(v.astype("<f8").tobytes())
                yield pa.record_batch([pa.array(ids, part.column(0).type), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["id", "dim", "vector"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    return rows.mapInArrow(run, f"id {kind}, dim int, vector binary")


def matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def one_each(ids: list, vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows by id; of rows that share an id the one with the least bytes counts."""
    best: dict = {}
    for i, v in zip(ids, vectors, strict=True):
        if i not in best or v < best[i]:
            best[i] = v
    order = sorted(best)
    return np.array(order), matrix([best[i] for i in order])
