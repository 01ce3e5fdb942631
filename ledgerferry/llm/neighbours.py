"""Nearest neighbours by a block matrix join of int8 tiles.

Query rows and candidate rows are dealt into blocks; each task gets one block of queries and one
of candidates. Tiles of the two are multiplied as int8 numbers. With s the scale and q the whole
numbers of a vector x, the part lost is e = x - s q, and

    | |x - y| - |s q - s' q'| | <= |e| + |e'| .

A pair whose lower bound exceeds the k-th least upper bound seen for its query cannot be among the
k nearest; all others are computed again from the original vectors in double precision. Heaps
keep the k best of each query, in a task and then over all tasks. The result is exact.

Defined results: vectors null, empty, zero or with null or non-finite parts take no part; vectors are
compared with those of the same length; rows that share an id count once, with the least vector in
byte order; ties go to the smaller id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.vectors import one_each, valid_vectors

K = 10
EVERY = 100
#: Rows of a block of queries and of candidates (what one task holds), and of a tile.
QUERY_BLOCK, CANDIDATE_BLOCK = 16_384, 8_192
TILE_Q, TILE_C = 256, 4_096
#: Bounds are widened by this share against rounding.
SLACK = 1e-9


class Quantised:
    """Vectors as int8 numbers with a scale each, and the length of what was lost."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(1) / 127
        # Products of int8 numbers and their sums are whole numbers below 2 ** 24 up to 1,040
        # dimensions, so float32 tiles hold them exactly; beyond, float64 does.
        self.q = np.rint(x / self.scale[:, None]).astype(np.int8)
        whole = self.q * self.scale[:, None]
        self.lost = np.sqrt(((x - whole) ** 2).sum(1))
        self.square = (whole**2).sum(1)
        self.tile = np.float32 if x.shape[1] <= 1_000 else np.float64

    def distance(self, rows: slice, other: Quantised, others: slice) -> np.ndarray:
        dot = self.q[rows].astype(self.tile) @ other.q[others].astype(self.tile).T
        scales = self.scale[rows, None] * other.scale[others]
        return np.sqrt(np.maximum(self.square[rows, None] + other.square[others] - 2 * dot * scales, 0))


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, part by part in double precision."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += (x[:, k] - y[:, k]) ** 2
    return np.sqrt(total)


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """(query, id, distance): the k best rows of one block for each query."""
    a, b, out = Quantised(queries), Quantised(rows), []
    for qs in range(0, len(queries), TILE_Q):
        part = slice(qs, min(qs + TILE_Q, len(queries)))
        n = part.stop - part.start
        heaps: list[list[tuple]] = [[] for _ in range(n)]
        limit = np.full((n, k), np.inf)  # the least upper bounds so far
        for cs in range(0, len(rows), TILE_C):
            tile = slice(cs, min(cs + TILE_C, len(rows)))
            d = a.distance(part, b, tile)
            lost = a.lost[part, None] + b.lost[tile]
            own = query_ids[part, None] == ids[tile]
            upper = np.where(own, np.inf, (d + lost) * (1 + SLACK) + SLACK)
            limit = np.partition(np.concatenate([limit, upper], 1), k - 1, axis=1)[:, :k]
            i, j = np.nonzero(((d - lost) * (1 - SLACK) - SLACK <= limit.max(1)[:, None]) & ~own)
            for q, c, dist in zip(i.tolist(), ids[cs + j].tolist(), exact(queries[qs + i], rows[cs + j]).tolist(), strict=True):
                # The heap's first is the worst kept: farthest, then of the largest id.
                if len(heaps[q]) < k:
                    heapq.heappush(heaps[q], (-dist, -c))
                elif (-dist, -c) > heaps[q][0]:
                    heapq.heapreplace(heaps[q], (-dist, -c))
        out += [(int(query_ids[qs + q]), -c, -d) for q, heap in enumerate(heaps) for d, c in heap]
    return out


def nearest(df: DataFrame, is_query: str, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every row for which `is_query` holds.

    `is_query` is a condition on the column `id`.
    """
    rows = valid_vectors(df, id_col, vector_col)
    n = df.select(F.col(id_col).alias("id")).agg(F.count("*").alias("all"), F.count(F.when(F.expr(is_query), 1)).alias("queries")).first()
    many = max(1, -(-n["queries"] // QUERY_BLOCK))
    parts = max(1, -(-n["all"] // CANDIDATE_BLOCK))
    place = lambda salt, count: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(count)).cast("int")
    queries = rows.where(is_query).withColumn("i", place("query", many)).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    candidates = rows.withColumn("j", place("row", parts)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = search_block(*one_each(left["id"].tolist(), left["vector"].tolist()), *one_each(right["id"].tolist(), right["vector"].tolist()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True))
        for query, own in groupby(rows, key=lambda row: row[0]):
            best = heapq.nsmallest(k, ((score, vec) for _, vec, score in own))
            yield pa.record_batch(
                [pa.array([query] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([v for _, v in best], pa.int64()), pa.array([s for s, _ in best], pa.float64())],
                ["query_id", "rank", "vec_id", "score"],
            )

    key = ["dim", "i", "j"]
    found = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(block, "query_id long, vec_id long, score double")
    ordered = found.repartition("query_id").sortWithinPartitions("query_id")
    return ordered.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
