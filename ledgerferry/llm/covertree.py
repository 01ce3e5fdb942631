"""Near-duplicate vectors by dual traversal of cover trees.

Vectors are scaled to length one, where cosine c means distance sqrt(2 - 2 c). They are dealt into
blocks, and each block gets a cover tree once: nested levels of centres with halving radii,
every centre of a level also one of the next, every node with the largest distance to what lies
under it. For each pair of blocks both trees are walked together, level by level, and a pair of nodes
is dropped when its centres are farther apart than the threshold plus both covering radii.
What is left at the finest level is compared in double precision on the original vectors.

Pairs return link counts and one root for each linked vector, never pairs of vectors, so a large group
of near copies costs no more rows than it has members. Blocks are dealt by a hash of the id, so no
group of copies fills a task. A worker holds two blocks and a bounded number of node pairs, however many
blocks there are and however many node pairs are near. Trees are written once, and every task reads
those it compares from there, so that disk grows with the rows; comparisons grow with their square.

Defined results: vectors null, empty, zero or with null or non-finite parts link with nothing and are
their own component; so are rows with a null id, whose component is null; vectors link with those
of the same length only; rows that share an id link as that id's least vector in byte order and
give one row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import cut
from ledgerferry.llm.components import components
from ledgerferry.llm.vectors import one_each, valid_vectors

THRESHOLD = 0.95
#: Covering radii of the levels, coarse to fine, on the unit sphere.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Vectors of a block.
BLOCK = 4_096
CHUNK = 1_024
#: Pairs of nodes that a walk holds at a time, of each level.
NODE_PAIRS = 1 << 18
#: Pairs of trees that Spark hands to Python at a time, and what it calls that.
TREES, ROWS_AT_A_TIME = 8, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Distances in float32 are off by less.
SLACK = 2e-3


def greedy_net(x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are centres, and each row's nearest centre: all rows lie within `radius` of one."""
    centres: list[int] = []
    limit = 1 - radius * radius / 2  # the same as a cosine
    for start in range(0, len(x), 256):
        part = x[start : start + 256]
        far = np.arange(len(part)) if not centres else np.flatnonzero((part @ x[centres].T).max(1) < limit)
        inner = part[far] @ part[far].T
        covered = np.zeros(len(far), bool)
        for i in range(len(far)):
            if not covered[i]:
                centres.append(start + int(far[i]))
                covered |= inner[i] >= limit
    found = np.array(centres)
    near = np.concatenate([(x[s : s + CHUNK] @ x[found].T).argmax(1) for s in range(0, len(x), CHUNK)])
    near[found] = np.arange(len(found))
    return found, near


def unit(vectors: np.ndarray) -> np.ndarray:
    # The largest part first: squares of very large or small numbers do not fit.
    scaled = vectors / np.abs(vectors).max(1)[:, None]
    return (scaled / np.sqrt((scaled**2).sum(1))[:, None]).astype(np.float32)


class CoverTree:
    """Levels from coarse to fine. Of each: rows that are centres, children's span, covering radius.

    Rows are ordered so that every node owns a span of them.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        x = unit(vectors)
        rows, levels = np.arange(len(x)), []
        for radius in reversed(RADII):  # fine to coarse: the centres of one level are the rows of the next
            centres, parent = greedy_net(x[rows], radius)
            levels.append((rows[centres], parent))
            rows = rows[centres]
        # The path of every row from the coarsest level down orders the rows.
        path = [levels[0][1]]
        for _, parent in levels[1:]:
            path.append(parent[path[-1]])
        order = np.lexsort(path)
        self.ids, self.vectors = ids[order], vectors[order]
        self.x = x[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.spans, self.rows, self.centres, self.radius = [], [], [], []
        for nodes, (centres, _) in zip(reversed(path), reversed(levels), strict=True):
            own = nodes[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            spans = np.stack([first, np.append(first[1:], len(own))], 1)
            middle = x[centres[own[first]]]
            self.rows.append(place[centres[own[first]]])
            away = np.sqrt(np.maximum(2 - 2 * (self.x * np.repeat(middle, spans[:, 1] - spans[:, 0], axis=0)).sum(1), 0))
            self.spans.append(spans)
            self.centres.append(middle)
            self.radius.append(np.maximum.reduceat(away, first).astype(np.float64))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children, at the next level, of nodes of this level."""
        starts = self.spans[level + 1][:, 0]
        spans = self.spans[level][nodes]
        first = np.searchsorted(starts, spans[:, 0])
        return first, np.searchsorted(starts, spans[:, 1]) - first

    def pack(self) -> bytes:
        """Centres are rows, so their numbers are enough; vectors of floats stay floats."""
        out = io.BytesIO()
        with np.errstate(over="ignore"):
            floats = self.vectors.astype(np.float32)
        parts = {"ids": self.ids, "vectors": floats if (floats == self.vectors).all() else self.vectors}
        for k in range(len(RADII)):
            parts |= {f"s{k}": self.spans[k][:, 0].astype(np.int32), f"c{k}": self.rows[k].astype(np.int32), f"r{k}": self.radius[k]}
        np.savez(out, **parts)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        tree, parts = cls.__new__(cls), np.load(io.BytesIO(data))
        tree.ids, tree.vectors = parts["ids"], parts["vectors"].astype(np.float64)
        tree.x = unit(tree.vectors)
        firsts, tree.rows, tree.radius = ([parts[f"{p}{k}"] for k in range(len(RADII))] for p in "scr")
        tree.spans = [np.stack([f, np.append(f[1:], len(tree.ids))], 1).astype(np.int64) for f in firsts]
        tree.centres = [tree.x[r] for r in tree.rows]
        return tree


def _near(a: CoverTree, b: CoverTree, level: int, i: np.ndarray, j: np.ndarray, limit: float) -> np.ndarray:
    """Which node pairs can hold a link."""
    step = CHUNK * 16
    dot = np.concatenate([np.einsum("ij,ij->i", a.centres[level][i[s : s + step]], b.centres[level][j[s : s + step]]) for s in range(0, len(i), step)])
    away = np.sqrt(np.maximum(2 - 2 * dot, 0))
    return away <= limit + a.radius[level][i] + b.radius[level][j] + SLACK


def _below(a: CoverTree, b: CoverTree, level: int, i: np.ndarray, j: np.ndarray, same: bool, limit: float) -> Iterator[tuple[int, int]]:
    """Pairs of finest nodes below these pairs of nodes, NODE_PAIRS of a level at a time."""
    if level == len(RADII) - 1:
        yield from zip(i.tolist(), j.tolist(), strict=True)
        return
    fi, ni = a.children(level, i)
    fj, nj = b.children(level, j)
    ends = np.cumsum(ni * nj)
    for start in range(0, int(ends[-1]) if len(ends) else 0, NODE_PAIRS):
        k = np.arange(start, min(start + NODE_PAIRS, int(ends[-1])))
        pair = np.searchsorted(ends, k, "right")
        k -= (ends - ni * nj)[pair]
        ci, cj = fi[pair] + k // nj[pair], fj[pair] + k % nj[pair]
        if same:
            ci, cj = ci[ci <= cj], cj[ci <= cj]
        keep = _near(a, b, level + 1, ci, cj, limit) if len(ci) else np.zeros(0, bool)
        yield from _below(a, b, level + 1, ci[keep], cj[keep], same, limit)


def traverse(a: CoverTree, b: CoverTree, same: bool, limit: float) -> Iterator[tuple[int, int]]:
    """Pairs of finest nodes of the two trees that may hold links; once each if they are the same."""
    step = max(1, min(CHUNK, 4 * NODE_PAIRS // max(1, len(b.centres[0]))))
    for s in range(0, len(a.centres[0]), step):
        dot = a.centres[0][s : s + step] @ b.centres[0].T
        away = np.sqrt(np.maximum(2 - 2 * dot, 0))
        i, j = np.nonzero(away <= limit + a.radius[0][s : s + step, None] + b.radius[0] + SLACK)
        i += s
        if same:
            i, j = i[i <= j], j[i <= j]
        yield from _below(a, b, 0, i, j, same, limit)


class Forest:
    """Disjoint sets of numbers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def links(a: CoverTree, b: CoverTree, same: bool, threshold: float) -> list[tuple[int, int, int]]:
    """(id, number of links, root) of every vector of two blocks with a link between them."""
    count: dict[int, int] = {}
    forest = Forest()
    length_a, length_b = (np.sqrt((t.vectors**2).sum(1)) for t in (a, b))
    finest = len(RADII) - 1
    for i, j in traverse(a, b, same, np.sqrt(2 - 2 * threshold)):
        (a0, a1), (b0, b1) = a.spans[finest][i], b.spans[finest][j]
        one = same and i == j
        if one and a1 - a0 == 1:
            continue
        for s in range(a0, a1, CHUNK):
            e = min(s + CHUNK, a1)
            linked = a.vectors[s:e] @ b.vectors[b0:b1].T / (length_a[s:e, None] * length_b[b0:b1]) >= threshold
            if one:
                linked[np.arange(e - s), np.arange(s - b0, e - b0)] = False
            for k in np.flatnonzero(linked.any(1)).tolist():
                x, there = int(a.ids[s + k]), b.ids[b0:b1][linked[k]].tolist()
                count[x] = count.get(x, 0) + len(there)
                # Joins to those not yet in the set only.
                for y in there:
                    if forest.up.get(y, y) != forest.up.get(x, x) or y not in forest.up:
                        forest.join(x, y)
            if not one:
                for k in np.flatnonzero(linked.any(0)).tolist():
                    y = int(b.ids[b0 + k])
                    count[y] = count.get(y, 0) + int(linked[:, k].sum())
    return [(x, n, forest.root(x)) for x, n in count.items()]


def block_links(blocks: DataFrame, threshold: float) -> DataFrame:
    """(id, n, root) of the vectors with links, for each pair of blocks (dim, block, tree) of one dimension.

    Every partition of trees meets every other in a task that reads both where they were written: nothing is
    shuffled. A row is a pair of trees.
    """
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, None
        for batch in batches:
            for dim, i, j, mine, other in zip(*(batch.column(k) for k in range(5)), strict=True):
                if (dim.as_py(), i.as_py()) != at:
                    at, left = (dim.as_py(), i.as_py()), CoverTree.unpack(mine.as_py())
                same = i.as_py() == j.as_py()
                found = links(left, left if same else CoverTree.unpack(other.as_py()), same, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3, names=["id", "n", "root"])

    mine = blocks.select("dim", F.col("block").alias("i"), F.col("tree").alias("mine"))
    other = blocks.select(F.col("dim").alias("dim_j"), F.col("block").alias("j"), F.col("tree").alias("other"))
    # As ranges, since an equation of dimensions would send all of a dimension to one task.
    met = mine.join(other.hint("shuffle_replicate_nl"), F.expr("dim <= dim_j AND dim >= dim_j AND i <= j"))
    return met.select("dim", "i", "j", "mine", "other").mapInArrow(pair, "id long, n long, root long")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per id: vec_id, n_links, component_id, kept."""
    # Of rows that share an id the least vector counts; the others do not meet in a block.
    valid = valid_vectors(df, id_col, vector_col).groupBy("id", "dim").agg(F.min("vector").alias("vector"))
    rows = cut(valid, "vectors")
    parts = max(1, -(-rows.count() // BLOCK))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = CoverTree(*one_each(group["id"].tolist(), group["vector"].tolist()))
        return pd.DataFrame([(*key, tree.pack())], columns=["dim", "block", "tree"])

    placed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    blocks = cut(placed.groupBy("dim", "block").applyInPandas(build, "dim int, block int, tree binary"), "trees")
    conf = df.sparkSession.conf
    handed = conf.get(ROWS_AT_A_TIME)
    conf.set(ROWS_AT_A_TIME, str(TREES))
    try:
        linked = cut(block_links(blocks, threshold), "links")
    finally:
        conf.set(ROWS_AT_A_TIME, handed)
    count = linked.groupBy("id").agg(F.sum("n").alias("n_links"))
    found = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    every = df.select(F.col(id_col).alias("id")).distinct()
    known = count.join(found, "id")
    return every.join(known, "id", "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
