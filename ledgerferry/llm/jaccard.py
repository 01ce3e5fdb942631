"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set holds its distinct five-word shingles as 64-bit hashes. Two sets of sizes m and n
link when they share at least ceil(4 (m + n) / 9) elements, which is a similarity of 0.8. So the
documents linked with one of n shingles occur on at least T = ceil(0.8 n) of its inverted lists.

DivideSkip sets the longest lists aside: what occurs T times on all lists occurs at least once on
the n - T + 1 shortest. This divides the work in two:

1. Candidates. Each document posts the shingles of its shortest lists (rare ones first, by a count
   of the whole corpus kept in a sketch of fixed size) to shards by hash. A short list gives the
   pairs of its documents whose sizes allow a link; parity bitmaps of the two sets, whose
   distance is at most that of the sets, rule most of them out. A long list, which is as a rule a
   group of near copies, is never paired out: a chain through its documents joins all that could
   link. What stays joined makes the groups.
2. Search. A group's sets meet in one task, or in a grid of tasks if they are many. There every
   document is searched with DivideSkip: a heap merges the short inverted lists and skips
   ahead, candidates are probed in the long ones by binary search, and those that reach the
   required overlap are joined. A candidate already joined with the query is not probed again.

Equal sets count as one from the start. Nothing is capped: groups of any size are searched whole.

Defined results: null or empty text has no shingles, n_shingles 0, and is its own component; a null id
links with nothing and has a null component; rows that share an id give a row each, with the
component of their own text; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerferry.llm.common import cut, slices, small_batches, tidy, worker_held
from ledgerferry.llm.components import components
from ledgerferry.llm.covertree import Forest

WORDS = 5
#: Counters of a task are reported before one of them could run over; shingles are counted so many at a time.
FULL, COUNTED = 60_000, 4_096
#: Counters of the sketch (one byte each when broadcast), the count at which a task reports one of
#: them, the sum from which a shingle counts as frequent, and the ranges that add them up.
SKETCH_BITS, REPORT, FREQUENT, RANGES = 24, 3, 8, 64
#: Lists up to this length are paired out, longer ones chained.
PAIRED = 64
#: Up to so many group members (a few tens of MB) are broadcast to the texts; more are joined by key.
BROADCAST_MEMBERS = 500_000
#: Postings that a task holds before it sends them, and bytes of a shard.
FLUSH, POSTING_BYTES, SHARD_BYTES = 1_000_000, 16, 16 << 20
#: Shingles of a block of a large group, and of the small groups of one task.
BLOCK_SHINGLES = 2_000_000
#: The weight of a long list's binary search against a short list's merge.
MU = 0.0085
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 20
_P, _Q, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Each byte as a number from 1, A-Z as a-z.
VALUE = np.arange(1, 257, dtype=np.uint64) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint64)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2 ** 64."""

    def make() -> tuple[np.ndarray, np.ndarray]:
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(PIECE, x, np.uint64))]) for x in (_P, inverse))

    return worker_held(__name__, "powers", make)


class Met:
    """Numbers met before, as far as a table of fixed size holds them: one that shares a place takes it over."""

    def __init__(self, bits: int = 20):
        self.at, self.mask = np.zeros(1 << bits, np.int64), (1 << bits) - 1

    def before(self, number: int) -> bool:
        place = number & self.mask
        if self.at[place] == number:
            return True
        self.at[place] = number
        return False


def _hashed(data: bytes) -> np.ndarray:
    """Hashes of the words of at most PIECE bytes: a word's polynomial is a difference of sums."""
    b = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], SPACE[b], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    start, end = change[::2], change[1::2]
    up, down = _powers()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUE[b] * up[: len(b)])])
    h = (sums[end] - sums[start]) * down[start]
    return (h ^ (h >> np.uint64(29))) * _Q


def word_hashes(data: bytes) -> np.ndarray:
    parts, start = [], 0
    while len(data) - start > PIECE:
        # The cut is after the last white space; a word longer than a piece has a digest for a hash.
        end = start + PIECE
        while end > start and not SPACE[data[end - 1]]:
            end -= 1
        if end == start:
            stop = end = start + PIECE
            while stop < len(data) and not SPACE[data[stop]]:
                stop += 1
            whole = hashlib.blake2b(data[start:stop].lower(), digest_size=8).digest()
            parts.append(np.frombuffer(whole, "<u8"))
            start = stop
            continue
        parts.append(_hashed(data[start:end]))
        start = end
    parts.append(_hashed(data[start:]))
    return np.concatenate(parts)


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of a text. Only A-Z are lower-cased, only ASCII white space parts words."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(w):
        return np.zeros(0, np.uint64)
    n = min(WORDS, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = h * _P + w[k : len(w) - n + 1 + k]
        h ^= h >> np.uint64(32)
    h = (h ^ (h >> np.uint64(30))) * _Q
    h = (h ^ (h >> np.uint64(27))) * _R
    h = np.sort(h ^ (h >> np.uint64(31)))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def bitmap(own: np.ndarray) -> bytes:
    """Parities of the set's elements by their low bits, at least as many bits as elements."""
    bits = 1 << max(6, (len(own) - 1).bit_length())
    return np.packbits((np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """At most the number of elements that two sets do not share; the wider bitmap is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def class_of(own: np.ndarray) -> int:
    """A number that equal sets share."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(m: int, n: int) -> int:
    """100 * shared >= 80 * united, as a number of shared shingles."""
    return -(-4 * (m + n) // 9)


def first_pass(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, class, bits) of documents, and rows (range, bucket, seen) of packed counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.uint16)
        known = Met()

        def report() -> Iterator[pa.RecordBatch]:
            often = np.flatnonzero(seen >= REPORT)
            cuts = np.searchsorted(often, np.arange(RANGES + 1) << (SKETCH_BITS - 6))
            for k in range(RANGES):
                own = often[cuts[k] : cuts[k + 1]]
                if len(own):
                    none = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.int64(), pa.binary())]
                    packed = [pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (own, seen[own])]
                    yield pa.record_batch([*none, pa.array([k], pa.int32()), *packed], names)

        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            classes = [class_of(s) if len(s) else None for s in sets]
            for own, name in zip(sets, classes, strict=True):
                if name is not None and not known.before(name):  # copies are counted once
                    for start in range(0, len(own), COUNTED):
                        at = (own[start : start + COUNTED] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                        np.add.at(seen, at, 1)
                        if seen[at].max() >= FULL:  # before a counter runs over
                            yield from report()
                            seen[:] = 0
            bits = [bitmap(s) if len(s) else None for s in sets]
            none = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.record_batch([batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(classes, pa.int64()), pa.array(bits, pa.binary()), *none], names)
        yield from report()

    names = ["id", "n", "class", "bits", "range", "bucket", "seen"]
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = pa.int32() if kind == "int" else pa.int64()
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, n long, class long, bits binary, range int, bucket binary, seen binary")


def levels(first: DataFrame) -> np.ndarray:
    """The frequency class of each counter of the sketch: bits of its count, 0 if not frequent."""
    wide = 1 << (SKETCH_BITS - 6)

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(wide, np.int64)
        for bucket, seen in zip(group["bucket"], group["seen"], strict=True):
            total[np.frombuffer(bucket, "<u4") - key[0] * wide] += np.frombuffer(seen, "<u4")
        level = np.where(total >= FREQUENT, np.ceil(np.log2(np.maximum(total, 1))), 0).astype(np.uint8)
        return pd.DataFrame([(key[0], level.tobytes())], columns=["range", "level"])

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    added = first.where(F.col("range").isNotNull()).select("range", "bucket", "seen").groupBy("range").applyInPandas(add, "range int, level binary")
    for row in added.toLocalIterator():  # RANGES rows, 2 ** SKETCH_BITS bytes together
        out[row["range"] * wide : (row["range"] + 1) * wide] = np.frombuffer(row["level"], np.uint8)
    return out


def postings(docs: DataFrame, text_col: str, held: Broadcast, shards: int) -> DataFrame:
    """Rows (shard, hash, class, size): packed postings of the shingles on each document's shortest lists.

    size is twice the set's size, plus one if the shingle is also among the n - ceil(8 n / 9) + 1
    rarest, where a link with a set that is no smaller has to show.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, known, parts, total = held.value, Met(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, c, s = (np.concatenate(x) for x in zip(*parts, strict=True))
            shard = (h % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            h, c, s, shard = (h[order] >> np.uint64(32)).astype(np.uint32), c[order], s[order], shard[order]
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            pack = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            yield pa.record_batch([pa.array(shard[cuts[:-1]]), pack(h), pack(c), pack(s)], ["shard", "hash", "class", "size"])

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                own = shingles(text)
                n = len(own)
                if not n or known.before(name := class_of(own)):
                    continue
                lead = n - -(-8 * n // 10) + 1
                rank = level[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((own, rank)) if rank.any() else np.arange(n)
                index = n - -(-8 * n // 9) + 1
                parts.append((own[order[:lead]], np.full(lead, name, np.int64), 2 * np.full(lead, n, np.uint32) + (np.arange(lead) < index).astype(np.uint32)))
                total += lead
            if total >= FLUSH:
                yield from flush()
                parts, total = [], 0
        if parts:
            yield from flush()

    return small_batches(docs).select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "shard int, hash binary, class binary, size binary")


def list_edges(h: np.ndarray, names: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes (k, 2) of a shard's short lists, and chains (k, 2) through its long ones.

    A pair has the smaller set (a tie: either) among its index postings, and sizes that allow a link.
    """
    by_hash = np.argsort(h, kind="stable")
    sorted_h = h[by_hash]
    same = sorted_h[1:] == sorted_h[:-1]
    kept = by_hash[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    h, names, n, index = h[kept], names[kept], size[kept].astype(np.int64) >> 1, (size[kept] & 1).astype(bool)
    order = np.lexsort((names, ~index, n, h))
    h, names, n, index = h[order], names[order], n[order], index[order]
    # Copies of one set post the same; the list has it once.
    once = np.concatenate([[True], (h[1:] != h[:-1]) | (names[1:] != names[:-1])]) if len(h) else np.zeros(0, bool)
    h, names, n, index = h[once], names[once], n[once], index[once]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    length = np.diff(np.append(first, len(h)))
    own = np.repeat(length, length)
    found = []
    at = np.flatnonzero(own <= PAIRED)
    for step in range(1, PAIRED):  # each with the one `step` places before it on its list
        at = at[at >= step]
        at = at[h[at] == h[at - step]]
        if not len(at):
            break
        fits = index[at - step] & (8 * n[at] <= 10 * n[at - step])
        found.append(np.stack([names[at[fits]], names[at[fits] - step]], 1))
    # On a long list each hangs on the last one before it that may be the smaller set of a link.
    place = np.where(index, np.arange(len(h)), -1)
    last = np.concatenate([[-1], np.maximum.accumulate(place)[:-1]]) if len(h) else place
    i = np.flatnonzero((own > PAIRED) & (last >= 0))
    j = last[i]
    fits = (h[i] == h[j]) & (8 * n[i] <= 10 * n[j])
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    pairs, chain = np.sort(pairs, axis=1), np.stack([names[i[fits]], names[j[fits]]], 1)
    forest = Forest()
    for a, b in np.unique(chain, axis=0).tolist():
        forest.join(a, b)
    rooted = [(x, r) for x in list(forest.up) if (r := forest.root(x)) != x]
    return np.unique(pairs, axis=0), np.array(rooted, np.int64).reshape(-1, 2)


def candidate_edges(posted: DataFrame) -> DataFrame:
    """Rows (a, b, chain) of classes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        read = lambda name, kind: np.frombuffer(b"".join(group[name]), kind)
        pairs, chain = list_edges(read("hash", "<u4"), read("class", "<i8"), read("size", "<u4"))
        both = np.concatenate([pairs, chain])
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1], "chain": np.arange(len(both)) >= len(pairs)})

    return posted.groupBy("shard").applyInPandas(run, "a long, b long, chain boolean")


def plausible(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """The edges (a, b) that bitmaps do not rule out; chains stay, as their ends need not link."""
    pairs = edges.where("NOT chain").select("a", "b").distinct()
    side = lambda c: classes.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4_096):
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
            keep = pa.array([9 * apart(x, y) <= m + n for m, n, x, y in rows], pa.bool_())
            yield pa.record_batch(batch.columns[:2], ["a", "b"]).filter(keep)

    return known.mapInArrow(tidy(run), "a long, b long").unionByName(edges.where("chain").select("a", "b"))


def heap_merge(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """(id, count) of the ids on at least `need` of the sorted lists, by a heap of their heads.

    When the least id is on too few lists, the heads of `need` - 1 lists are moved past it by
    binary search to the first id that could be on enough.
    """
    heap = [(own[0], k, 0) for k, own in enumerate(lists) if own]
    heapq.heapify(heap)
    while len(heap) >= need:
        top, taken = heap[0][0], []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap))
        if len(taken) >= need:
            yield top, len(taken)
            for _, k, at in taken:
                if at + 1 < len(lists[k]):
                    heapq.heappush(heap, (lists[k][at + 1], k, at + 1))
            continue
        while heap and len(taken) < need - 1:
            taken.append(heapq.heappop(heap))
        if not heap:
            return
        goal = heap[0][0]
        for _, k, at in taken:
            at = bisect_left(lists[k], goal, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def search(sets: list[np.ndarray], sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs (i, j) that join the linked sets of a group, at most one fewer than sets.

    With sides given, only sets of different sides are compared.
    """
    sizes = list(map(len, sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")  # owners rise within a list
    lists, number = np.unique(flat, return_inverse=True)
    starts = np.searchsorted(flat[order], lists)
    ends = np.append(starts[1:], len(flat))
    members, length = owner[order], ends - starts
    cuts = np.cumsum([0, *sizes])
    forest, found, parts = Forest(), [], len(sets)
    for x in range(1, len(sets)):  # each is searched among those before it
        if parts == 1:
            break
        own = number[cuts[x] : cuts[x + 1]]
        need = -(-8 * sizes[x] // 10)
        own = own[np.argsort(length[own], kind="stable")]
        if (length[own] > 1).sum() < need:
            continue
        long = min(need - 1, int(need / (MU * math.log(max(2, length[own[-1]])) + 1)))
        short = own[: len(own) - long]
        total = int(length[short].sum())
        if total > 20_000:
            # Counters instead of a heap where the lists hold most of the group.
            at = np.concatenate([members[starts[s] : ends[s]] for s in short])
            count = np.bincount(at[at < x], minlength=x)
            some = np.flatnonzero(count >= need - long)
            merged = zip(some.tolist(), count[some].tolist(), strict=True)
        else:
            rest = [members[starts[s] : ends[s]] for s in short if length[s] > 1]
            merged = heap_merge([m[: np.searchsorted(m, x)].tolist() for m in rest], need - long)
        probed = [(starts[s], ends[s]) for s in own[len(own) - long :]]
        for y, count in merged:
            if sides is not None and sides[x] == sides[y] or forest.root(x) == forest.root(y):
                continue
            wanted = least_overlap(sizes[x], sizes[y])
            if 10 * min(sizes[x], sizes[y]) < 8 * max(sizes[x], sizes[y]):
                continue
            left = long
            for s, e in probed:
                if count >= wanted or count + left < wanted:
                    break
                left -= 1
                at = bisect_left(members, y, s, e)
                count += bool(at < e and members[at] == y)
            if count >= wanted:
                forest.join(x, y)
                found.append((x, y))
                parts -= 1
    return found


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component, class (equal sets share it), first.

    first is the class that stands for all that are linked: of those with the least id the least.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = cut(first_pass(named, "id", "text"), "sets")
    rows = first.where(F.col("range").isNull()).select("id", "n", "class", "bits")
    total = rows.agg(F.sum("n")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(4 * partitions, -(-total * POSTING_BYTES // (5 * SHARD_BYTES)))
    ranks = spark.sparkContext.broadcast(levels(first))
    edges = cut(candidate_edges(postings(named, "text", ranks, shards)), "candidates")
    ranks.destroy()
    # A class is known by its least document from here on.
    known = rows.where(F.col("class").isNotNull() & F.col("id").isNotNull())
    classes = known.groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    groups = components(plausible(edges, classes)).select(F.col("id").alias("class"), F.col("component").alias("group"))
    members = cut(classes.select("class", "id", "n").join(groups, "class"), "members")
    weight = members.groupBy("group").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    members = members.join(weight, "group")
    tasks = max(partitions, -(-total // BLOCK_SHINGLES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(4).to_pylist()]
            right = pa.array([bool(len(s)) and class_of(s) == c for s, c in zip(sets, batch.column(1).to_pylist(), strict=True)], pa.bool_())
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            out = pa.record_batch([*batch.columns[:4], packed], ["id", "class", "group", "blocks", "elements"])
            yield out.filter(right)

    kind = named.schema["id"].dataType.simpleString()
    wanted = members.select("id", "class", "group", "blocks")
    wanted = F.broadcast(wanted) if members.count() <= BROADCAST_MEMBERS else wanted
    texts = named.join(wanted, "id").select("id", "class", "group", "blocks", "text")
    sets = texts.mapInArrow(tidy(read), f"id {kind}, class long, group long, blocks int, elements binary")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    spots = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, block).alias("i"), F.greatest(o, block).alias("j")))
    dealt = sets.withColumn("block", block).withColumn("spot", F.explode(spots))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(tasks))).otherwise(F.col("group"))
    dealt = dealt.select(task.alias("task"), F.col("blocks") > 1, F.col("spot.i").alias("i"), F.col("spot.j").alias("j"), "id", "class", "group", "block", "elements").toDF("task", "large", "i", "j", "id", "class", "group", "block", "elements")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in group.drop_duplicates("class").sort_values(["group", "id"]).groupby("group", sort=False):
            sides = None
            if own["large"].iloc[0] and own["i"].iloc[0] != own["j"].iloc[0]:
                sides = (own["block"] == own["j"]).astype(int).tolist()
            at = list(zip(own["id"].tolist(), own["class"].tolist(), strict=True))
            found += [(*at[x], *at[y]) for x, y in search([np.frombuffer(e, "<u8") for e in own["elements"]], sides)]
        return pd.DataFrame(found, columns=["a", "a_class", "b", "b_class"], dtype="int64")

    # A node is a class with its least id before it: texts that share an id are told apart.
    links = dealt.groupBy("task", "large", "i", "j").applyInPandas(run, "a long, a_class long, b long, b_class long")
    node = lambda c: F.struct(F.col(c).alias("id"), F.col(f"{c}_class").alias("class")).alias(c)
    joined = components(links.select(node("a"), node("b"))).select("id.class", F.col("component.id").alias("component"), F.col("component.class").alias("first"))
    named_classes = classes.select("class", F.col("id").alias("least")).join(joined, "class", "left").select("class", F.coalesce("component", "least").alias("component"), F.coalesce("first", "class").alias("first"))
    return rows.join(named_classes, "class", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
        "class",
        "first",
    )


def with_class(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with the class of their text, null where it has no shingles."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = map(shingles, batch.column(at).to_pylist())
            classes = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.record_batch([*batch.columns, classes], [*batch.schema.names, "class"])

    return small_batches(docs).mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField("class", LongType())]))


def digest(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
