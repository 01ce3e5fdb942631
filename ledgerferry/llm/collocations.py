"""Phrase collocations from a weighted de Bruijn graph.

Nodes are runs of three words, edges runs of four, weighted by their occurrences. At each word of a
piece a task counts the longest run of up to four words that starts there: an edge, or at the
piece's end a run of three, two or one words (the piece-end corrections). Only these are counted;
all shorter counts follow from flow: what leaves a node plus what ends there is the node's count,
nodes that start alike and pieces that end there give a pair's, pairs a word's.

A word or a pair of neighbours that occurs less than `least` times is in no phrase that is asked for,
so pieces are cut there beforehand, and what is counted and shuffled is mostly phrases that matter.
Rare words are read off a sketch of SKETCH counters over (language, word), rare pairs off sums over
PAIR_BITS-bit hashes, kept as a bitmap of fixed size. Either may keep what is rare, but never loses what is
frequent; counts do not depend on them.

The graph of frequent edges is compacted: edges joined by nodes with one frequent edge in and one
out make one path (pointer doubling over the edges; edges of closed rings stay single). Paths carry
their words, so the counts of all parts are looked up once for each word of a path, not for
each cut of each phrase, and phrases inside a path are compared there with those that hold them. Only
phrases at a path's end meet those of other paths. It is enough to compare with phrases one word
longer, as a longer phrase's count is at most that of any run of words inside it.

Products are decimals of 38 digits.

Defined results: null texts are empty, a null lang is `und`; rows that share an id count each, the id
is not read; an empty table or one without a frequent phrase gives no rows; ties of score go to the
larger count, then to the phrase first in UTF-8 byte order; further columns are ignored. A word's
bytes outside A-Z are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerferry.llm.common import cut, small_batches, tidy
from ledgerferry.llm.piecebpe import by_bytes

LEAST, TOP = 30, 2_000
#: Counters of the sketch of words, and the blocks in which they are summed up.
SKETCH, BLOCKS = 1 << 22, 16
#: Bits of a pair's hash, of its place in the bitmap, and words for which a shard of the hashes is made.
PAIR_BITS, MAP_BITS, SHARD_WORDS = 40, 27, 1 << 20
#: Words that a task counts together, and words of the corpus for each task that adds counts up.
FLUSH, TASK_WORDS = 1_500_000, 1 << 22
#: Edges in one row of a path; longer paths go on in the next row.
PART = 512

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of all texts in order, the text of each, and the piece of each (ascending)."""
    ended = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.large_string()), *(pa.scalar(x, pa.large_string()) for x in ("", "\n")))
    _, offsets, data = ended.buffers()
    ends = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + len(ended) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if len(ended) else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = _CLASS[raw]
    letter = kind == 0
    edge = np.flatnonzero(np.diff(letter.view(np.int8), prepend=np.int8(0)))  # each text ends in a break
    start, stop = edge[::2], edge[1::2]
    at = np.append(0, np.cumsum(stop - start))
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(_LOWER[raw[letter]]))
    piece = np.cumsum(kind == 2)[start] if len(start) else np.zeros(0, np.int64)
    return words.dictionary_encode(), np.searchsorted(ends, start, "right") - 1, piece


_P, _Q, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def hashes(langs: pa.Array, lang_codes: np.ndarray, words: pa.Array, word_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct (language, word), and which of them each word is."""
    both, back = np.unique(lang_codes * np.int64(max(len(words), 1)) + word_codes, return_inverse=True)
    of_lang = pd.util.hash_array(np.array(langs.to_pylist(), object), categorize=False)
    of_word = pd.util.hash_array(np.array(words.to_pylist(), object), categorize=False)
    lang, word = np.divmod(both, max(len(words), 1))
    return of_lang[lang] * _P ^ of_word[word], back


def counter(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(SKETCH - 1)).astype(np.int64)


def pair_hash(h: np.ndarray) -> np.ndarray:
    """PAIR_BITS-bit hashes of neighbours, from those of words (language included)."""
    x = h[:-1] * _Q + (h[1:] ^ (h[1:] >> np.uint64(31))) * _R
    x = (x ^ (x >> np.uint64(29))) * _P
    return (x >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return small_batches(docs).select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def _read(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Languages, each word's language, words, each word's place among them and its piece."""
    coded, doc, piece = words_of(batch.column(1))
    langs = batch.column(0).dictionary_encode()
    of_word = langs.indices.to_numpy().astype(np.int64)[doc]
    return langs.dictionary, of_word, coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece


def frequent_words(texts: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """A bitmap of the sketch's counters in which a word can occur `least` times, and the number of words."""
    kind = np.uint8 if least < 256 else np.int32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SKETCH, np.int32), 0
        for batch in batches:
            for part in by_bytes(batch):
                langs, of_word, words, code, _ = _read(part)
                if len(code):
                    h, back = hashes(langs, of_word, words, code)
                    np.add.at(total, counter(h), np.bincount(back, minlength=len(h)).astype(np.int32))
                    n += len(code)
        seen = np.minimum(total, least).astype(kind).reshape(BLOCKS, -1)
        counts = [n, *[0] * (BLOCKS - 1)]
        yield pa.record_batch([pa.array(range(BLOCKS), pa.int32()), pa.array([s.tobytes() for s in seen], pa.binary()), pa.array(counts, pa.int64())], ["block", "seen", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        words = 0
        for batch in batches:
            for block, seen, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(seen, kind)
                sums[block] = np.minimum(sums[block] + values, least) if block in sums else values.astype(np.int32)
                words += n
        packed = [np.packbits(s >= least).tobytes() for s in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary()), pa.array([words, *[0] * len(sums)][: len(sums)], pa.int64())], ["block", "bits", "n"])

    parts = texts.mapInArrow(tidy(count), "block int, seen binary, n long").repartition(BLOCKS, "block").mapInArrow(add, "block int, bits binary, n long")
    bits, words = np.zeros((BLOCKS, SKETCH // BLOCKS // 8), np.uint8), 0
    for row in parts.collect():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
        words += row["n"]
    return bits.reshape(-1), words


def is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of places in a packed bitmap: is the bit set?"""
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def frequent_pairs(texts: DataFrame, words: np.ndarray, n: int, least: int) -> np.ndarray:
    """A bitmap, by the first MAP_BITS bits of their hash, of the pairs that can occur `least` times."""
    held = texts.sparkSession.sparkContext.broadcast(words)
    kind, most = (np.uint8, 255) if least < 256 else (np.uint32, (1 << 32) - 1)
    bits = min(MAP_BITS - 3, max(PAIR_BITS - 32, (n // SHARD_WORDS).bit_length()))
    low = PAIR_BITS - bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[np.ndarray] = []

        def send() -> pa.RecordBatch:
            found, cnt = np.unique(np.concatenate(met), return_counts=True)
            cell, cnt, shard = (found & ((1 << low) - 1)).astype(np.uint32), np.minimum(cnt, most).astype(kind), found >> low
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            pack = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())
            return pa.record_batch([pa.array(shard[cuts[:-1]], pa.int32()), pack(cell), pack(cnt)], ["shard", "cell", "cnt"])

        for batch in batches:
            for part in by_bytes(batch):
                _, piece, h, _, _ = _kept(part, held.value)
                if len(h) > 1:
                    met.append(pair_hash(h)[piece[1:] == piece[:-1]])
                if sum(map(len, met)) >= FLUSH:
                    yield send()
                    met.clear()
        if sum(map(len, met)):
            yield send()

    def add(key: tuple, group: pa.Table) -> pa.Table:
        cell = np.frombuffer(b"".join(group["cell"].to_pylist()), np.uint32)
        cnt = np.frombuffer(b"".join(group["cnt"].to_pylist()), kind)
        order = np.argsort(cell, kind="stable")
        cell, cnt = cell[order], cnt[order].astype(np.int64)
        heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        often = cell[heads][np.add.reduceat(cnt, heads) >= least]
        own = np.zeros(1 << (MAP_BITS - bits), bool)
        own[often >> np.uint32(PAIR_BITS - MAP_BITS)] = True
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())], ["shard", "bits"])

    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    wide = len(out) >> bits
    for row in texts.mapInArrow(tidy(count), "shard int, cell binary, cnt binary").groupBy("shard").applyInArrow(add, "shard int, bits binary").toLocalIterator():
        out[row["shard"] * wide : (row["shard"] + 1) * wide] = np.frombuffer(row["bits"], np.uint8)
    held.destroy()
    return out


def _kept(part: pa.RecordBatch, bits: np.ndarray) -> tuple[dict[str, int], np.ndarray, np.ndarray, pa.DictionaryArray, pa.DictionaryArray]:
    """Words by language; of the words that are not rare: piece, hash, word and language."""
    langs, of_word, words, code, piece = _read(part)
    total = dict(zip(langs.to_pylist(), np.bincount(of_word, minlength=len(langs)).tolist(), strict=True))
    h, back = hashes(langs, of_word, words, code) if len(code) else (np.zeros(0, np.uint64), code)
    kept = is_set(bits, counter(h))[back]
    named = [pa.DictionaryArray.from_arrays(pa.array(x[kept], pa.int32()), y) for x, y in ((code, words), (of_word, langs))]
    return total, (piece + np.cumsum(~kept))[kept], h[back][kept], *named


class _Counter:
    """Longest runs of words, counted for many texts together."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.word_bits, self.pair_bits = words, pairs
        self.clear()

    def clear(self) -> None:
        self.words: list[pa.DictionaryArray] = []
        self.langs: list[pa.DictionaryArray] = []
        self.pieces: list[np.ndarray] = []
        self.size, self.last = 0, 0

    def add(self, part: pa.RecordBatch, total: dict[str, int]) -> None:
        counted, piece, h, words, langs = _kept(part, self.word_bits)
        for lang, n in counted.items():
            total[lang] = total.get(lang, 0) + n
        if not len(piece):
            return
        # A rare pair ends a piece between its words, as a rare word did.
        apart = ~is_set(self.pair_bits, pair_hash(h) >> (PAIR_BITS - MAP_BITS))
        piece = piece + np.append(0, np.cumsum(apart)) + self.last + 1
        self.last = int(piece[-1])
        self.size += len(piece)
        self.pieces.append(piece)
        self.words.append(words)
        self.langs.append(langs)

    def flush(self, parts: int) -> Iterator[pa.RecordBatch]:
        """(part, runs): each distinct run of up to three words and the one that follows, with its count;
        runs that begin with the same three words go to one part."""
        if not self.size:
            return
        words, langs = (pa.chunked_array(x).unify_dictionaries().combine_chunks() for x in (self.words, self.langs))
        piece = np.concatenate(self.pieces)
        self.clear()
        n, width = len(piece), len(words.dictionary) + 1
        run = np.zeros((4, n), np.int64)
        run[0] = words.indices.to_numpy() + 1
        for k in range(1, 4):
            run[k, : n - k] = np.where(piece[k:] == piece[: n - k], run[0, k:], 0)
        heads, head = np.unique(run[0] * width + run[1], return_inverse=True)
        tails, tail = np.unique(run[2] * width + run[3], return_inverse=True)
        many = max(len(langs.dictionary), 1)
        found, cnt = np.unique((head * len(tails) + tail) * many + langs.indices.to_numpy(), return_counts=True)
        both, lang = np.divmod(found, many)
        head, tail = heads[both // len(tails)], tails[both % len(tails)]
        code = [x for pair in (head, tail) for x in np.divmod(pair, width)]
        named = [pd.util.hash_array(np.array(["", *x.dictionary.to_pylist()], object), categorize=False) for x in (words, langs)]
        mixed = named[1][lang + 1]
        for k in range(3):
            mixed = (mixed ^ named[0][code[k]]) * _P
            mixed ^= mixed >> np.uint64(31)
        part = ((mixed * _Q >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        names = pa.concat_arrays([pa.array([None], words.dictionary.type), words.dictionary]).cast(pa.string())
        cuts = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]]))
        for i, j in zip(cuts, cuts[1:]):
            own = order[i:j]
            columns = [names.take(pa.array(c[own])) for c in code]
            rows = [langs.dictionary.take(pa.array(lang[own])), _node(columns[:3]), columns[3], pa.array(cnt[own], pa.int64())]
            yield pa.record_batch([pa.array([part[own[0]]], pa.int32()), pa.array([_pack(pa.table(rows, RUNS))], pa.binary())], ["part", "runs"])


RUNS = pa.schema([("lang", pa.string()), ("node", pa.string()), ("next", pa.string()), ("cnt", pa.int64())])


def _node(columns: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*columns, " ", null_handling="skip")


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _summed(tables: list[pa.Table], *keys: str) -> pa.Table:
    return pa.concat_tables(tables).group_by(list(keys)).aggregate([("cnt", "sum")]).rename_columns([*keys, "cnt"])


def flows(added: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n, f) from all runs of some nodes: frequent edges and nodes, and what the nodes
    give to the pair and the word they begin with; n = 0 holds the number of words."""
    edges = added.filter(pc.and_(pc.is_valid(added["next"]), pc.greater_equal(added["cnt"], least)))
    nodes = _summed([added], "lang", "node")
    length = pc.add(pc.count_substring(nodes["node"], " "), pc.if_else(pc.equal(nodes["node"], ""), 0, 1))
    kinds = [(4, edges["lang"], pc.binary_join_element_wise(edges["node"], edges["next"], " "), edges["cnt"])]
    for n in (0, 3):
        own = nodes.filter(pc.equal(length, n) if n == 0 else pc.and_(pc.equal(length, n), pc.greater_equal(nodes["cnt"], least)))
        kinds.append((n, own["lang"], own["node"], own["cnt"]))
    for n, first in ((2, r"^([^ ]+ [^ ]+) .*$"), (1, r"^([^ ]+) .*$")):
        own = nodes.filter(pc.greater_equal(length, n))
        own = own.set_column(1, "node", pc.replace_substring_regex(own["node"], f"(?s){first}", r"\1"))
        own = _summed([own], "lang", "node")
        kinds.append((n, own["lang"], own["node"], own["cnt"]))
    for n, lang, phrase, f in kinds:
        table = pa.table([lang, phrase, pa.array(np.full(len(f), n), pa.int32()), f], ["lang", "phrase", "n", "f"])
        yield from table.combine_chunks().to_batches(max_chunksize=50_000)


def phrase_counts(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n, f): all phrases of one to four words that occur at least `least` times; n = 0
    holds the number of words. One shuffle of the runs, packed, by node, and one of the nodes' flow to
    pairs and words."""
    words, n = frequent_words(texts, least)
    held = texts.sparkSession.sparkContext.broadcast((words, frequent_pairs(texts, words, n, least)))
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_WORDS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = _Counter(*held.value), {}
        for batch in batches:
            for part in by_bytes(batch):
                found.add(part, total)
                if found.size >= FLUSH:
                    yield from found.flush(parts)
        yield from found.flush(parts)
        if total:
            rows = [pa.array(list(total), pa.string()), pa.array([""] * len(total)), pa.nulls(len(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([_pack(pa.table(rows, RUNS))], pa.binary())], ["part", "runs"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is held is the distinct runs, however many tasks have counted them.
        added, waiting, size = RUNS.empty_table(), [], 0
        for batch in batches:
            for packed in batch.column(1).to_pylist():
                waiting.append(pa.ipc.open_stream(packed).read_all())
                size += len(waiting[-1])
                if size > max(500_000, len(added)):
                    added, waiting, size = _summed([added, *waiting], "lang", "node", "next"), [], 0
        yield from flows(_summed([added, *waiting], "lang", "node", "next"), least)

    found = texts.mapInArrow(tidy(count), "part int, runs binary").repartition(parts, "part").mapInArrow(tidy(add), "lang string, phrase string, n int, f long")
    return found.groupBy("phrase", "lang", "n").agg(F.sum("f").alias("f")).where((F.col("n") == 0) | (F.col("f") >= least)).select("lang", "phrase", "n", "f")


def _last(phrase: str, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def compact(counts: DataFrame) -> DataFrame:
    """(lang, path, part, words, weights): the graph's paths in rows of up to PART edges.

    Phrases in no frequent edge are paths of their own: three words, or two, without weights.
    """
    edges = counts.where("n = 4").select("lang", F.col("phrase").alias("edge"), "f", F.substring_index("phrase", " ", 3).alias("src"), _last("phrase", 3).alias("dst"))
    degree = (
        edges.select("lang", F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.lit(None).cast("string").alias("edge"))
        .unionByName(edges.select("lang", F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), "edge"))
        .groupBy("lang", "node")
        .agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.max("edge").alias("edge"))
    )
    inner = degree.where("o = 1 AND i = 1").select("lang", F.col("node").alias("src"), F.col("edge").alias("up"))
    # Each edge points to the one before it on its path, at first; then to the one twice as far.
    chain = cut(edges.join(inner, ["lang", "src"], "left").select("lang", "edge", "f", "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("far")), "paths")
    head = F.col("up").isNull().alias("headed")
    chain = chain.withColumn("path", F.when(head, F.col("edge")))
    open_before = None
    while True:
        left = chain.where("path IS NULL")
        n = left.count()
        if n == 0 or n == open_before:  # what finds no head any more lies on a ring
            break
        open_before = n
        above = chain.select("lang", F.col("edge").alias("up"), F.col("up").alias("next_up"), F.col("far").alias("more"), F.col("path").alias("up_path"))
        moved = left.drop("path").join(above, ["lang", "up"]).select(
            "lang", "edge", "f", F.col("next_up").alias("up"), (F.col("far") + F.col("more")).alias("far"), F.col("up_path").alias("path")
        )
        chain = cut(chain.where("path IS NOT NULL").unionByName(moved), "paths")
    ring = F.col("path").isNull()
    placed = chain.select("lang", F.coalesce("path", "edge").alias("path"), F.when(ring, 0).otherwise(F.col("far")).alias("far"), "edge", "f")
    one = F.expr("aggregate(slice(row, 2, size(row)), split(row[0].edge, ' '), (a, x) -> concat(a, array(substring_index(x.edge, ' ', -1))))")
    long = (
        placed.groupBy("lang", "path", F.floor(F.col("far") / PART).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("far", "edge", "f"))).alias("row"))
        .select("lang", "path", "part", one.alias("words"), F.expr("transform(row, x -> x.f)").alias("weights"))
    )
    nothing = F.array().cast("array<bigint>").alias("weights")
    ends = edges.select("lang", F.explode(F.array("src", "dst")).alias("phrase"))
    three = counts.where("n = 3").select("lang", "phrase")
    pairs = three.select("lang", F.explode(F.array(F.substring_index("phrase", " ", 2), _last("phrase", 2))).alias("phrase"))
    alone = three.join(ends, ["lang", "phrase"], "left_anti").unionByName(counts.where("n = 2").select("lang", "phrase").join(pairs, ["lang", "phrase"], "left_anti"))
    return long.unionByName(alone.select("lang", F.col("phrase").alias("path"), F.lit(0).cast("bigint").alias("part"), F.split("phrase", " ").alias("words"), nothing))


def candidates(paths: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, cuts, longer): phrases of two to four words, the counts of both sides of each
    cut, and the largest count of a phrase one word longer that holds it."""
    key = ["lang", "path", "part"]
    spots = paths.select(*key, F.col("words").alias("w"), F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))
    spots = spots.select(*key, "at", F.posexplode(F.expr("transform(sequence(1, least(3, size(w) - at)), k -> array_join(slice(w, at + 1, k), ' '))")).alias("k", "phrase"))
    known = spots.join(counts.where("n BETWEEN 1 AND 3").select("lang", "phrase", "f"), ["lang", "phrase"])
    rows = known.groupBy(*key).agg(*(F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("at", "f")))).alias(f"s{k}") for k in range(3)))
    rows = rows.select(*key, *(F.expr(f"transform(s{k}, x -> x.f)").alias(f"f{k + 1}") for k in range(3)))
    rows = paths.join(rows, key)
    # At word i (from 0): counts of the phrase, of the sides of its cuts, and of what holds it in this row.
    at_least = {
        2: "transform(f2, (a, i) -> struct(array_join(slice(words, i + 1, 2), ' ') AS phrase, a AS a,"
        " array(struct(f1[i] AS l, f1[i + 1] AS r)) AS cuts, greatest(get(f3, i - 1), get(f3, i)) AS longer))",
        3: "transform(f3, (a, i) -> struct(array_join(slice(words, i + 1, 3), ' ') AS phrase, a AS a,"
        " array(struct(f1[i] AS l, f2[i + 1] AS r), struct(f2[i] AS l, f1[i + 2] AS r)) AS cuts,"
        " greatest(get(weights, i - 1), get(weights, i)) AS longer))",
        4: "transform(weights, (a, i) -> struct(array_join(slice(words, i + 1, 4), ' ') AS phrase, a AS a,"
        " array(struct(f1[i] AS l, f3[i + 1] AS r), struct(f2[i] AS l, f2[i + 2] AS r), struct(f3[i] AS l, f1[i + 3] AS r)) AS cuts,"
        " CAST(NULL AS bigint) AS longer))",
    }
    found = rows.select("lang", F.explode(F.concat(*(F.expr(e) for e in at_least.values()))).alias("c")).select("lang", "c.*")
    return found.groupBy("lang", "phrase", "a", "cuts").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = cut(phrase_counts(_texts(docs, text_col, lang_col), least), "counts")
    return ranked(candidates(cut(compact(counts), "compacted"), counts), counts, top)


def ranked(found: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """Candidates that no longer phrase stands for, by the score of their worst cut."""
    kept = found.where("longer IS NULL OR CAST(100 AS decimal(3,0)) * CAST(longer AS decimal(19,0)) < CAST(80 AS decimal(3,0)) * CAST(a AS decimal(19,0))")
    score = "CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(19,0)) div (CAST(x.l AS decimal(19,0)) + CAST(x.r AS decimal(19,0)))"
    worst = F.expr(f"array_min(transform(cuts, (x, k) -> struct({score} AS score, k AS k, x.l AS l, x.r AS r)))")
    scored = kept.select("lang", "phrase", "a", worst.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")




#: The same in SQL: every phrase counted by itself, every cut and every longer phrase joined.
ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0
), total AS (
  SELECT lang, count(*) AS n FROM spots GROUP BY lang
), counts AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM spots, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2
), inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM cand), (VALUES (2), (3)) AS lengths(m)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.c, CAST(2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : c.c], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[c.c + 1 : c.k], ' ')
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), kept AS (
  SELECT w.* FROM worst w LEFT JOIN inside i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * w.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
