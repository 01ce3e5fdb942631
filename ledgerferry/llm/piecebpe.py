"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The words of many texts lie side by side in flat numpy arrays: a symbol, its word, and the rank of
the pair it forms with the next symbol. A round takes the least pair rank of every word (a
segmented minimum), merges all places that have it, leftmost first and without overlap, and closes
the gaps. Words without a pair left leave the arrays. Rounds end when no word remains.

Merging several places of a word at once equals merging them one by one, unless a merge makes a
pair of the same or a better rank, which would come before the places to its right. So of a word's
places only those up to the first such merge take part in a round. Which pieces can be made so
(`early`) is known from the model; only for them the new pairs are looked up.

Words start at a white space that follows something else, as no piece holds one inside, and at
neighbouring letters that no piece holds side by side; runs of white space are cut after the longest
piece of them. A model in which that is not so is read as one word. Words met before are
remembered in a table of bounded size, all others go through the rounds.

Decoding joins the pieces' bytes; bytes of byte pieces that are no UTF-8 become U+FFFD one by one.

Defined results: a null text counts as empty and has the begin and end ids only; rows are
independent, so repeated rows repeat; an empty table gives no rows; further columns of the input
are ignored. Models other than BPE with byte fallback and plain white space handling are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import small_batches, tidy, worker_held

SPACE = "▁"
NONE = np.int32(np.iinfo(np.int32).max)
#: Words that a worker remembers, and their longest.
MEMO_WORDS, MEMO_LETTERS = 120_000, 64
#: A text is encoded in pieces of about so many characters, and so many characters go through the rounds together.
PIECE = 1 << 16
#: Bytes of text that a task holds as Python objects at a time (one text at least).
SLICE_BYTES = 1 << 20
#: Slots of a hash table of pairs.
SLOTS = 1 << 20
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at : at + size]
        at += size


def _slot(keys: np.ndarray, level: int) -> np.ndarray:
    """Slot of each pair in the table of a level."""
    return ((keys * (0x9E3779B97F4A7C15 + 2 * level - (1 << 64))) >> 40) & (SLOTS - 1)


def _hashed(keys: np.ndarray) -> list[np.ndarray]:
    """Tables from slot to place in keys (-1: empty); pairs that share a slot go on to the next table."""
    levels, left = [], np.arange(len(keys))
    while len(left) or not levels:
        slots = np.full(SLOTS, -1, np.int32)
        at, one = np.unique(_slot(keys[left], len(levels)), return_index=True)
        slots[at] = left[one]
        left = np.delete(left, one)
        levels.append(slots)
    return levels


class Model:
    """A model file: pieces, the pairs that make them, and what words can be cut at."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        trainer = dict(_fields(next(v for n, v in message if n == 2)))
        normalizer = dict(_fields(next(v for n, v in message if n == 3)))
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or not plain:
            raise ValueError("only BPE models with byte fallback and plain white space are supported")
        rows = [dict(_fields(v)) for n, v in message if n == 1]
        self.names = [r[1].decode() for r in rows]
        self.kinds = [r.get(3, NORMAL) for r in rows]
        if not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        scores = np.array([struct.unpack("<f", r.get(2, b"\0\0\0\0"))[0] for r in rows])
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.byte_ids = np.zeros(256, np.int32)
        for i, (name, kind) in enumerate(zip(self.names, self.kinds, strict=True)):
            if kind == BYTE:
                self.byte_ids[int(name[1:-1], 16)] = i
        unknown = trainer.get(44, b" \xe2\x81\x87 ")
        self.surface = [
            {CONTROL: b"", UNKNOWN: unknown, BYTE: bytes([int(name[1:-1], 16)]) if kind == BYTE else b""}.get(kind, name.replace(SPACE, " ").encode())
            for name, kind in zip(self.names, self.kinds, strict=True)
        ]
        self.surfaces = pa.array(self.surface, pa.large_binary())
        self.is_control = np.array(self.kinds) == CONTROL
        self._pairs(scores)
        self._borders()
        self.memo: dict[str, bytes] = {}

    def _pairs(self, scores: np.ndarray) -> None:
        """Symbols are pieces, then letters that are no piece of their own, then all other code points."""
        symbol = {n: i for i, (n, k) in enumerate(zip(self.names, self.kinds, strict=True)) if k == NORMAL}
        pieces = list(symbol)
        for letter in sorted({c for p in pieces for c in p}):
            symbol.setdefault(letter, len(self.names) + len(symbol))
        self.other = max(symbol.values(), default=0) + len(self.names) + 1
        self.width = self.other + 0x110000
        self.letter = np.arange(self.other, self.width, dtype=np.int32)
        for text, i in symbol.items():
            if len(text) == 1:
                self.letter[ord(text)] = i
        self.letter[ord(" ")] = self.letter[ord(SPACE)]
        self.code = {i: ord(t) for t, i in symbol.items() if len(t) == 1 and i >= len(self.names)}
        _, rank = np.unique(-scores, return_inverse=True)
        keys, ranks, made = [], [], []
        self.early = np.zeros(self.width, bool)
        for piece in pieces:
            i = symbol[piece]
            for k in range(1, len(piece)):
                left, right = symbol.get(piece[:k]), symbol.get(piece[k:])
                if left is None or right is None:
                    continue
                keys.append(left * self.width + right)
                ranks.append(rank[i])
                made.append(i)
                for part in (left, right):
                    if part < len(rank) and len(self.names[part]) > 1 and rank[i] <= rank[part]:
                        self.early[part] = True
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.made = np.array(made, np.int32)[order]
        self.levels = _hashed(self.keys)
        letters = sorted({c for p in pieces for c in p})
        self.near = np.zeros(self.width, np.int32)  # a small number for each letter of a piece, 0 for all others
        for i, c in enumerate(letters):
            self.near[self.letter[ord(c)]] = i + 1
        self.inside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in {(a, b) for p in pieces for a, b in zip(p, p[1:])}:
            self.inside[self.near[self.letter[ord(a)]], self.near[self.letter[ord(b)]]] = True

    def _borders(self) -> None:
        pieces = [n for n, k in zip(self.names, self.kinds, strict=True) if k == NORMAL]
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        runs = [len(p) for p in pieces if not p.strip(SPACE)]
        longest = max(runs, default=1)
        left_alone = not any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in pieces)
        space = self.letter[ord(" ")]
        whole = longest == 1 or len(self.rounds(np.full(longest, space, np.int32), np.array([0], np.int64))[0]) == 1
        cut = f" {{{longest}}}(?= )|" if left_alone and whole else ""
        self.words = re.compile(f"{cut} *[^ ]+| +") if self.apart else re.compile(r"(?s).+")
        self.border = re.compile(r"(?<! ) ") if self.apart else None

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no pair) and piece made, of pairs of symbols."""
        key = left.astype(np.int64) * self.width + right
        rank, made, asked = np.full(len(key), NONE, np.int32), np.zeros(len(key), np.int32), None
        for k, slots in enumerate(self.levels):
            at = slots[_slot(key, k)]
            hit = np.flatnonzero(at >= 0)
            at = at[hit]
            same = self.keys[at] == key[hit]
            place, at = hit[same] if asked is None else asked[hit[same]], at[same]
            rank[place], made[place] = self.ranks[at], self.made[at]
            # A pair whose slot holds another one may be in the next table.
            rest = hit[~same]
            asked, key = rest if asked is None else asked[rest], key[rest]
            if not len(key):
                break
        return rank, made

    def rounds(self, sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, in order, and the number of them for each word.

        sym holds the letters of all words, starts where each word begins.
        """
        total = len(sym)
        if not total:
            return sym, np.zeros(len(starts), np.int64)
        first = np.zeros(total, bool)
        first[starts] = True
        if total > 1:
            near = self.near[sym]
            first[1:] |= ~self.inside[near[:-1], near[1:]]
        seg, pos = np.cumsum(first), np.arange(total)
        rank, made = self._look(sym, np.append(sym[1:], 0))
        rank[np.append(first[1:], True)] = NONE
        out_pos, out_sym = [], []
        while len(sym):
            heads = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(sym))))
            live = best < NONE
            if not live.all():
                out_pos.append(pos[~live])
                out_sym.append(sym[~live])
                sym, seg, pos, rank, made, best = (x[live] for x in (sym, seg, pos, rank, made, best))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            # Of places that overlap, every second one, from the left.
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            at = self._before_better(sym, seg, rank, made, at)
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym[at] = made[at]
            at = at - np.arange(len(at))
            sym, seg, pos, rank, made = (x[keep] for x in (sym, seg, pos, rank, made))
            touched = np.zeros(len(sym) + 1, bool)
            touched[at] = touched[at - 1] = True  # -1 is the spare last place
            changed = np.flatnonzero(touched[:-1])
            after = np.minimum(changed + 1, len(sym) - 1)
            rank[changed], made[changed] = self._look(sym[changed], sym[after])
            rank[changed[(after == changed) | (seg[after] != seg[changed])]] = NONE
        pos, sym = np.concatenate(out_pos), np.concatenate(out_sym)
        order = np.argsort(pos, kind="stable")
        pos, sym = pos[order], sym[order]
        return sym, np.diff(np.append(np.searchsorted(pos, starts), len(pos)))

    def _before_better(self, sym: np.ndarray, seg: np.ndarray, rank: np.ndarray, made: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The places up to each word's first that makes a pair of the same or a better rank."""
        asked = np.flatnonzero(self.early[made[at]])
        if not len(asked):
            return at
        here, own = at[asked], rank[at[asked]]
        # A place that ends just before has been merged by then; what comes after has not.
        before, after = np.maximum(here - 1, 0), np.minimum(here + 2, len(sym) - 1)
        previous = np.maximum(asked - 1, 0)
        merged = (asked > 0) & (at[previous] + 2 == here)
        left = np.where(merged, made[at[previous]], sym[before])
        near = np.where(merged, seg[at[previous]], seg[before])
        to_left = np.where((here > 0) & (near == seg[here]), self._look(left, made[here])[0], NONE)
        to_right = np.where((here + 2 < len(sym)) & (seg[after] == seg[here]), self._look(made[here], sym[after])[0], NONE)
        stops = np.zeros(len(at), np.int64)
        stops[asked] = (to_left <= own) | (to_right <= own)
        passed = np.cumsum(stops) - stops
        word = seg[at]
        head = np.maximum.accumulate(np.where(np.append(True, word[1:] != word[:-1]), np.arange(len(at)), 0))
        return at[passed == passed[head]]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        letters = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
        lengths = np.array([len(w) for w in words], np.int64)
        sym, counts = self.rounds(self.letter[letters], np.cumsum(lengths) - lengths)
        strange = np.flatnonzero(sym >= len(self.names))
        if len(strange):  # letters without a piece, as their bytes
            grown, width = [], np.ones(len(sym), np.int64)
            for i in strange:
                raw = chr(self.code.get(int(sym[i]), int(sym[i]) - self.other)).encode("utf-8", "replace")
                grown.append(self.byte_ids[list(raw)])
                width[i] = len(raw)
            ends = np.cumsum(np.append(0, counts))
            counts = np.add.reduceat(np.append(width, 0), ends[:-1]) if len(counts) else counts
            is_byte = np.repeat(sym >= len(self.names), width)
            sym = np.repeat(sym, width)
            sym[is_byte] = np.concatenate(grown)
        raw = sym.astype("<u4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _cut(self, text: str) -> Iterator[str]:
        """A long text in pieces that end where a word ends."""
        start = 0
        while self.border and len(text) - start > PIECE:
            found = self.border.search(text, start + PIECE)
            if not found:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def ids_of(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word: remembered ones, and through the rounds those not met before."""
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        known = {w: self.memo[w] for w in words if w in self.memo}
        fresh, letters = [], 0
        for word in (w for w in words if w not in known):
            fresh.append(word)
            letters += len(word)
            if letters >= PIECE:
                known.update(zip(fresh, self.encode_words(fresh), strict=True))
                fresh, letters = [], 0
        if fresh:
            known.update(zip(fresh, self.encode_words(fresh), strict=True))
        if len(self.memo) < MEMO_WORDS:
            self.memo.update(known if max(map(len, known), default=0) <= MEMO_LETTERS else {w: x for w, x in known.items() if len(w) <= MEMO_LETTERS})
        return known

    def encode_any(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without begin and end, whatever their white space."""
        split = [[self.words.findall(piece) for piece in self._cut(" " + t if t else "")] for t in texts]
        known = self.ids_of(list(set(chain.from_iterable(chain.from_iterable(split)))))
        return [b"".join([known[w] for words in pieces for w in words]) for pieces in split]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text between the begin and the end id."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        odd = pc.match_substring_regex(texts, "^$|^ |  | $")
        odd = odd.to_numpy(zero_copy_only=False) if self.apart else np.ones(len(texts), bool)
        rest = np.flatnonzero(odd)
        found = dict(zip(rest.tolist(), self.encode_any(texts.take(pa.array(rest)).to_pylist()), strict=True))
        if not odd.all():  # one white space before each word, so words are what lies between
            rows = np.flatnonzero(~odd)
            lists = pc.split_pattern(texts.take(pa.array(rows)), " ")
            coded = lists.flatten().dictionary_encode()
            words = [" " + w for w in coded.dictionary.to_pylist()]
            known = self.ids_of(words)
            flat = pa.array([known[w] for w in words], pa.large_binary()).take(coded.indices)
            _, offsets, data = flat.buffers()
            ends = np.frombuffer(offsets, np.int64)[lists.offsets.to_numpy()].tolist()
            raw = data.to_pybytes()
            found |= {row: raw[a:b] for row, a, b in zip(rows.tolist(), ends, ends[1:])}
        begin, end = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        return [begin + found[i] + end for i in range(len(texts))]

    def decode_all(self, ids: pa.Array) -> list[str]:
        """The texts of many rows of ids."""
        rows = [x or b"" for x in ids.to_pylist()]
        flat = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
        ends = np.cumsum([0, *(len(x) // 4 for x in rows)])
        control = self.is_control[flat]
        kept = flat[~control]
        joined = self.surfaces.take(pa.array(kept))
        _, offsets, data = joined.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(kept) + 1] if len(kept) else np.zeros(1, np.int64)
        raw = data.to_pybytes() if data else b""
        before = np.cumsum(np.append(0, ~control))[ends]
        texts = []
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            c, d = before[k], before[k + 1]
            part = raw[at[c] : at[d]]
            start = a + int(control[a:b].argmin()) if b > a else a
            # Control pieces inside the text, or bytes that are no UTF-8, take the way piece by piece.
            if not control[start : start + d - c].any():
                try:
                    texts.append(part.decode()[bool(d > c and self.kinds[kept[c]] == NORMAL and part.startswith(b" ")) :])
                    continue
                except UnicodeDecodeError:
                    pass
            texts.append(self.decode(flat[a:b].tolist()))
        return texts

    def decode(self, ids: list[int]) -> str:
        """Text of ids. The white space put before a text goes; control pieces have no text."""
        shown = next((i for i in ids if self.kinds[i] != CONTROL), -1)
        cut = shown >= 0 and self.kinds[shown] == NORMAL and self.surface[shown].startswith(b" ")
        parts, run = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                run += self.surface[i]
                continue
            parts.append(_loose(bytes(run)))
            run.clear()
            if i >= 0:
                parts.append(self.surface[i].decode())
        return "".join(parts)[cut:]


def _loose(raw: bytes) -> str:
    """UTF-8, each byte that is none of it as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def model(path: str) -> Model:
    """One per worker."""
    return worker_held(__name__, path, lambda: Model(path))


def by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where its texts (second column) pass SLICE_BYTES together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """id and ids, the little-endian unsigned 32-bit numbers of a text's pieces between begin and end.

    With `decoded`, the text that the ids decode to as well: one pass and one worker for both.
    """
    names = ["id", "ids", "text"][: 2 + decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in by_bytes(batch):
                ids = pa.array(m.encode(part.column(1)), pa.binary())
                texts = [pa.array(m.decode_all(ids), pa.string())] if decoded else []
                yield pa.record_batch([part.column(0), ids, *texts], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, ids binary" + ", text string" * decoded)


def decode(encoded: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """id and text (and ids, if kept) of encoded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in by_bytes(batch):
                columns = [part.column(0), pa.array(m.decode_all(part.column(1)), pa.string())]
                yield pa.record_batch([*columns, part.column(1)] if keep_ids else columns, ["id", "text", "ids"][: 2 + keep_ids])

    kind = encoded.schema["id"].dataType.simpleString()
    return small_batches(encoded).select("id", "ids").mapInArrow(tidy(run), f"id {kind}, text string" + ", ids binary" * keep_ids)


def digest(decoded: DataFrame) -> DataFrame:
    """Piece counts and digests of decoded rows that kept their ids."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
