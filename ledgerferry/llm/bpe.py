"""BPE encoding and decoding with a bounded-lookahead streaming transducer.

The tokenizer file's merge list is read once per worker. Merging by rank has a local test: a
sequence is what the merges make of its symbols exactly if every neighbouring pair of tokens is
what they make of that pair. So the last token of every prefix can be found from the prefixes
within one token's length before it, and the transducer keeps these only: the merge list's
sufficient lookahead is the length of its longest token. All live prefixes descend from some
earlier one; what lies before their common ancestor cannot change any more and is emitted.

An automaton over the tokens' symbols tells which tokens end at a symbol, so one state stands for the
symbols before it. Words recur, so those up to
MEMO_LETTERS long are remembered, in two tables of bounded size: a full one is put away and its words
come back as they are met again. Every other word goes through the transducer.
Decoding is a state machine from token bytes to text that takes ids in blocks of any size.

Defined results: a null text counts as empty and has no tokens; rows are independent, so repeated
rows repeat; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import slices, small_batches, tidy, worker_held

#: The longest words that are remembered, and how many in each of the two tables.
MEMO_LETTERS, MEMO_WORDS = 64, 120_000
#: Steps of the automaton that are kept once they have been worked out.
STEPS = 300_000
#: A text is encoded in pieces of about so many characters, cut at white space.
PIECE = 1 << 16
END = "</w>"
SHIFT = 32


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, more = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else more))
        more += b not in plain
    return letters


class Tokenizer:
    """The file's vocabulary, merges and patterns."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.merges: dict[tuple[int, int], int] = {}  # of a pair: rank << SHIFT | token made
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair, made = (self.vocab[a], self.vocab[b]), self.vocab[a + b]
            self.merges[pair] = rank << SHIFT | made
            self.parts[made] = (*pair, rank)
        letters = byte_letters()
        self.inner = [self.vocab[x] for x in letters]
        self.last = [self.vocab[x + END] for x in letters]
        byte_of = {c: b for b, c in enumerate(letters)}
        #: An id's bytes in decoded text: the words it spells, or the token's own text as the library shows it.
        self.spelled = {i: t.encode() if t in self.special else bytes(byte_of[c] for c in t.removesuffix(END)) + b" " * t.endswith(END) for i, t in self.tokens.items()}
        self.shown = {i: t.encode() + b" " for i, t in self.tokens.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        symbols = {i: 1 for i in [*self.inner, *self.last]}
        for made, (a, b, _) in self.parts.items():
            symbols[made] = symbols[a] + symbols[b]
        #: The merge list's sufficient lookahead, in symbols.
        self.lookahead = max(symbols.values())
        self.symbols = symbols
        self._automaton()
        self.fits = lru_cache(maxsize=1 << 17)(self._fits)
        self.memo = Memo(self)

    def _automaton(self) -> None:
        """States are the beginnings of tokens; from state << SHIFT | symbol to the longest one that ends there."""
        self.step: dict[int, int] = {}
        token_at, by_depth = array("i", [-1]), {0: [(0, 0, 0)]}
        for token in self.symbols:
            state = 0
            for depth, symbol in enumerate(self._expand(token), 1):
                key = state << SHIFT | symbol
                after = self.step.get(key)
                if after is None:
                    after = self.step[key] = len(token_at)
                    token_at.append(-1)
                    by_depth.setdefault(depth, []).append((state, symbol, after))
                state = after
            token_at[state] = token
        # Of each state: the longest other beginning that it ends with, and the tokens that end there, longest first.
        self.shorter = array("i", bytes(4 * len(token_at)))
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(token_at)
        shared: dict[tuple, tuple] = {}
        for depth in range(1, len(by_depth)):
            for state, symbol, after in by_depth[depth]:
                self.shorter[after] = self._next(self.shorter[state], symbol) if state else 0
                own = ((token_at[after], depth),) if token_at[after] >= 0 else ()
                ending = own + self.ending[self.shorter[after]]
                self.ending[after] = shared.setdefault(ending, ending)

    def _next(self, state: int, symbol: int) -> int:
        """The state after a symbol, as far as tokens begin so."""
        step, at = self.step, state
        while (after := step.get(at << SHIFT | symbol)) is None:
            if not at:
                after = 0
                break
            at = self.shorter[at]
        return after

    def look_up(self, state: int, symbol: int) -> int:
        """The same for a state from which no token goes on so; what is found is kept."""
        after = self._next(state, symbol)
        if len(self.step) < STEPS:
            self.step[state << SHIFT | symbol] = after
        return after

    def _expand(self, token: int) -> tuple[int, ...]:
        if token not in self.parts:
            return (token,)
        a, b, _ = self.parts[token]
        return self._expand(a) + self._expand(b)

    def _fits(self, left: int, right: int) -> bool:
        """Do the merges leave these two tokens, side by side, as they are?

        The tokens are taken apart again, youngest merge first. A merge across the border breaks
        the pair if it comes before the merge just undone; of equal ones the left comes first.
        """
        limit = float("inf")
        while True:
            across = self.merges.get((left, right))
            if across is not None and across >> SHIFT < limit:
                return False
            rank_left, rank_right = (self.parts[x][2] if x in self.parts else -1 for x in (left, right))
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                limit, left = rank_left, self.parts[left][1]
            else:
                limit, right = rank_right + 1, self.parts[right][0]


class Transducer:
    """Tokens of one word, symbol by symbol; emit(...) gets each as soon as it is stable."""

    def __init__(self, tokenizer: Tokenizer, emit):
        self.t, self.emit = tokenizer, emit
        self.state = 0  # of the automaton: the last symbols, as far as a token could hold them
        self.at = 0  # symbols read
        # For each live prefix length: (last token, length of the prefix before it).
        self.links: dict[int, tuple[int, int]] = {}
        self.done = 0  # the prefix whose tokens are out

    def push(self, symbols: list[int]) -> None:
        t, links, state, at = self.t, self.links, self.state, self.at
        step, look_up, ending, fits, lookahead = t.step.get, t.look_up, t.ending, t.fits, t.lookahead
        for symbol in symbols:
            at += 1
            after = step(state << SHIFT | symbol)
            state = look_up(state, symbol) if after is None else after
            for token, length in ending[state]:
                before = at - length
                if not before:
                    links[at] = (token, 0)
                    break
                link = links.get(before)
                if link and fits(link[0], token):
                    links[at] = (token, before)
                    break
            if at % lookahead == 0:
                self.state, self.at = state, at
                self._settle()
                links = self.links
        self.state, self.at = state, at

    def _path(self, end: int) -> list[tuple[int, int]]:
        """(end, token) back from a prefix to what is already out."""
        path = []
        while end > self.done:
            token, before = self.links[end]
            path.append((end, token))
            end = before
        return path if end == self.done else []

    def _settle(self) -> None:
        """Emit what all prefixes within the lookahead share, and forget what lies before."""
        live = [end for end in range(max(self.done + 1, self.at - self.t.lookahead + 1), self.at + 1) if end in self.links]
        paths = [p for p in map(self._path, live) if p]
        if not paths or len(paths) < len(live):
            return
        shared = set(paths[-1]).intersection(*paths)
        for end, token in sorted(shared):
            self.emit(token)
            self.done = end
        keep = self.at - self.t.lookahead
        self.links = {k: v for k, v in self.links.items() if k >= min(keep, self.done) or k >= self.done}

    def finish(self) -> None:
        for _, token in reversed(self._path(self.at)):
            self.emit(token)


def normal(text: str) -> str:
    """NFC and lower case, letter by letter: a capital sigma at a word's end stays a plain one."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str) -> Iterator[str]:
    """The text cut before white space, which no word and no composed letter crosses."""
    start = 0
    while len(text) - start > PIECE:
        found = regex.search(r"[\x20\n]", text, pos=start + PIECE)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Memo(dict):
    """Ids of words met lately, as bytes."""

    def __init__(self, t: Tokenizer):
        super().__init__()
        self.t, self.old = t, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = word_ids(self.t, word)
        if len(word) <= MEMO_LETTERS:
            if len(self) >= MEMO_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


def word_ids(t: Tokenizer, word: str) -> bytes:
    raw = word.encode("utf-8", "replace")
    out = array("I")
    run = Transducer(t, out.append)
    inner, end = t.inner, len(raw) - 1
    for start in range(0, len(raw), PIECE):
        symbols = [inner[b] for b in raw[start : start + PIECE]]
        if start + PIECE > end:
            symbols[-1] = t.last[raw[end]]
        run.push(symbols)
    run.finish()
    return out.tobytes()


def encode_blocks(t: Tokenizer, text: str) -> Iterator[bytes]:
    """Ids of a text as little-endian unsigned 32-bit integers, block by block."""
    for k, part in enumerate(t.specials.split(text)) if t.specials and "<|" in text else [(0, text)]:
        if k % 2:
            yield array("I", [t.special[part]]).tobytes()
            continue
        for piece in pieces(part):
            words = t.words.findall(normal(piece))
            yield b"".join(map(t.memo.__getitem__, words))


class Decoder:
    """A state machine from ids to text, in blocks: each id's bytes go through an incremental UTF-8
    reader, whose state carries characters over token and block borders; white space is held back until
    more follows. `spaced`: the library's form, the tokens' own texts, each with white space after it;
    else the words themselves, white space after tokens that end one."""

    def __init__(self, t: Tokenizer, spaced: bool):
        self.bytes_of = t.shown if spaced else t.spelled
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.space = False

    def feed(self, ids: list[int]) -> str:
        of = self.bytes_of
        text = self.utf8.decode(b"".join([of[i] for i in ids]))
        if not text:
            return ""
        if self.space:
            text = " " + text
        self.space = text[-1] == " "
        return text[:-1] if self.space else text

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


def decode_text(t: Tokenizer, ids: bytes, spaced: bool) -> str:
    """The text of a row's ids, block by block."""
    decoder, numbers = Decoder(t, spaced), array("I", ids)
    return "".join([decoder.feed(numbers[i : i + PIECE].tolist()) for i in range(0, len(numbers), PIECE)]) + decoder.finish()


def tokenizer(path: str) -> Tokenizer:
    """One per worker."""
    return worker_held(__name__, path, lambda: Tokenizer(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """id and ids, the little-endian unsigned 32-bit numbers of a text's tokens.

    With `decoded`, the text that the ids decode to in the library's form as well: one pass and one
    worker for both.
    """
    names = ["id", "ids", "text"][: 2 + decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in slices(batches):
            ids = [b"".join(encode_blocks(t, text or "")) for text in batch.column(1).to_pylist()]
            texts = [pa.array([decode_text(t, x, True) for x in ids], pa.string())] if decoded else []
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), *texts], names)

    kind = docs.schema[id_col].dataType.simpleString()
    named = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named.mapInArrow(tidy(run), f"id {kind}, ids binary" + ", text string" * decoded)


def decode(encoded: DataFrame, path: str, spaced: bool = False, keep_ids: bool = False) -> DataFrame:
    """id and text (and ids, if kept) of encoded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in slices(batches):
            texts = [decode_text(t, ids or b"", spaced) for ids in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(texts, pa.string())]
            yield pa.record_batch([*columns, batch.column(1)] if keep_ids else columns, ["id", "text", "ids"][: 2 + keep_ids])

    kind = encoded.schema["id"].dataType.simpleString()
    return small_batches(encoded).select("id", "ids").mapInArrow(tidy(run), f"id {kind}, text string" + ", ids binary" * keep_ids)


def digest(decoded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Token counts and digests of decoded rows that kept their ids."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
        *["ids"] * keep_ids,
    )
