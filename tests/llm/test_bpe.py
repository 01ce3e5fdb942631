import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerferry.llm import bpe
from ledgerferry.llm.queries import TOKENIZER
from tests.llm.support import AWKWARD, documents, no_documents

PATH = public_tokenizers.path(TOKENIZER)
ODD = [
    "İstanbul ΣΑΣ Σ", "don't we'll I'm x²½ Ⅷ", "a<|endoftext|>b <|startoftext|> <|x|>", "é ́ ﬁ ǅ", "q\x85z\x1cq᠎",
    "😀😃👍🏽 日本語 한국어 ไทย", "ab" * 500 + "!" * 200, "12 345", "\x00\x01", "ÀÉÎ" * 80, "the" * 400, "zz" * 333 + " end", "ü" * 129,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(spark, library):
    texts = [*AWKWARD, *ODD]
    encoded = bpe.encode(documents(spark, texts), PATH, decoded=True)
    rows = {r["doc_id"]: r for r in bpe.digest(encoded).collect()}
    apart = bpe.digest(bpe.decode(encoded.drop("text"), PATH, spaced=True, keep_ids=True)).collect()
    assert sorted(apart) == sorted(rows.values())
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        said = library.decode(ids, skip_special_tokens=False)
        assert rows[i]["decoded_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_an_empty_table(spark):
    assert bpe.digest(bpe.decode(bpe.encode(no_documents(spark), PATH), PATH, True, True)).collect() == []


def test_text_comes_back_up_to_spaces_and_case(spark):
    texts = ["Hello, wörld 42!", "日本語 😀 x", ""]
    back = {r["id"]: r["text"] for r in bpe.decode(bpe.encode(documents(spark, texts), PATH), PATH).collect()}
    assert ["".join(back[i].split()) for i in range(3)] == ["".join(t.lower().split()) for t in texts]


def merged(t, ids):
    """The merges applied by rank, leftmost first."""
    while True:
        ranks = [t.merges.get(pair, 1 << 62) for pair in zip(ids, ids[1:])]
        if not ranks or min(ranks) == 1 << 62:
            return ids
        i = ranks.index(min(ranks))
        ids = [*ids[:i], min(ranks) & ((1 << bpe.SHIFT) - 1), *ids[i + 2 :]]


def test_every_word_not_remembered_goes_through_the_transducer(monkeypatch):
    fed = []
    push = bpe.Transducer.push
    monkeypatch.setattr(bpe.Transducer, "push", lambda self, symbols: (fed.append(len(symbols)), push(self, symbols))[1])
    t = bpe.Tokenizer(PATH)
    text = "the cat sat on the mat, " * 50 + "q" * 500
    words = t.words.findall(bpe.normal(text))
    b"".join(bpe.encode_blocks(t, text))
    assert sum(fed) == sum(len(w.encode()) for w in set(words)) and len(set(words)) < len(words)


def test_words_come_back_from_the_table_put_away(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 10)
    t = bpe.Tokenizer(PATH)
    text = " ".join(f"word{i % 23} the" for i in range(300))
    assert array("I", b"".join(bpe.encode_blocks(t, text))).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(t.memo) <= 10 and len(t.memo.old) <= 10


def test_the_transducer_emits_what_merging_gives_with_bounded_memory():
    t, rng = bpe.tokenizer(PATH), random.Random(3)
    parts = ["th", "e", "an", "in", "ing", "er", "zz", "x", "ö", "s", "abc", "ba", "tion"]
    for _ in range(400):
        raw = "".join(rng.choice(parts) for _ in range(rng.randint(1, 80))).encode()
        out = []
        run = bpe.Transducer(t, out.append)
        symbols = [t.inner[b] for b in raw[:-1]] + [t.last[raw[-1]]]
        for s in symbols:
            run.push([s])
            assert len(run.links) <= 8 * t.lookahead
        run.finish()
        assert out == merged(t, symbols)
    out = []
    run = bpe.Transducer(t, out.append)
    for b in b"the" * 5_000:
        run.push([t.inner[b]])
        assert len(run.links) <= 8 * t.lookahead
    assert len(out) > 4_000


def test_blocks_of_any_size_decode_alike():
    t = bpe.tokenizer(PATH)
    ids = array("I", b"".join(bpe.encode_blocks(t, "日本語 😀 naïve wörld"))).tolist()
    for spaced in (True, False):
        whole = bpe.Decoder(t, spaced)
        expected = whole.feed(ids) + whole.finish()
        for size in (1, 2, 3):
            d = bpe.Decoder(t, spaced)
            assert "".join(d.feed(ids[i : i + size]) for i in range(0, len(ids), size)) + d.finish() == expected


def test_a_text_longer_than_a_piece(library):
    text = "naïve wörld's 12 ends. " * 6_000
    t = bpe.tokenizer(PATH)
    assert array("I", b"".join(bpe.encode_blocks(t, text))).tolist() == library.encode(text, add_special_tokens=False).ids
