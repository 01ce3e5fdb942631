import hashlib
import random
from array import array

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from ledgerferry.llm import piecebpe
from ledgerferry.llm.queries import PIECES
from tests.llm.support import AWKWARD, documents, no_documents

PATH = public_tokenizers.path(PIECES)
ODD = [
    "\0", "\n" * 50, " " * 100, " " * 17 + "the", "▁" * 31, "a▁b", "ng" * 500, "the" * 4_000, "inging atio", "<s></s>", "<0x41>", "�",
    "日本語 한국어 ไทย 😀👍🏽", "a  b", " lead", "trail ", "é ́ ﬁ", "aaaaaaaa", "\t\t x\t",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piecebpe.Model(PATH)


def ids_of(library, text):
    return library.encode(text, add_bos=True, add_eos=True)


def test_ids_and_text_equal_the_library(spark, library):
    texts = [*AWKWARD, *ODD]
    encoded = piecebpe.encode(documents(spark, texts), PATH, decoded=True)
    rows = {r["doc_id"]: r for r in piecebpe.digest(encoded).collect()}
    apart = piecebpe.digest(piecebpe.decode(encoded.drop("text"), PATH, keep_ids=True)).collect()
    assert len(rows) == len(texts) and sorted(apart) == sorted(rows.values())
    for i, text in enumerate(texts):
        ids = ids_of(library, text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_an_empty_table(spark):
    assert piecebpe.digest(piecebpe.decode(piecebpe.encode(no_documents(spark), PATH), PATH, True)).collect() == []


def test_made_texts(model, library):
    rng = random.Random(1)
    parts = ["ing", "ng", "the", "th", " ", "  ", "e", "an", "▁", "\n", "日本", "é", "😀", "x", "ation", "atio", " fo", "for", "aa", "ab", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += [lead + " " * n + end for n in range(1, 70) for end in ("", "the", "門", "<") for lead in ("", "a")]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(32, 126), rng.randint(0xE000, 0x10FFFF)])) for _ in range(60)) for _ in range(200)]
    for text, ids in zip(texts, model.encode(pa.array(texts)), strict=True):
        assert array("I", ids).tolist() == ids_of(library, text), repr(text)


def test_the_rounds_alone(model, library):
    """Words through the merge rounds, none of them remembered, equal the library's."""
    rng = random.Random(2)
    words = sorted({" " + "".join(rng.choice("abeghinorst") for _ in range(rng.randint(1, 24))) for _ in range(3_000)})
    for word, ids in zip(words, model.encode_words(words), strict=True):
        assert [1, *array("I", ids), 2] == ids_of(library, word[1:])


def test_a_merge_that_makes_a_better_pair_comes_before_the_places_to_its_right(model, library):
    early = [n for n, e in zip(model.names, model.early, strict=False) if e and n.isalpha()][:300]
    words = [f" {a}{b}{a}{c}" for a in early for b, c in (("", ""), ("i", "s"), ("er", "e"))]
    for word, ids in zip(words, model.encode_words(words), strict=True):
        assert [1, *array("I", ids), 2] == ids_of(library, word[1:])


def test_ids_of_any_kind_decode_alike(model, library):
    rng = random.Random(3)
    rows = [[rng.choice([rng.randint(0, 2), rng.randint(3, 258), rng.randint(131, 258), rng.randint(259, 31_999), 259, 28_705]) for _ in range(rng.randint(0, 9))] for _ in range(2_000)]
    packed = pa.array([array("I", r).tobytes() for r in rows], pa.binary())
    assert model.decode_all(packed) == [library.decode(r) for r in rows]


def test_the_memory_of_words_is_bounded_and_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(piecebpe, "MEMO_WORDS", 20)
    text = " ".join(f"word{i} " + "z" * 100 for i in range(60))
    for _ in range(3):
        assert array("I", model.encode(pa.array([text, None]))[0]).tolist() == ids_of(library, text)
        assert all(len(w) <= piecebpe.MEMO_LETTERS for w in model.memo)


def test_a_long_text_is_cut_between_words(model, library):
    text = " start  of" + "naïve wörld  12 ends. " * 8_000
    assert array("I", model.encode(pa.array([text]))[0]).tolist() == ids_of(library, text)


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(piecebpe, "SLICE_BYTES", 10)
    batch = pa.record_batch([pa.array(range(5)), pa.array(["x" * 9, None, "y" * 30, "", "z"])], ["id", "text"])
    parts = [p.column(0).to_pylist() for p in piecebpe.by_bytes(batch)]
    assert sum(parts, []) == list(range(5)) and len(parts) > 1
