import public_tokenizers
import pytest

import corpus_pipeline as P
from ledgerferry.llm import bpe
from ledgerferry.llm.queries import ORACLES, QUERIES
from tests.llm.support import AWKWARD, documents, no_documents
from tests.llm.test_toxicity import prose


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with toxic texts, near copies, secrets and awkward rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    clean = [prose(80, i) for i in range(60)]
    texts = [*clean, *(prose(80, 1_000 + i, 4) for i in range(40)), *(clean[i] + " end" for i in range(10)), *clean[:5]]
    texts += ["token=abcdefgh12345678 " + prose(20, 5_000 + i) for i in range(5)] + AWKWARD
    ids = [*range(len(texts) - 1), None]
    docs = documents(spark, texts, ids)
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0, int(60 <= i < 100)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, texts


def test_stages_take_effect(spark, tables):
    path, texts = tables
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, path)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen[name] = rows
        if name != "encoding":
            assert docs.columns == list(P.COLUMNS), before.columns
    texts_of = {name: {r["doc_id"]: r["text"] for r in rows} for name, rows in seen.items() if name != "encoding"}
    assert not set(range(60, 100)) & set(texts_of["toxicity"]) and set(range(60)) <= set(texts_of["toxicity"])
    kept = set(texts_of["near_copies"])
    assert set(range(60)) <= kept and not set(range(100, 115)) & kept and None in kept
    assert all("abcdefgh12345678" not in (t or "") for t in texts_of["secrets"].values())
    assert set(texts_of["secrets"]) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secrets"] if r["text"] is not None)
    assert {r["doc_id"] for r in seen["mixing"]} <= kept
    t = bpe.tokenizer(public_tokenizers.path(P.TOKENIZER))
    for r in seen["encoding"][:20]:
        assert bytes(r["ids"]) == b"".join(bpe.encode_blocks(t, texts_of["secrets"][r["doc_id"]] or ""))
    assert len(seen["encoding"]) == len(seen["mixing"])


def test_the_whole_run_equals_its_stages(spark, tables):
    path, _ = tables
    out = P.run(spark, path)
    assert set(out.columns) >= {"doc_id", "n_tokens", "ids"} and out.count() > 60


def test_an_empty_corpus(spark, tmp_path):
    no_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_rows_that_share_an_id_and_a_text_leave_one(spark, tmp_path):
    docs = documents(spark, ["one text of five words here", "another text of its own kind", "one text of five words here", "x"], [1, 1, 1, None])
    rows = P.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows) == [(0, "x"), (1, "another text of its own kind"), (1, "one text of five words here")]


def test_unrelated_texts_that_share_an_id_stay(spark, tmp_path):
    copied = " ".join(f"w{i}" for i in range(40))
    texts = [
        (3, copied), (5, copied + " end"), (5, "a text of its own kind here"), (5, "a text of its own kind here"), (3, "one more that is nobody's copy"),
        (7, "this one has copies in its id"), (7, "This one has copies in its ID"), (5, None), (5, " \n"), (9, "\u0085"), (None, copied), (None, copied),
    ]
    docs = documents(spark, [t for _, t in texts], [i for i, _ in texts])
    rows = P.drop_near_copies(spark, docs, str(tmp_path)).collect()
    left = [texts[k] for k in (0, 2, 4, 6, 7, 8, 9, 10, 11)]
    assert sorted(map(repr, left)) == sorted(repr((r["doc_id"], r["text"])) for r in rows)


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
