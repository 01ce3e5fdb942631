"""The registered queries of this package, each a thin layer over its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerferry.llm import bpe, collocations, covertree, jaccard, langid, mixing, neighbours, pages, piecebpe, secrets, templates, toxicity, whitening
from ledgerferry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return langid.digest(langid.predict(docs, model))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.train(secrets.training_samples(docs))))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = templates.with_probe(table(spark, sf_dir, "conversations"))
    return templates.read_back(templates.format_conversations(turns))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), f"id % {neighbours.EVERY} = 0")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.score(docs, network))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.digest(pages.extract(table(spark, sf_dir, "pages"), pages.train()))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(jaccard.join(table(spark, sf_dir, "documents")))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.digest(piecebpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), decoded=True))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {
    "op1_language": op1_language,
    "op2_secrets": op2_secrets,
    "op3_chat": op3_chat,
    "op4_neighbours": op4_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_near_vectors": op7_near_vectors,
    "op8_html": op8_html,
    "op9_bpe": op9_bpe,
    "op10_jaccard": op10_jaccard,
    "op11_pieces": op11_pieces,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}

#: What SQL can express.
ORACLES: dict[str, str] = {"op6_mixing": mixing.ORACLE, "op12_collocations": collocations.ORACLE}
