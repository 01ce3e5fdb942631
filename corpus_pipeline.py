"""The corpus pipeline: five stages over documents, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerferry.llm import bpe, jaccard, mixing, secrets, toxicity
from ledgerferry.llm.common import cut, table
from ledgerferry.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go. The score is set beside each row, so no join is needed."""
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), network)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays: the one with the least id.

    Links are between texts, so rows that share an id are copies only if their texts are linked. Of
    linked texts with the least id, and then of rows with one set of shingles, the least stays. Rows
    without an id or without words are linked with nothing and stay.
    """
    kept = jaccard.join(docs).where("id = component AND class = first").select(F.col("id").alias("doc_id"), "class").distinct()
    rest = [c for c in COLUMNS if c != "doc_id"]
    rows = docs.select(*COLUMNS)
    alone = F.col("doc_id").isNull() | F.coalesce("text", F.lit("")).rlike(r"^[\t-\r ]*+\z")
    first = jaccard.with_class(rows.where(~alone)).groupBy("doc_id", "class").agg(F.min(F.struct(*rest)).alias("row"))
    return first.join(kept, ["doc_id", "class"], "left_semi").select("doc_id", "row.*").select(*COLUMNS).unionByName(rows.where(alone))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets are replaced by a mark; every document stays."""
    clean = secrets.redact(docs.select(*COLUMNS), secrets.train(secrets.training_samples(docs)))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, shuffled."""
    return mixing.mix(docs).select(*COLUMNS)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of what they decode to."""
    return bpe.digest(bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_text),
]

#: SQL cannot express the learned stages nor the encoding; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
