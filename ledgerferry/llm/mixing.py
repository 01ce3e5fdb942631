"""Mixing sources to target weights by Poisson replication.

A source's mean repetition is its target share times the rows wanted, over its own rows. Each
document's count is the Poisson quantile, with that mean, of a uniform number hashed from seed
and id; the document is exploded by its count, and all copies are dealt out by another hash: a
global shuffle that every run repeats alike.

Defined results: a null source is a source of its own; a null id hashes as the empty text; rows of
one id get the same count each; an empty table gives no rows; columns of the input named copy,
repeats or shuffle_key are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import cut

#: Production parameters: a source's target share is in proportion to rows ** ALPHA, which evens
#: sources out; the mix has as many rows as the input, on average.
ALPHA = 0.5
SEED = "mix-1"
#: 13 hexadecimal digits make an exact double.
DIGITS = 13
#: Up to so many sources their table is broadcast (a few MB at most); beyond, it is joined by key.
BROADCAST_SOURCES = 10_000


def hashed(salt: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(f"{SEED}:{salt}"), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def uniform(digest: Column) -> Column:
    """A number in (0, 1) from hexadecimal digits."""
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k from 0, until what is left is below the last digit of any uniform number."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")

    def step(state: Column, k: Column) -> Column:
        log = F.when(k == 0, -mean).otherwise(state["log"] + F.log(mean) - F.log(k.cast("double")))
        total = state["total"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("total"), F.concat(state["cdf"], F.array(total)).alias("cdf"))

    first = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("cdf"))
    return F.aggregate(F.sequence(F.lit(0), last), first, step)["cdf"]


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None) -> DataFrame:
    """One row per source: source, n, mean repetition rate, cdf.

    `weights` names the target weight of each source (others get none); without it the weight
    is rows ** ALPHA.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(ALPHA))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    weighted = cut(counts.withColumn("weight", weight), "sources")
    total = weighted.agg(F.sum("weight"), F.sum("n")).first()
    scale = (total[1] or 0) / total[0] if total[0] else 0.0
    rate = weighted.withColumn("rate", F.col("weight") * scale / F.col("n"))
    return rate.select("source", "n", "rate", F.when(F.col("rate") > 0, poisson_cdf(F.col("rate"))).otherwise(F.array(F.lit(2.0))).alias("cdf"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict[str, float] | None = None) -> DataFrame:
    """All columns of the documents, plus copy (from 1), repeats and shuffle_key, in shuffled order.

    shuffle_key orders the result: partitions hold rising ranges of it and are sorted.
    """
    own = [c for c in docs.columns if c not in ("copy", "repeats", "shuffle_key")]
    rates = source_rates(docs, source_col, weights)
    few = rates.count() <= BROADCAST_SOURCES
    rates = rates.select(F.col("source").alias("__source"), F.col("cdf").alias("__cdf"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    found = held.join(F.broadcast(rates) if few else rates, F.col(f"row.`{source_col}`").eqNullSafe(F.col("__source")))
    doc_id = F.col(f"row.`{id_col}`")
    u = uniform(hashed("count", doc_id))
    # A count's copies are spread by their hash before anything is sorted.
    copies = found.select("row", F.size(F.filter("__cdf", lambda c: c <= u)).alias("repeats")).where("repeats > 0")
    copies = copies.select("row", "repeats", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"))
    keyed = copies.select(*[F.col(f"row.`{c}`").alias(c) for c in own], "copy", "repeats", hashed("order", doc_id, F.col("copy")).alias("shuffle_key"))
    # The key is uniform, so equal ranges of it are even: no pass over the rows samples it.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spot = F.floor(uniform(F.col("shuffle_key")) * parts).cast("int")
    return keyed.repartitionById(parts, spot).sortWithinPartitions("shuffle_key")


ORACLE = f"""
WITH n AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {ALPHA}) AS w FROM documents GROUP BY source),
r AS (SELECT source, w * ((SELECT sum(n) FROM n) / (SELECT sum(w) FROM n)) / n AS rate FROM n),
t AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
      FROM r, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT))) AS k)),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM t),
u AS (SELECT *, (('0x' || substr(md5('{SEED}:count:' || coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT::DOUBLE + 0.5)
        / {16**DIGITS}.0 AS u FROM documents),
x AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf <= u.u) AS repeats FROM u)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, repeats::INTEGER AS repeats,
       md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key
FROM x, LATERAL (SELECT unnest(generate_series(1, repeats)) AS copy)
"""
