"""Secret scans: fixed patterns, plus character Markov models compared by log-likelihood ratio.

Everything runs as SQL expressions. Three base patterns give spans; a fourth pattern gives
candidate strings, each scored as sum(log P_random(b|a) - log P_ordinary(b|a)) over its
character pairs. The two transition tables come from labelled samples: strings cut from
digests are random, words and joined words of a bounded sample of documents are ordinary.

Defined results: a null text counts as empty; a text without spans gives zero counts and empty
strings; rows are independent, so repeated rows and ids repeat; an empty table gives no rows and
a model of equal ratios, which finds nothing; further columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import bounded_sample

#: Fixed patterns, and the least length of what they have to hold.
ASSIGN_HEAD = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + "(?-i)([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 8
ACCESS = "AKIA[A-Z0-9]{12,}"  # a run of AKIA[A-Z0-9]+ of 16 characters or more
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

#: What a scored string consists of, its least length, and the least ratio for each pair in it.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_RATIO = 0.5
#: Symbols that a row of transitions is backed by.
BACK_OFF = 20
#: Bounds of the labelled samples.
SAMPLE_DOCS = 2_000
RANDOM_STRINGS = 20_000


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """The leftmost matches as structs (start, end, kind, value) in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rank = F.lit(KINDS.index(kind))
    kind_of = "array<struct<start:int,end:int,kind:int,value:string>>"

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        found = F.array(F.struct(start.alias("start"), end.alias("end"), rank.alias("kind"), pair["hit"].alias("value")))
        return F.struct(end.alias("at"), F.concat(state["found"], found.cast(kind_of)).alias("found"))

    # The last gap follows the last match.
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(kind_of).alias("found"))
    found = F.aggregate(pairs, first, step)["found"]
    found = F.when(F.size(hits) > 0, found).otherwise(F.array().cast(kind_of))
    return F.filter(found, keep) if keep else found


def _pairs(text: Column) -> Column:
    """Numbers of the neighbouring symbols of a text, first * symbols + second."""
    at = lambda i: F.instr(F.lit(SYMBOLS), text.substr(i, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: (at(i) - 1) * len(SYMBOLS) + at(i + 1) - 1)


def training_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled strings: (label 1 random or 0 ordinary, value)."""
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    random = spark.range(RANDOM_STRINGS).select(
        F.lit(1).alias("label"),
        F.when(F.col("id") % 3 == 0, digest)
        .when(F.col("id") % 3 == 1, F.base64(F.unhex(digest)))
        .otherwise(F.regexp_replace(F.upper(F.base64(F.unhex(digest))), "[^A-Z0-9]", ""))
        .alias("value"),
    )
    # Ids are chosen from narrow rows; the texts stay where they are.
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = bounded_sample(named.select("id"), F.struct(F.xxhash64("id"), "id"), SAMPLE_DOCS)
    sample = named.join(F.broadcast(chosen.distinct()), "id", "left_semi")
    # Words as they stand, and two neighbours joined as in identifiers.
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\b[A-Za-z][a-z]{3,18}\b"), F.lit(0))
    joined = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.concat(F.element_at("words", i), F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("")), (i % 3 + 1).cast("int")), F.element_at("words", i + 1)),
    )
    ordinary = sample.select(words.alias("words")).where(F.size("words") > 1).select(F.lit(0).alias("label"), F.explode(joined).alias("value"))
    return random.unionByName(ordinary)


def train(samples: DataFrame) -> list[float]:
    """log P_random(b|a) - log P_ordinary(b|a) for every pair of symbols.

    Each row of transitions leans on the class's own symbol frequencies (with one of each symbol
    added) as if BACK_OFF of them had been seen, so symbols a class hardly has stay rare in it.
    """
    counts = samples.where(F.length("value") > 1).select("label", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("label", "pair").count()
    n = len(SYMBOLS)
    seen = [[0] * (n * n), [0] * (n * n)]
    for row in counts.collect():  # at most two tables of n * n
        if 0 <= row["pair"] < n * n:
            seen[row["label"]][row["pair"]] = row["count"]
    if not all(map(sum, seen)):
        return [0.0] * (n * n)  # a class without samples says nothing
    logs = []
    for x in seen:
        single = [1 + sum(x[b::n]) for b in range(n)]
        total = [sum(x[a * n : a * n + n]) for a in range(n)]
        logs.append([math.log((x[i] + BACK_OFF * single[i % n] / sum(single)) / (total[i // n] + BACK_OFF)) for i in range(n * n)])
    return [r - o for r, o in zip(logs[1], logs[0], strict=True)]


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and `found`, an array of (start, end, kind, value) by start.

    Strings by the models are added only where they overlap no span of the fixed patterns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    table = F.transform(F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ","), lambda x: x.cast("double"))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id",
        F.concat(
            _spans(F.col("text"), ASSIGN, "assign", lambda s: F.length(F.regexp_replace(s["value"], "^" + ASSIGN_HEAD, "")) >= ASSIGN_LEAST),
            _spans(F.col("text"), ACCESS, "access"),
            _spans(F.col("text"), HEX, "hex"),
        ).alias("base"),
        _spans(F.col("text"), CANDIDATE, "random").alias("strings"),
    )

    def random(span: Column) -> Column:
        ratio = F.aggregate(_pairs(span["value"]), F.lit(0.0), lambda total, pair: total + F.get(table, pair))
        return ratio >= LEAST_RATIO * (F.length(span["value"]) - 1)

    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.filter(F.filter("strings", apart), random)
    return base.select("id", F.array_sort(F.concat("base", more)).alias("found"))


def _listed(found: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the fixed patterns, the digest of their spans, and all spans as a string."""
    base = F.filter("found", lambda s: s["kind"] < 3)
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        n("random").alias("n_random"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by `mark`; all columns and rows stay.

    Overlapping spans are replaced together. The spans are found and used in the same row, so
    no join is needed.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = scan(docs.select(held, text.alias("text")), ratios, "row", "text").withColumnRenamed("id", "row")

    def step(state: Column, span: Column) -> Column:
        gap = F.substring("whole", state["at"] + 1, F.greatest(F.lit(0), span["start"] - state["at"]))
        new = span["start"] >= state["at"]
        out = F.concat(state["out"], F.when(new, F.array(gap, F.lit(mark))).otherwise(F.array().cast("array<string>")))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    whole = found.select("row", "found", F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).alias("whole"))
    done = F.aggregate("found", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring("whole", s["at"] + 1, F.length("whole")))
    clean = F.when(F.size("found") == 0, F.col(f"row.`{text_col}`")).otherwise(rest(done))
    return whole.select(*[(clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
