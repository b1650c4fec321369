"""The numbered queries of this package and their checks in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.llm import (
    benchmarks,
    captures,
    languages,
    licences,
    mixing,
    neighbours,
    periods,
    quality,
    ranking,
    setsketch,
    substrings,
    tokens,
    toxicity,
)
from nightledger.llm.frames import table
from nightledger.llm.oracles import CAPTURES, ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that an earlier document has in the same window of 13 words."""
    return substrings.repeated_words(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in benchmark windows, and whether it is contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = benchmarks.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notice of each document."""
    return licences.licence_notices(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document so that every source comes to its target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).drop("copies", "key")


@query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose shingle sets are similar to 75 percent."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of a capture log over all pages, with the response it stands for."""
    pages = table(spark, sf_dir, "pages")
    log = CAPTURES.format(pages="{pages}", digest="html", turns="explode(sequence(1, 3))")
    rows = spark.sql(log, pages=pages)
    names = ["etag", "last_modified", "date", "cache_control", "content_type", "content_length"]
    pairs = F.array(*[F.struct(F.lit(n.replace("_", "-")).alias("k"), F.col(n).alias("v")) for n in names])
    headers = F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))
    found = captures.resolve_revisits(rows.withColumn("headers", headers))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e.key, F.lit(": "), e.value))
    shown = found.withColumn("headers", F.array_join(lines, "; ")).withColumn("payload", F.sha2("payload", 256))
    return shown.withColumn("response_id", F.coalesce("response_id", F.lit(-1)))  # -1: none


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def _folded(words: Column, h: Column) -> Column:
    """Words of a document of fold 0 with a tail that repeats, joined by one blank; those of others unchanged."""

    def fold(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x))
        return F.array_join(F.when((h % 10 == 0) & (n > 0), tail).otherwise(w), " ")

    return F.element_at(F.transform(F.array(words), fold), 1)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in each document, the tails of a tenth of them made periodic first."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(h % 10 == 0, _folded(words, h)).otherwise(F.col("text"))
    found = periods.periodic_runs(docs.select("doc_id", text.alias("text")))
    none = F.lit(None).cast(periods.RUN_TYPE)

    def better(best: Column, run: Column) -> Column:
        more = run.length.cast("long") * best.period > best.length.cast("long") * run.period
        return F.when(best.isNull() | more, run).otherwise(best)

    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    length, period = F.col("best.length").cast("long"), F.col("best.period").cast("long")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").cast("long").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * CAST(best.length AS BIGINT) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that score highest for each benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ranking.ranked(docs, table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by character language models."""
    return languages.identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


__all__ = ["ORACLES", "QUERIES"]
