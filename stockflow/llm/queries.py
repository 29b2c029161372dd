"""Registered queries of the operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (
    decontaminate,
    hard_negatives,
    host_rules,
    lm,
    mixing,
    oracle,
    packing,
    page_text,
    secret_scan,
    simhash_dedup,
    site_lines,
    top_products,
    warc,
    word_runs,
)
from stockflow.llm.ship import ship
from stockflow.llm.words import WORD
from stockflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE = {
    "op3_host_rules": oracle.HOST_RULES,
    "op8_site_lines": oracle.SITE_LINES,
    "op11_threshold_top": oracle.TOP_PRODUCTS,
    "op13_kronecker_negatives": oracle.HARD_NEGATIVES,
}


def query(function):
    """Register a query under its function's name."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = prepared
    return prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_elias_fano_lm(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_warc_salvage(spark, sf_dir):
    archives = warc.write(table(spark, sf_dir, "pages"))
    records = warc.read(archives).where("kind = 'record'")
    return records.select(
        warc.key_of("record_id").cast("bigint").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        warc.key_of("refers_to").cast("bigint").alias("refers_to"),
    )


@query
def op3_host_rules(spark, sf_dir):
    found = host_rules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )


@query
def op4_entropy_mix(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
    )


@query
def op5_packed_ids(spark, sf_dir):
    return packing.write_packed(table(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark, sf_dir):
    found = decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


@query
def op7_secret_owners(spark, sf_dir):
    found = secret_scan.scan(
        table(spark, sf_dir, "documents"),
        repository=F.concat_ws("/", "source", "lang"),
        owner=F.col("source"),
    )
    return found.withColumnRenamed("id", "doc_id")


@query
def op8_site_lines(spark, sf_dir):
    found = site_lines.without_boilerplate(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "text", "n_lines", "n_dropped")


@query
def op9_page_text(spark, sf_dir):
    found = page_text.extract(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


@query
def op10_simhash_bk(spark, sf_dir):
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op11_threshold_top(spark, sf_dir):
    found = top_products.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op12_word_runs(spark, sf_dir):
    found = word_runs.find(planted(table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"]),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    length, start, period = longest["length"], longest["start"], longest["period"]
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts repeat a stretch of words up to their end.

    With h the crc32 of the id, g = h / 10 and n words, texts whose h ends in 0 repeat the
    1 + (n - a) / (3 + g % 8) words from a = g % n on.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g, words = F.floor(h / 10), F.col("words")
    n, a, p = F.size("words"), F.col("a"), F.col("p")
    unit = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), 1, n - a)
    return (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0)))
        .withColumn("a", F.when(n > 0, F.pmod(g, n)).cast("int"))
        .withColumn("p", (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int"))
        .select(
            "doc_id",
            F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " "))
            .otherwise(F.col("text"))
            .alias("text"),
        )
    )


@query
def op13_kronecker_negatives(spark, sf_dir):
    label = F.col("label").cast("bigint")
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"),
        F.col("vec_id") % 100 == 0,
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label),
    )
