"""The registered queries of this package: each operator over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import bpe, chosenpath, decontam, divergence, language, lines, packing, repetition, sharding, spots, urls, variants, warc
from remitlens.llm.support import scratch


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), word_vocabulary())


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(table(spark, sf_dir, "documents"))


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.edited_likeness(table(spark, sf_dir, "documents"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_vocabulary())


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"), scratch(spark, "warc-raw"), scratch(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Fixed values of the contract: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op9_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    written = sharding.sharded(docs, scratch(spark, "shards"), 8)
    return written.select(
        "doc_id",
        sharding.size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_repetition": op2_repetition,
    "op3_chosen_path": op3_chosen_path,
    "op4_spots": op4_spots,
    "op5_lines": op5_lines,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_urls": op8_urls,
    "op9_shuffle": op9_shuffle,
    "op10_language": op10_language,
    "op11_divergence": op11_divergence,
    "op12_variants": op12_variants,
    "op13_decontam": op13_decontam,
}

ORACLE_SQL: dict[str, str] = {
    "op5_lines": lines.SQL,
    "op7_warc": warc.SQL,
    "op8_urls": urls.SQL,
    "op11_divergence": divergence.SQL,
    "op13_decontam": decontam.SQL,
}
