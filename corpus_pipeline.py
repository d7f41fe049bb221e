"""From ``documents`` to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import chosenpath, language, lines, packing, repetition
from remitlens.llm.queries import table, word_vocabulary
from remitlens.llm.support import saved


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on."""
    return language.in_known_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return repetition.of_good_quality(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them; null texts stay null."""
    found = lines.deduplicated(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    changed = {"text": text} | ({"n_chars": F.char_length(text).cast("long")} if "n_chars" in docs.columns else {})
    return found.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; rows without doc_id stay."""
    kept = chosenpath.near_duplicates(docs).where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    one_each = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one_each.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("line_dedup", without_shared_lines),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: The stages hold learned profiles, a tokenizer and a similarity join, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
