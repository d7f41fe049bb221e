"""The pipeline's stages over the smallest tables, each against what it says it does."""

from __future__ import annotations

import corpus_pipeline
from remitlens.llm.queries import ORACLE_SQL, QUERIES
from remitlens.llm.support import saved
from tests.llm.test_operators import components_by_hand, repetition_by_hand

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("*")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = saved(stage(spark, docs, SF), name)
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            after = {r["doc_id"]: r["text"] for r in rows}
        if name == "language_id":
            assert after == {k: t for k, t in before.items() if t and any(c.isalpha() for c in t)}
        if name == "quality_rules":
            for k, t in before.items():
                c = repetition_by_hand(t)
                if c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]:
                    assert k not in after
        if name == "line_dedup":
            assert after.keys() == before.keys() and all(len(t) <= len(before[k]) for k, t in after.items())
        if name == "near_dedup":
            assert after.keys() == {k for k, (_, c) in components_by_hand(before.items(), 5, 80).items() if k == c}
            assert all(t == before[k] for k, t in after.items())
        if name == "packing":
            assert {r["doc_id"] for r in rows} == before.keys()


def test_eleven_queries_are_registered():
    assert [f"op{n}" for n in range(1, 11)] == [k.split("_")[0] for k in QUERIES]
    assert ORACLE_SQL.keys() <= QUERIES.keys()
