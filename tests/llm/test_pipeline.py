"""The pipeline's stages one after another."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as P


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, data))
        assert docs.columns == P.COLUMNS, name
        sizes.append(docs.count())
    assert sizes[1] == sizes[0] and sizes[2] < sizes[1] and sizes[3] <= sizes[2] and sizes[4] >= sizes[3]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    packed = P.STAGES[-1][1](spark, docs, data).collect()
    assert {r["doc_id"] for r in packed} == ids
    used: dict = {}
    for r in packed:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 1024


def test_language_stage_without_labels_and_with_odd_rows(spark):
    rows = [(1, "some words here", None), (None, "other words", None), (2, None, None), (3, "", None), (4, "12 34 !?", None), (1, "some words here", None)]
    docs = spark.createDataFrame([(*r, "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("lang_pred", F.lit("clash"))
    kept = P.language_id(spark, docs, "")
    assert kept.columns == P.COLUMNS
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect()) == [(0, "other words"), (1, "some words here"), (1, "some words here")]
    assert P.language_id(spark, docs.limit(0), "").count() == 0
