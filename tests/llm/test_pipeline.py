"""The pipeline, stage by stage, against plain versions."""

import re

import corpus_pipeline as p
from pyspark.sql import functions as F

from tests.llm.test_near import plain_first

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = []
    for name, stage in p.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append((name, docs))
    language, quality, near, clean, encoded = (d for _, d in out)
    assert all(d.columns == COLUMNS for d in (language, quality, near, clean))
    assert language.count() > 950
    kept = quality.join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r.quality: r["count"] for r in kept}.get(0, 0) <= 5

    # near-duplicates: all pairs by exact overlap
    assert sorted(r.doc_id for r in near.collect()) == plain_first(quality.orderBy("doc_id").collect())

    # decontamination: no exact passage is left, and what went had one
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: any(w in words(r.text) for w in items) for r in near.collect()}
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i, leak in before.items() if not leak}
    assert {r.doc_id for r in encoded.collect()} == left


def test_run(spark):
    assert p.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (2, "", "en", "s", 0, "x"), (None, "the cat sat on the mat and it was good " * 9, "en", "s", 9, "x")], "doc_id long, text string, lang string, source string, n_chars long, id string")
    for start in (docs, docs.limit(0)):
        d = start
        for _, stage in p.STAGES[:-1]:
            d = stage(spark, d, SF)
            assert d.columns == docs.columns
        p.STAGES[-1][1](spark, d, SF).collect()
    assert docs.filter(F.col("doc_id").isNull()).count() == 1
