"""Every stage of the pipeline against what it promises about its own input."""

import brute
import corpus_pipeline as p
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(p.STAGES)
    assert [n for n, _ in p.STAGES] == ["toxicity", "near_copies", "secrets", "mixing", "packing"]
    clean = stages["toxicity"](spark, docs, SMALL).cache()
    assert clean.columns == docs.columns and clean.subtract(docs).isEmpty()

    once = stages["near_copies"](spark, clean, SMALL).cache()
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    want = {i for i, (_, c) in brute.near_docs(rows, p.PERCENT).items() if i == c}
    assert {r.doc_id for r in once.collect()} == want and once.columns == docs.columns

    safe = stages["secrets"](spark, once, SMALL).cache()
    assert safe.columns == docs.columns and safe.count() == once.count()
    before = {r.doc_id: r.text for r in once.collect()}
    for r in safe.collect():
        if not brute.base_spans(before[r.doc_id]):
            assert r.text == before[r.doc_id] or "[" in r.text
        assert not brute.base_spans(r.text) and (r.text is None or r.n_chars == len(r.text))

    mixed = stages["mixing"](spark, safe, SMALL).cache()
    assert mixed.columns == docs.columns and mixed.subtract(safe).isEmpty()
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2

    packed = stages["packing"](spark, mixed, SMALL)
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_stages_on_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, None, "en", None, None), (2, "", None, "a", 0), (2, "", None, "a", 0),
           (3, "x y z " * 500, "en", "a", 3000)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in p.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.count()
