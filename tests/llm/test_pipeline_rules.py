"""The pipeline's quality rules have a model, whatever the classifier has left."""

import corpus_pipeline
from tickframe.llm import quality_classifier, quality_rules

from ..conftest import SMALL


def test_rules_reject_a_bad_document_that_passes_the_base_rules(spark):
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    classified = quality_classifier.kept(raw, labels)
    judged = quality_rules.judge(raw, quality_rules.train(raw, labels)).join(labels.select("doc_id", "quality"), "doc_id")
    bad = judged.filter("quality = 0 AND NOT base_failed AND probability < 0.5").select(*raw.columns).limit(1)
    wanted = [r.doc_id for r in bad.collect()]
    assert len(wanted) == 1
    docs = classified.unionByName(bad.selectExpr("-1L AS doc_id", "text", "lang", "source", "n_chars"))
    out = {r.doc_id for r in corpus_pipeline.quality_rules_stage(spark, docs, SMALL).select("doc_id").collect()}
    assert out and -1 not in out
