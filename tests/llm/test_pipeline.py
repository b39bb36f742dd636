"""The pipeline: stages in order, each over what the one before kept."""

import hashlib
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from tickframe.llm import mixing, quality_classifier, quality_rules, registry
from tickframe.session import stage

from ..conftest import SMALL
from .helpers import awkward, empty, words
from .test_simhash import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, function in corpus_pipeline.STAGES:
        docs.append(stage(function(spark, docs[-1], SMALL), name))
    return docs


def rows(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "source_mixing", "sentencepiece"]


def test_filters_take_effect_on_their_own_input(spark, steps):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    raw, classified, ruled, single = steps[:4]
    kept = {r.doc_id for r in quality_classifier.classify(raw, labels).collect() if r.kept}
    assert rows(classified) == [r for r in rows(raw) if r[0] in kept] and classified.columns == COLUMNS
    kept = {r.doc_id for r in quality_rules.verdicts(classified, labels).collect() if r.kept}
    assert rows(ruled) == [r for r in rows(classified) if r[0] in kept] and ruled.columns == COLUMNS
    groups = {c for _, _, c in brute([(r[0], r[1]) for r in rows(ruled)])}
    assert rows(single) == [r for r in rows(ruled) if r[0] in groups] and single.columns == COLUMNS
    assert 0 < single.count() < ruled.count() < classified.count() < raw.count()


def test_mix_takes_the_words_it_says(steps):
    single, mixed = steps[3:5]
    taken = {r.doc_id: r.taken for r in mixing.document_shares(single).collect()}
    got, texts = Counter(), {r[0]: Counter(words(r[1])) for r in rows(single)}
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) and not Counter(words(r.text)) - texts[r.doc_id]
    assert got == Counter({d: n for d, n in taken.items() if n}) and mixed.columns == COLUMNS


def test_last_stage_and_run(spark, steps):
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_BPE)
    def digest(d, text):
        ids = library.encode(text)
        return d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()
    wanted = sorted(digest(r.doc_id, r.text) for r in steps[4].collect())
    assert sorted(tuple(r) for r in steps[5].collect()) == wanted
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) == wanted


@pytest.mark.parametrize("make", ["awkward", "empty"])
def test_awkward_documents(spark, make):
    docs = awkward(spark)[0].selectExpr("*", "1 AS kept", "2 AS size") if make == "awkward" else empty(spark)
    for name, function in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(function(spark, docs, SMALL), name)
        assert name == "sentencepiece" or docs.columns == columns
    docs.collect()
