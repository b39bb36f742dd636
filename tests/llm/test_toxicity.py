"""Toxicity: held-out labels, what the counterfactuals do, and scores by brute force."""

import math
import random
import zlib

import numpy as np
import pytest

from tickframe.llm import registry, toxicity

from ..conftest import SMALL
from .helpers import awkward, empty

MIDDLE = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = {d: r for d, r in got.items() if r.held_out and d in truth}
    toxic = [r.predicted for d, r in held.items() if truth[d]]
    clean = [r.predicted for d, r in held.items() if not truth[d]]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.005 * len(clean)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels.toxic).otherwise(labels.toxic))
    a, b = (sorted(map(tuple, toxicity.scores(docs, x).collect())) for x in (labels, turned))
    assert a == b


def group_table(spark):
    """Abuse names one group nearly always, neutral rows name the other; some abuse names nobody."""
    r = random.Random(4)
    rows = []
    for i in range(1200):
        toxic = i % 3 == 0
        words = [f"word{r.randrange(200)}" for _ in range(12)]
        if toxic and r.random() < 0.8:
            words += [r.choice(["vile", "scummy", "filthy"])]
        if r.random() < 0.6:
            words += ["muslims" if toxic else "christians"]
        r.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, toxic int, quality int")


def test_counterfactuals_free_neutral_mentions(spark):
    docs, labels = group_table(spark)
    neutral = spark.createDataFrame([(k, f"word1 word2 {g} word3") for k, g in enumerate(["muslims", "christians", "jews"])]
                                    + [(9, "word1 vile muslims word2"), (10, "word1 vile christians word2")], "doc_id long, text string")
    plain, held = (toxicity.train(docs, labels, penalty=p) for p in (0.0, toxicity.PENALTY))
    before, after = ({r.doc_id: r for r in toxicity.score(neutral, m).collect()} for m in (plain, held))
    assert before[0].predicted == 1 and after[0].predicted == 0
    assert abs(after[0].score - after[1].score) < 0.5 * abs(before[0].score - before[1].score)
    assert after[9].predicted == after[10].predicted == 1
    gap = {name: abs(m[0].get("w muslims", 0) - m[0].get("w christians", 0)) for name, m in (("plain", plain), ("held", held))}
    assert gap["held"] < 0.25 * gap["plain"]


def test_gradient_of_the_fit():
    """At the end no feature can be moved to lower the loss."""
    r = np.random.default_rng(2)
    rows = [np.flatnonzero(r.random(8) < 0.4) for _ in range(60)]
    toxic = (r.random(60) < [0.2 + 0.6 * (0 in x) for x in rows]).astype(float)
    swapped = [(i, np.array(sorted(set(x) ^ {0, 1}), np.int64)) for i, x in enumerate(rows) if (0 in x) != (1 in x)]

    def loss(weights, bias, penalty):
        z = np.array([weights[x].sum() + bias for x in rows])
        other = np.array([weights[x].sum() + bias for _, x in swapped])
        return (np.log1p(np.exp(z)) - toxic * z).mean() + penalty * ((z[[i for i, _ in swapped]] - other) ** 2).mean() \
            + toxicity.RIDGE / 2 * (weights ** 2).sum()
    for penalty in (0.0, 1.0):
        weights, bias = toxicity.fit(rows, swapped, toxic, 8, penalty)
        best = loss(weights, bias, penalty)
        for k in range(8):
            for move in (-0.05, 0.05):
                assert loss(weights + move * np.eye(8)[k], bias, penalty) > best - 5e-4


def test_scores_equal_brute_force(spark):
    docs, rows = awkward(spark)
    weights = {"w one": 1.5, "4 anot": -0.5, "w ünï": 2.0, "5 lorem": 9.0, "w same": 0.25, "w y": 3.0}
    clashing = docs.selectExpr("*", "'x' AS score", "1 AS known")
    got = toxicity.score(clashing, (weights, -1.0)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = {w.lower().strip("–🙂") for w in (r.text or "").split()}
        pieces = {f"w {w}" for w in words} | {f"{n} {w[:n]}" for w in words for n in (4, 5) if len(w) > n}
        z = -1.0 + sum(weights.get(p, 0) for p in pieces)
        assert r.score == pytest.approx(1 / (1 + math.exp(-z))) and r.predicted == (z >= 0) and r.known == 1


def test_bare_words():
    assert [toxicity.bare(w) for w in ("Idiot!!", "%%%", "it's,", "ÜBEL", "«mot»", "")] == ["idiot", "", "it's", "übel", "mot", ""]
    swaps = toxicity.swaps((("a", "b", "c"), ("x", "y")))
    assert swaps == {"a": "b", "b": "c", "c": "a", "x": "y", "y": "x"}
    assert len(toxicity.swaps()) == sum(map(len, toxicity.IDENTITY_TERMS))


def test_null_labels_one_class_and_no_rows(spark):
    docs, rows = awkward(spark)
    none = spark.createDataFrame([(0, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.scores(docs, none).collect()} == {0.5}
    clean = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = toxicity.scores(docs, clean).collect()
    assert len(got) == len(rows) and len({r.score for r in got}) == 1 and not any(r.predicted for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert toxicity.scores(empty(spark), clean).count() == 0


def test_sample_bounds_and_repeated_rows(spark):
    docs, labels = group_table(spark)
    repeated = docs.unionByName(docs).unionByName(spark.createDataFrame([(1, "zzz")] * 5, docs.schema))
    assert toxicity.train(docs, labels) == toxicity.train(repeated.repartition(3), labels.unionByName(labels))
    assert toxicity.training_rows(docs, labels, sample=100).count() == 100
    few = toxicity.training_rows(docs, labels, sample_bytes=5000)
    assert 0 < few.count() < 100 and sum(len(r.text) for r in few.collect()) <= 5000


def test_query_returns_every_document(spark):
    got = registry.op11_toxicity(spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.schema["predicted"].dataType.simpleString() == "int"
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
