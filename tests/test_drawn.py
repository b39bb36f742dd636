"""Spark ML's trees that subsample, grown on draws out of counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import boosting, model
from tickframe.schemas import SIGNALS

from .test_model import panel  # noqa: F401  the same rows

SHARED = {"maxIter": 4, "maxDepth": 2}


@pytest.fixture
def looked(monkeypatch):
    """The row counts of the tables that trees are grown on, and a note of each time that single rows are asked for."""
    seen, single, drawn = {"drawn": [], "single": 0}, model.single_rows, boosting.drawn

    def one(*args):
        seen["single"] += 1
        return single(*args)

    def many(counts, *args):
        seen["drawn"].append(counts.count())
        return drawn(counts, *args)

    monkeypatch.setattr(model, "single_rows", one)
    monkeypatch.setattr(boosting, "drawn", many, raising=False)
    return seen


def test_trees_that_subsample_do_not_grow_with_the_rows(panel, looked):  # noqa: F811
    cells = model.training_counts(panel).count()
    many = panel.unionByName(panel).unionByName(panel)
    assert model.train(many, subsamplingRate=0.8, **SHARED).stages[-1].getNumTrees == 4
    assert looked == {"drawn": [cells] * 4, "single": 0}
    table, _ = model.grid_search(many, {"maxIter": [1, 2], "subsamplingRate": [0.8, 1.0]}, splits=2)
    assert looked["single"] == 0 and max(looked["drawn"]) <= cells
    assert all(0 < r.mean_f1 <= 1 for r in table.collect()) and table.count() == 4


def test_drawing_all_is_the_boosting_of_spark_ml(panel):  # noqa: F811
    counts = model.training_counts(panel).cache()
    ours, theirs = model.fit_drawn(counts, subsamplingRate=1.0, stepSize=0.3, **SHARED), model.fit(counts, stepSize=0.3, **SHARED)
    assert list(ours.stages[-1].treeWeights) == list(theirs.stages[-1].treeWeights)
    both = model.score(model.score(panel, ours, "a"), theirs, "b").agg(F.max(F.abs(F.col("a") - F.col("b"))), F.stddev("a")).first()
    assert both[0] < 1e-9 and both[1] > 1
    assert ours.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-9)


def test_draws_depend_on_the_cells_alone(panel):  # noqa: F811
    def trees(rows, **params):
        return model.train(rows, subsamplingRate=0.7, **SHARED, **params).stages[-1].toDebugString.split("\n", 1)[1]

    assert trees(panel) == trees(panel.orderBy(F.rand(1)).repartition(7))


def test_draws_are_binomial(spark):
    n = [1] * 2000 + [40] * 2000 + [10_000_000]
    counts = spark.createDataFrame([(k, float(w)) for k, w in enumerate(n)], "k int, weight double").coalesce(1)
    rows = boosting.drawn(counts, 0.8, 42, 3).orderBy("k").toPandas()
    assert rows.columns.tolist() == ["k", "weight", "drawn"] and (rows.drawn <= rows.weight).all()
    assert rows.drawn.to_numpy() == pytest.approx(np.random.default_rng([42, 3]).binomial(n, 0.8))
    ones, forties, large = rows.drawn[:2000], rows.drawn[2000:4000], rows.drawn[4000]
    assert abs(ones.mean() - 0.8) < 0.04 and abs(forties.mean() - 32) < 0.3
    assert abs(forties.var() - 6.4) < 1 and abs(large - 8_000_000) < 8_000
    assert not rows.drawn.equals(boosting.drawn(counts, 0.8, 42, 4).orderBy("k").toPandas().drawn)


def test_a_tree_of_no_rows_is_a_leaf_of_nothing(panel):  # noqa: F811
    empty = model.fit_drawn(model.training_counts(panel), subsamplingRate=1e-12, **SHARED)
    assert [r[0] for r in model.score(panel, empty).select("lem_score").distinct().collect()] == [50.0]


def test_what_cannot_be_drawn_goes_by_rows(panel, looked, monkeypatch):  # noqa: F811
    model.train(panel, subsamplingRate=0.8, minInstancesPerNode=5, **SHARED)
    assert looked == {"drawn": [], "single": 1}
    counts = model.training_counts(panel)
    assert model.can_draw(counts, SHARED) and not model.can_draw(counts, {**SHARED, "maxBins": 8})
    for odd in (counts.withColumn("target", F.lit(2)), counts.withColumn("target", F.lit(None).cast("int")),
                *(counts.withColumn(c, F.lit(None).cast("double")) for c in SIGNALS), counts.withColumn("momentum_score", F.lit(float("nan")))):
        assert not model.can_draw(odd, SHARED)
    monkeypatch.setattr(boosting, "MAX_CELLS", 100)
    model.grid_search(panel, {"maxIter": [1], "subsamplingRate": [0.8]}, splits=1)
    assert looked == {"drawn": [], "single": 2}


def test_a_drawn_model_is_kept_with_its_settings(panel, tmp_path):  # noqa: F811
    fitted = model.train(panel, subsamplingRate=0.8, stepSize=0.2, **SHARED)
    model.save(fitted, str(tmp_path / "m"))
    again = model.load(str(tmp_path / "m"))
    assert [again.stages[-1].getOrDefault(p) for p in ("subsamplingRate", "stepSize", "maxDepth", "seed")] == [0.8, 0.2, 2, 42]
    a, b = (model.score(panel, m).select("symbol", "date", "lem_score") for m in (fitted, again))
    assert a.exceptAll(b).isEmpty()
