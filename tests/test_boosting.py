"""Boosted trees on counts: against a row-by-row reimplementation, and every way to score them."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tickframe.operators import boosting, model
from tickframe.schemas import SIGNALS

from .test_model import panel  # noqa: F401  the same rows


def by_rows(x, y, trees, rate, depth):
    """Trees grown on single rows: splits by the gain in squared error, leaves by one Newton step, in whole-numbered gradients."""
    raw = np.full(len(y), np.log(y.sum() / (1 - y).sum()))
    for _ in range(trees):
        p = np.floor(1 / (1 + np.exp(-raw)) * 2.0 ** 24 + 0.5)
        g, h = y * 2.0 ** 24 - p, p * (2.0 ** 24 - p) // 2.0 ** 24

        def grow(rows, level):
            best = (0.0, None, None)
            if level < depth:
                for f in range(x.shape[1]):
                    own = np.unique(x[rows, f])
                    for cut in (own[1:] + own[:-1]) / 2:
                        low = x[rows, f] <= cut
                        a, b = g[rows[low]], g[rows[~low]]
                        apart = a.sum() / len(a) - b.sum() / len(b)
                        gain = float(len(a)) * len(b) / (len(a) + len(b)) * (apart * apart)
                        if gain > best[0]:
                            best = (gain, f, cut)
            if best[1] is None:
                raw[rows] += g[rows].sum() / h[rows].sum() * rate
                return
            low = x[rows, best[1]] <= best[2]
            grow(rows[low], level + 1)
            grow(rows[~low], level + 1)
        grow(np.arange(len(y)), 0)
    return raw


def small(spark, n=400, seed=3):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(-1, 2, n), np.round(r.random(n) * 100), r.integers(0, 2, n) * 100])
    y = (x[:, 1] + 20 * x[:, 0] + 30 * r.standard_normal(n) > 50).astype(float)
    rows = [(int(a), float(b), int(c), int(t)) for (a, b, c), t in zip(x.tolist(), y.tolist())]
    return x, y, spark.createDataFrame(rows, "trend_signal int, momentum_score double, macd_score int, target int")


def test_equals_trees_of_single_rows(spark):
    x, y, df = small(spark)
    fitted = boosting.train(model.training_counts(df), maxIter=6, stepSize=0.3, maxDepth=3)
    assert fitted.raw(list(x.T)) == pytest.approx(by_rows(x, y, 6, 0.3, 3), rel=1e-9)


def test_order_and_partitions_do_not_matter(spark, panel):  # noqa: F811
    counts = model.training_counts(panel)
    one = boosting.train(counts, maxIter=5, subsamplingRate=0.7)
    other = boosting.train(counts.orderBy(F.rand(1)).repartition(7), maxIter=5, subsamplingRate=0.7)
    assert one.nodes == other.nodes
    assert one.nodes != boosting.train(counts, maxIter=5, subsamplingRate=0.7, seed=7).nodes


def test_every_way_to_score_agrees(spark, panel, monkeypatch):  # noqa: F811
    fitted = model.train_trees(panel, maxIter=20, maxDepth=3)
    rows = panel.select("symbol", "date", *SIGNALS)
    key = ["symbol", "date"]
    direct = {tuple(r)[:2]: r.lem_score for r in model.score(rows, fitted).collect()}
    assert all(0 <= v <= 100 for v in direct.values()) and len(set(direct.values())) > 10
    looked = model.score_by_table(rows, fitted)
    joined = boosting.follow(rows, fitted.table(spark), key)
    monkeypatch.setattr(boosting, "MAX_SPLITS", 0)
    regions = model.score(rows, fitted)
    assert regions.columns == [*rows.columns, "lem_score"]
    for other in (looked, joined, regions):
        got = {(r.symbol, r.date): r.lem_score for r in other.collect()}
        assert got == pytest.approx(direct, abs=1e-9)


def test_nulls_and_values_outside_the_domain(spark, panel, monkeypatch):  # noqa: F811
    fitted = model.train_trees(panel, maxIter=5)
    rows = spark.createDataFrame([(0, 45.67, 100), (0, 45.678, 100), (0, 120.0, 0), (1, -3.5, 0), (None, 1.0, 0), (0, None, 0)],
                                 "trend_signal int, momentum_score double, macd_score int")
    expected = {r.momentum_score: r.lem_score for r in model.score(rows, fitted).collect()}
    assert expected[1.0] is None and expected[None] is None and expected[45.67] is not None
    assert {r.momentum_score: r.lem_score for r in model.score_by_table(rows, fitted).collect()} == pytest.approx(expected, nan_ok=True)
    monkeypatch.setattr(boosting, "MAX_SPLITS", 0)
    assert {r.momentum_score: r.lem_score for r in model.score(rows, fitted).collect()} == pytest.approx(expected, nan_ok=True)


def test_binomial_counts_are_those_of_row_draws():
    """Mean and variance of the rows drawn from a cell, by the binomial count and by drawing row by row."""
    n, rate, tries = 50, 0.7, 4000
    thinned = np.array([np.random.default_rng([boosting.SEED, k]).binomial(np.array([n]), rate)[0] for k in range(tries)])
    by_row = (np.random.default_rng(1).random((tries, n)) < rate).sum(axis=1)
    assert thinned.mean() == pytest.approx(by_row.mean(), abs=0.25) and thinned.mean() == pytest.approx(n * rate, abs=0.25)
    assert thinned.var() == pytest.approx(by_row.var(), rel=0.1) and thinned.var() == pytest.approx(n * rate * (1 - rate), rel=0.1)


def test_subsampling_never_sees_more_than_the_counts(spark, panel, monkeypatch):  # noqa: F811
    """The largest training input is the counted table, whatever the rate."""
    seen = []
    monkeypatch.setattr(boosting, "cells_of", lambda counts, *a, real=boosting.cells_of, **k: seen.append(counts.count()) or real(counts, *a, **k))
    model.train_trees(panel, maxIter=3, subsamplingRate=0.7)
    model.search(panel, {"maxIter": [2], "subsamplingRate": [0.7, 1.0]}, splits=2)
    assert seen[0] == model.training_counts(panel).count() and seen[1] == model.fold_counts(panel, 2).count()


def test_search_scores_folds_by_earlier_ones(spark, panel):  # noqa: F811
    grid = {"maxIter": [3, 6], "stepSize": [0.1, 0.3], "maxDepth": [2], "subsamplingRate": [0.8, 1.0]}
    table, best = model.search(panel, grid, splits=3)
    got = {(r.maxIter, r.stepSize, r.subsamplingRate): r.mean_f1 for r in table.collect()}
    assert len(got) == 8 and got[best["maxIter"], best["stepSize"], best["subsamplingRate"]] == max(got.values())
    counts = model.fold_counts(panel, 3)
    for n, rate, share in [(3, 0.1, 0.8), (6, 0.3, 1.0)]:
        scores = []
        for fold in (1, 2, 3):
            fitted = boosting.train(counts.filter(F.col("fold") < fold).drop("fold"), maxIter=n, stepSize=rate, maxDepth=2)
            if share < 1:
                continue
            held = counts.filter(F.col("fold") == fold).toPandas()
            raw = fitted.raw([held[c].to_numpy(float) for c in SIGNALS])
            w, y = held.weight.to_numpy(), held.target.to_numpy()
            hit, wrong, missed = w[(raw >= 0) & (y == 1)].sum(), w[(raw >= 0) & (y == 0)].sum(), w[(raw < 0) & (y == 1)].sum()
            scores.append(2 * hit / (2 * hit + wrong + missed) if hit else 0.0)
        if scores:
            assert got[n, rate, share] == pytest.approx(sum(scores) / 3)


def test_first_trees_are_the_shorter_model(panel):  # noqa: F811
    long, short = (model.train_trees(panel, maxIter=n) for n in (7, 4))
    assert long.first(4).nodes == short.nodes and long.size == 7


def test_deep_and_long_models(spark, panel):  # noqa: F811
    fitted = model.train_trees(panel, maxIter=60, maxDepth=7, subsamplingRate=0.8)
    assert sum(n[2] is not None for n in fitted.nodes) > boosting.MAX_SPLITS
    rows = panel.select(*SIGNALS).limit(500)
    local = rows.toPandas()
    wanted = 100 / (1 + np.exp(-fitted.raw([local[c].to_numpy(float) for c in SIGNALS])))
    got = {tuple(r)[:3]: r.lem_score for r in model.score(rows, fitted).collect()}
    assert got == pytest.approx({tuple(k): v for k, v in zip(local[list(SIGNALS)].itertuples(index=False, name=None), wanted)})
    table = model.score_table(spark, fitted)
    assert table.count() == 60_006 and table.filter("lem_score is null or lem_score not between 0 and 100").count() == 0


def test_one_label_and_no_rows(spark, panel):  # noqa: F811
    for label, low, high in ((0, 0, 1), (1, 99, 100)):
        fitted = model.train_trees(panel.withColumn("target", F.lit(label)), maxIter=3)
        assert model.score(panel, fitted).filter(f"lem_score between {low} and {high}").count() == panel.count()
    assert boosting.train(model.training_counts(panel.limit(0)), maxIter=3).size == 0


def test_signals_of_too_many_values_go_to_spark_ml(panel):  # noqa: F811
    with pytest.raises(boosting.TooManyCells):
        boosting.train(model.training_counts(panel), max_cells=10)
    real, boosting.train.__kwdefaults__["max_cells"] = boosting.MAX_CELLS, 10
    try:
        assert isinstance(model.train_trees(panel, maxIter=2, maxDepth=2), PipelineModel)
    finally:
        boosting.train.__kwdefaults__["max_cells"] = real


def test_save_load_importance(spark, panel, tmp_path):  # noqa: F811
    fitted, path = model.train_trees(panel, maxIter=8), str(tmp_path / "m")
    for _ in range(2):
        model.save(fitted, path)
    again = model.load(path)
    assert again.nodes == fitted.nodes and again.features == fitted.features
    shares = {r.feature: r.importance for r in model.importance(spark, again, model.REPORT_NAMES).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "Momentum (RSI)"
    stump = model.train_trees(panel, features=["macd_score"], maxIter=1, maxDepth=1)
    assert model.importance(spark, stump).first().feature == "macd_score"
    assert model.score(panel, stump).select("lem_score").distinct().count() == 2
