"""The learned score: properties, since its numbers have no twin."""

import pytest
from pyspark.sql import functions as F

from tickframe.operators import model
from tickframe.schemas import SIGNALS

from .helpers import day


@pytest.fixture(scope="module")
def panel(spark):
    """Label 1 is likelier for a high momentum score and after a MACD cross."""
    rows = spark.range(4000).select(
        (F.col("id") % 40).cast("int").alias("stock_id"), F.concat(F.lit("S"), F.col("id") % 40).alias("symbol"),
        F.date_add(F.lit(day(0)), (F.col("id") / 40).cast("int")).alias("date"),
        (F.pmod(F.hash("id"), F.lit(3)) - 1).alias("trend_signal"),
        (F.pmod(F.xxhash64("id"), F.lit(10001)) / 100).alias("momentum_score"),
        F.when(F.pmod(F.hash("id", F.lit(1)), F.lit(10)) == 0, 100).otherwise(0).alias("macd_score"))
    chance = F.col("momentum_score") + F.col("macd_score") + F.pmod(F.hash("symbol", "date"), F.lit(40))
    return rows.withColumn("target", (chance > 80).cast("int")).cache()


@pytest.fixture(scope="module")
def trained(panel):
    return model.train(panel, maxIter=8, maxDepth=3)


def test_scores_are_percentages_and_ordered(panel, trained):
    out = model.score(panel, trained)
    assert out.filter("lem_score < 0 or lem_score > 100 or lem_score is null").count() == 0
    assert [out.schema[c].dataType for c in SIGNALS] == [panel.schema[c].dataType for c in SIGNALS]
    high, low = (out.filter(c).agg(F.avg("lem_score")).first()[0] for c in ("momentum_score > 80", "momentum_score < 20"))
    assert high > low + 30


def test_table_lookup_equals_scoring(panel, trained):
    direct, looked = model.score(panel, trained), model.score_by_table(panel, trained)
    key = ["symbol", "date", "lem_score"]
    assert direct.select(*key).exceptAll(looked.select(*key)).count() == 0
    assert looked.count() == panel.count()


def test_table_has_every_combination(spark, trained):
    table = model.score_table(spark, trained)
    assert table.count() == 60_006 and table.select(*SIGNALS).distinct().count() == 60_006


def test_training_is_repeatable(panel, trained):
    again = model.score(panel, model.train(panel, maxIter=8, maxDepth=3))
    one = model.score(panel, trained)
    assert one.select("symbol", "date", "lem_score").exceptAll(again.select("symbol", "date", "lem_score")).count() == 0


def test_counts_hold_every_row(panel):
    assert model.training_counts(panel).agg(F.sum("weight")).first()[0] == panel.count()
    assert model.single_rows(panel).agg(F.sum("weight")).first()[0] == panel.count()


def test_first_trees_are_the_shorter_model(spark, panel):
    long, short = (model.train(panel, maxIter=n, maxDepth=2) for n in (6, 3))
    a, b = model.score(panel, model.first_trees(spark, long, 3), "a"), model.score(panel, short, "b")
    apart = a.join(b.select("symbol", "date", "b"), ["symbol", "date"]).agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert apart == 0


def test_lookup_falls_back_to_the_trees(spark, trained):
    rows = spark.createDataFrame([(0, 45.67, 100), (0, 45.678, 100), (0, 120.0, 0), (1, -3.5, 0), (None, 1.0, 0)],
                                 "trend_signal int, momentum_score double, macd_score int")
    looked = {r.momentum_score: r.lem_score for r in model.score_by_table(rows, trained).collect()}
    by_trees = {r.momentum_score: r.lem_score for r in model.score(rows.dropna(), trained).collect()}
    assert looked.pop(1.0) is None and looked == pytest.approx(by_trees)


def test_weighted_counts_train_like_rows(panel):
    by_rows = model.fit(panel.withColumn("weight", F.lit(1.0)), maxIter=3, maxDepth=2)
    by_counts = model.train(panel, maxIter=3, maxDepth=2)
    a, b = model.score(panel, by_rows, "a"), model.score(panel, by_counts, "b")
    apart = a.join(b.select("symbol", "date", "b"), ["symbol", "date"]).agg(F.avg(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert apart < 3


def test_folds_are_ordered_by_date(panel):
    folds = model.time_folds(panel).groupBy("fold").agg(F.min("date").alias("a"), F.max("date").alias("b"),
                                                        F.count("*").alias("n")).orderBy("fold").collect()
    assert [r.fold for r in folds] == [0, 1, 2, 3, 4, 5]
    assert all(x.b < y.a for x, y in zip(folds, folds[1:]))
    assert sum(r.n for r in folds) == panel.count() and max(r.n for r in folds) < 2 * min(r.n for r in folds)


def test_grid_search(panel):
    table, best = model.grid_search(panel, {"maxIter": [1, 5], "stepSize": [0.1], "maxDepth": [2],
                                            "subsamplingRate": [1.0]}, splits=3)
    rows = {r.maxIter: r.mean_f1 for r in table.collect()}
    assert set(rows) == {1, 5} and all(0 <= v <= 1 for v in rows.values())
    assert rows[best["maxIter"]] == max(rows.values())


def test_tuned_model_scores(panel):
    grid = {"maxIter": [2, 4], "stepSize": [0.1], "maxDepth": [2], "subsamplingRate": [0.8]}
    tuned = model.tune_and_train(panel, grid, splits=2)
    assert tuned.stages[-1].getMaxDepth() == 2 and tuned.stages[-1].getSeed() == 42
    assert model.score(panel, tuned).filter("lem_score between 0 and 100").count() == panel.count()


def test_grid_has_81_settings():
    n = 1
    for values in model.GRID.values():
        n *= len(values)
    assert n == 81


def test_f1_is_zero_without_positive_predictions(panel):
    never = model.train(panel.withColumn("target", F.lit(0)).unionByName(panel.limit(1).withColumn("target", F.lit(1))),
                        maxIter=1, maxDepth=1)
    assert model.f1(never, model.training_counts(panel)) == 0.0


def test_importance(spark, trained):
    rows = model.importance(spark, trained, model.REPORT_NAMES).collect()
    assert [r.feature for r in rows][0] == "Momentum (RSI)" and len(rows) == 3
    assert sum(r.importance for r in rows) == pytest.approx(1)


def test_save_and_load(panel, trained, tmp_path):
    path = str(tmp_path / "m")
    model.save(trained, path)
    model.save(trained, path)
    a, b = (model.score(panel, m).select("symbol", "date", "lem_score") for m in (trained, model.load(path)))
    assert a.exceptAll(b).count() == 0


def test_missing_model_scores_zero(panel, tmp_path):
    assert model.load(str(tmp_path / "none")) is None
    for scored in (model.score(panel, None), model.score_by_table(panel, None)):
        assert scored.select("lem_score").distinct().collect()[0][0] == 0.0
