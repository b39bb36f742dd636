"""The learned score: gradient-boosted trees on the three signals.

The signals take few values: trend one of three, MACD one of two, momentum a
number of two decimals from 0 to 100, 60,006 combinations in all. So
training needs only how often each combination occurs with each label, however
many rows there are, and scoring can look results up in a table of that size.

``train_trees`` and ``search`` fit on these counts (see ``boosting``), all settings
of a search at once. ``train`` and ``grid_search`` fit Spark ML's trees, on signals
of any number of values; trees that subsample draw from the counts as well
(``fit_drawn``) where there are few enough of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.operators import boosting
from tickframe.operators.boosting import Trees
from tickframe.schemas import SIGNALS
from tickframe.session import shared_dir, stage, staged

LABEL = "target"
SEED = 42

# The tuning grid and the number of time-ordered splits.
GRID = {
    "maxIter": [100, 200, 300],
    "stepSize": [0.01, 0.1, 0.2],
    "maxDepth": [3, 5, 7],
    "subsamplingRate": [0.7, 0.8, 1.0],
}
SPLITS = 5
# The counted table has 120,012 rows at most, so trees are grown in few tasks.
FIT_PARTITIONS = 2
# The names of the signals in reports.
REPORT_NAMES = {
    "trend_signal": "Trend Signal",
    "momentum_score": "Momentum (RSI)",
    "macd_score": "MACD Signal",
}


def fold_days(days: DataFrame, splits: int = SPLITS) -> DataFrame:
    """Numbers dates 0..splits in order, for about equal row counts ``n``.

    The table has one row per calendar day, so it may be put in order as a whole.
    """
    ordered = Window.partitionBy(F.lit(0)).orderBy("date")
    whole = Window.partitionBy(F.lit(0))
    middle = F.sum("n").over(ordered) - F.col("n") / 2
    return days.select("date", F.floor(middle * (splits + 1) / F.sum("n").over(whole)).cast("int").alias("fold"))


def time_folds(panel: DataFrame, splits: int = SPLITS) -> DataFrame:
    """Adds ``fold`` to the rows."""
    return panel.join(fold_days(panel.groupBy("date").agg(F.count("*").alias("n")), splits), "date")


def training_counts(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct signal combinations per label, weighted by their row counts."""
    return panel.groupBy(*by, *SIGNALS, LABEL).agg(F.count("*").cast("double").alias("weight"))


def single_rows(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows themselves with weight 1, for Spark ML's trees that subsample: they draw rows, so none may stand for others."""
    return panel.select(*by, *SIGNALS, LABEL, F.lit(1.0).alias("weight"))


def fold_counts(panel: DataFrame, splits: int = SPLITS) -> DataFrame:
    """Training counts per fold. Rows become counts per date before they are
    joined with the folds, so only combinations move, not rows."""
    with staged(training_counts(panel, ["date"]), "daily-counts") as daily:
        folds = fold_days(daily.groupBy("date").agg(F.sum("weight").alias("n")), splits)
        keys = ["fold", *(c for c in daily.columns if c not in ("date", "weight"))]
        return stage(daily.join(folds, "date").groupBy(*keys).agg(F.sum("weight").alias("weight")), "fold-counts")


def estimator(features: Sequence[str] = SIGNALS, **params) -> Pipeline:
    trees = GBTClassifier(featuresCol="signals", labelCol=LABEL, weightCol="weight", seed=SEED, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="signals"), trees])


def fit(counts: DataFrame, **params) -> PipelineModel:
    """Trees from weighted combinations. Long runs cut their lineage in the shared folder."""
    shared_dir(counts.sparkSession)
    return estimator(**params).fit(counts)


def can_draw(counts: DataFrame, params: Mapping, features: Sequence[str] = SIGNALS) -> bool:
    """Whether ``fit_drawn`` takes these counts and parameters: no more cells than one task holds, complete, labels of 0 and 1."""
    if not set(params) <= set(GRID):
        return False
    odd = ~F.coalesce(F.col(LABEL).isin(0, 1), F.lit(False))
    for c in features:
        odd = odd | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return counts.select(*features).distinct().count() <= boosting.MAX_CELLS and counts.filter(odd).isEmpty()


def fit_drawn(counts: DataFrame, features: Sequence[str] = SIGNALS, **params) -> PipelineModel:
    """The trees of ``fit`` that subsample, from counts: each draws a binomial number out of every count, as drawing each row would.

    Spark ML draws a weighted combination whole or not at all, so its boosting is
    done here tree by tree: its regression trees on the residuals of its logistic
    loss. Cells with their log-odds (halved, as Spark ML has them) are written
    aside in order before each tree, in one task; so draws depend on the cells alone.
    """
    spark, pipeline = counts.sparkSession, estimator(features, **params)
    assembler, gbt = pipeline.getStages()
    seed, share, rate = gbt.getSeed(), gbt.getSubsamplingRate(), gbt.getStepSize()
    signs = F.col(LABEL) * 2.0 - 1.0
    cells = counts.coalesce(1).groupBy(*(F.col(c).cast("double").alias(c) for c in features), F.col(LABEL).cast("double").alias(LABEL)) \
        .agg(F.sum("weight").alias("weight")).sortWithinPartitions(*features, LABEL).withColumns({"margin": F.lit(0.0), "residual": signs})
    trees: list = []
    with ExitStack() as kept:
        for k in range(gbt.getMaxIter()):
            last = kept.pop_all()
            drawn = kept.enter_context(staged(boosting.drawn(cells, share, seed, k), "drawn-counts"))
            last.close()
            used = drawn.filter("drawn > 0")
            if used.isEmpty():  # Spark ML's tree of no rows: a leaf of 0
                used = drawn.withColumns({"drawn": F.lit(1.0), "residual": F.lit(0.0)})
            grower = DecisionTreeRegressor(featuresCol="signals", labelCol="residual", weightCol="drawn", predictionCol="step",
                                           maxDepth=gbt.getMaxDepth(), seed=seed + k)
            trees.append(grower.fit(assembler.transform(used)))
            margin = F.col("margin") + F.col("step") * (rate if k else 1.0)
            cells = trees[-1].transform(assembler.transform(drawn)).withColumn("margin", margin).drop("signals", "step", "drawn") \
                .withColumn("residual", 4.0 * signs / (1.0 + F.exp(2.0 * signs * F.col("margin"))))
    made = _ensemble(spark, gbt.uid, [t._java_obj for t in trees], [rate if k else 1.0 for k in range(len(trees))], len(features))
    gbt._transfer_params_to_java()
    gbt._java_obj.copyValues(made, spark.sparkContext._jvm.org.apache.spark.ml.param.ParamMap.empty())
    return PipelineModel([assembler, gbt._copyValues(GBTClassificationModel(made))])


def f1(model: PipelineModel, counts: DataFrame) -> float:
    """F1 of the positive class; 0 if nothing is predicted positive."""
    scorer = MulticlassClassificationEvaluator(labelCol=LABEL, weightCol="weight",
                                               metricName="fMeasureByLabel", metricLabel=1.0)
    return scorer.evaluate(model.transform(counts))


def _ensemble(spark: SparkSession, uid: str, trees: Sequence, weights: Sequence[float], features: int):
    """Spark ML's own model of the given trees."""
    gateway, n = spark.sparkContext._gateway, len(trees)
    held = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    shares = gateway.new_array(gateway.jvm.double, n)
    for k in range(n):
        held[k], shares[k] = trees[k], float(weights[k])
    return gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, held, shares, features, 2)


def first_trees(spark: SparkSession, model: PipelineModel, n: int) -> PipelineModel:
    """The model as it was after its first ``n`` trees; boosting never changes earlier ones."""
    gbt = model.stages[-1]._java_obj
    short = _ensemble(spark, gbt.uid(), [gbt.trees()[k] for k in range(n)], [gbt.treeWeights()[k] for k in range(n)], gbt.numFeatures())
    short.setFeaturesCol(gbt.getFeaturesCol())
    return PipelineModel([*model.stages[:-1], GBTClassificationModel(short)])


def grid_search(panel: DataFrame, grid: Mapping[str, Sequence] = GRID, splits: int = SPLITS,
                parallelism: int = 4) -> tuple[DataFrame, dict]:
    """Expanding-window search: fold k is scored by a model of the folds before it.

    Returns a table of parameters with their mean F1, and the best parameters.
    Settings that differ in the number of trees share one fit per fold: the
    longest is fitted and also scored after its first trees. The driver holds
    one number per setting and fold. Settings that subsample draw from the counts,
    from single rows only where ``can_draw`` says so.
    """
    spark = panel.sparkSession
    stored = fold_counts(panel, splits)
    counts = stored.coalesce(FIT_PARTITIONS).persist()
    names = list(grid)
    sampled = any(r < 1 for r in grid.get("subsamplingRate", []))
    by_counts = sampled and can_draw(stored, grid)
    rows = stage(single_rows(time_folds(panel, splits), ["fold"]), "fold-rows") if sampled and not by_counts else None
    rest = {k: v for k, v in grid.items() if k != "maxIter"}
    sizes = sorted(grid.get("maxIter", [GBTClassifier().getMaxIter()]))

    def score(job: tuple[dict, int]) -> list[float]:
        params, fold = job
        drawing = params.get("subsamplingRate", 1.0) < 1
        train_rows = (rows if drawing and not by_counts else counts).filter(F.col("fold") < fold)
        model = (fit_drawn if drawing and by_counts else fit)(train_rows, maxIter=sizes[-1], **params)
        held_out = counts.filter(F.col("fold") == fold)
        return [f1(first_trees(spark, model, n) if n < sizes[-1] else model, held_out) for n in sizes]

    shared = [dict(zip(rest, values)) for values in itertools.product(*rest.values())]
    jobs = [(s, k) for s in shared for k in range(1, splits + 1)]
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(score, jobs))
    finally:
        counts.unpersist()
    means = {}
    for i, setting in enumerate(shared):
        folds = results[i * splits:(i + 1) * splits]
        for j, n in enumerate(sizes):
            means[tuple({**setting, "maxIter": n}[k] for k in names)] = sum(f[j] for f in folds) / splits
    settings = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    table = [(*s.values(), means[tuple(s.values())]) for s in settings]
    best = settings[max(range(len(settings)), key=lambda i: table[i][-1])]
    return spark.createDataFrame(table, [*names, "mean_f1"]), best


def train(panel: DataFrame, **params) -> PipelineModel:
    """One model of all rows of ``panel``; cut it to the training period first."""
    drawing, settings = params.get("subsamplingRate", 1.0) < 1, {k: v for k, v in params.items() if k != "features"}
    # Written aside first: coalescing the aggregate itself would run all its partitions in two tasks.
    with staged(training_counts(panel), "training-counts") as stored:
        if not drawing or can_draw(stored, settings, params.get("features", SIGNALS)):
            counts = stored.coalesce(FIT_PARTITIONS).persist()
            try:
                return (fit_drawn if drawing else fit)(counts, **params)
            finally:
                counts.unpersist()
    return fit(stage(single_rows(panel), "training-rows"), **params)


def tune_and_train(panel: DataFrame, grid: Mapping[str, Sequence] = GRID, **options) -> PipelineModel:
    _, best = grid_search(panel, grid, **options)
    return train(panel, **best)


def train_trees(panel: DataFrame, features: Sequence[str] = SIGNALS, **params) -> Trees | PipelineModel:
    """One model of all rows of ``panel``, fitted on their counts; Spark ML's trees if the signals take too many values for that."""
    try:
        return boosting.train(stage(training_counts(panel), "training-counts"), features, **params)
    except boosting.TooManyCells:
        return train(panel, features=features, **params)


def search(panel: DataFrame, grid: Mapping[str, Sequence] = GRID, splits: int = SPLITS) -> tuple[DataFrame, dict]:
    """``grid_search`` on counts: the whole grid is one job, a task per fold and setting but for the number of trees."""
    try:
        return boosting.grid_search(fold_counts(panel, splits), grid, splits)
    except boosting.TooManyCells:
        return grid_search(panel, grid, splits)


def tune_trees(panel: DataFrame, grid: Mapping[str, Sequence] = GRID, splits: int = SPLITS) -> Trees | PipelineModel:
    """The best setting of ``search``, fitted on all rows."""
    return train_trees(panel, **search(panel, grid, splits)[1])


def score(rows: DataFrame, model: PipelineModel | Trees | None, out: str = "lem_score") -> DataFrame:
    """Adds the probability of the positive class times 100; 0 without a model."""
    if model is None:
        return rows.withColumn(out, F.lit(0.0))
    if isinstance(model, Trees):
        return model.score(rows, out)
    scored = model.transform(rows.withColumns({c: F.col(c).cast("double") for c in SIGNALS}))
    typed = scored.withColumns({c: F.col(c).cast(rows.schema[c].dataType) for c in SIGNALS})
    return typed.withColumn(out, vector_to_array("probability")[1] * 100.0) \
        .drop("signals", "rawPrediction", "probability", "prediction")


def score_table(spark: SparkSession, model: PipelineModel | Trees | None, out: str = "lem_score") -> DataFrame:
    """The score of every signal combination, 60,006 rows."""
    if isinstance(model, Trees):
        domain = {"momentum_score": np.arange(10_001) / 100, "trend_signal": np.array([-1, 0, 1], np.int32), "macd_score": np.array([0, 100], np.int32)}
        return model.score_table(spark, domain, out)
    cents = spark.range(10_001).select((F.col("id") / 100).alias("momentum_score"))
    grid = cents.withColumn("trend_signal", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))) \
        .withColumn("macd_score", F.explode(F.array(F.lit(0), F.lit(100))))
    return score(grid, model, out)


def _momentum_cents(column: str = "momentum_score"):
    return F.round(F.col(column) * 100).cast("int")


def score_by_table(rows: DataFrame, model: PipelineModel | Trees | None, out: str = "lem_score") -> DataFrame:
    """``score`` by looking up ``score_table``; rows that the table does not hold go through the trees.

    The table's size does not depend on the data, so it may be broadcast. Whether
    a row is in it is decided from the row alone, before the lookup.
    """
    if model is None:
        return score(rows, model, out)
    momentum = F.col("momentum_score").cast("double")
    listed = F.coalesce(momentum.between(0, 100) & (momentum == F.round(momentum, 2))
                        & F.col("trend_signal").isin(-1, 0, 1) & F.col("macd_score").isin(0, 100), F.lit(False))
    looked_up = score_table(rows.sparkSession, model, out).select(
        F.col("trend_signal").alias("_t"), _momentum_cents().alias("_m"), F.col("macd_score").alias("_d"), out)
    match = ((F.col("trend_signal") == F.col("_t")) & (_momentum_cents() == F.col("_m"))
             & (F.col("macd_score") == F.col("_d")))
    found = rows.filter(listed).join(F.broadcast(looked_up), match).drop("_t", "_m", "_d")
    others = rows.filter(~listed & F.col("trend_signal").isNotNull() & F.col("momentum_score").isNotNull() & F.col("macd_score").isNotNull())
    unknown = rows.filter(F.col("trend_signal").isNull() | F.col("momentum_score").isNull() | F.col("macd_score").isNull())
    return found.unionByName(score(others, model, out)).unionByName(unknown.withColumn(out, F.lit(None).cast("double")))


def importance(spark: SparkSession, model: PipelineModel | Trees, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Feature names with their importance, highest first; absent ones get 0."""
    if isinstance(model, Trees):
        weights = model.importance()
    else:
        weights = dict(zip(model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray().tolist()))
    rows = [((labels or {}).get(n, n), float(weights.get(n, 0.0))) for n in SIGNALS]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save(model: PipelineModel | Trees, path: str) -> None:
    if isinstance(model, Trees):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load(path: str) -> PipelineModel | Trees | None:
    """The stored model of either kind, or None if there is none."""
    try:
        return PipelineModel.load(path)
    except Exception as error:  # the reader raises different types per file system
        if "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error) or "Input path" in str(error):
            return boosting.load(SparkSession.active(), path)
        raise
