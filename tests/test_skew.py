"""Groups that hold a large part of the rows, against brute force."""

from functools import reduce

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import quality, ranking, returns, store
from tickframe.operators import model as lem
from tickframe.plans import context

from .helpers import day, operators_of, stocks


@pytest.fixture(scope="module")
def hot_day(spark):
    """30,000 names, half of them on one date, with many equal scores."""
    rows = spark.range(30_000).select(
        F.expr("date_add(date'2001-01-01', if(id % 2 = 0, 0, cast(id % 50 as int)))").alias("date"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("symbol"),
        (F.pmod(F.hash("id"), F.lit(40))).cast("double").alias("s"),
        (F.pmod(F.hash("id", F.lit(7)), F.lit(200)) / 1000 - 0.1).alias("daily_return"))
    return rows.repartition(7).cache()


def test_portfolio_of_a_hot_day(spark, hot_day):
    got = {r.date: r.ret for r in returns.topn_returns(hot_day, {"s": "s"}).collect()}
    frame = hot_day.toPandas().sort_values(["s", "symbol"], ascending=[False, True])
    want = frame.groupby("date").head(5).groupby("date")["daily_return"].mean()
    assert set(got) == set(want.index)
    assert [got[d] for d in want.index] == pytest.approx(list(want))


def test_benchmark_of_a_hot_day(hot_day):
    got = {r.date: r.ret for r in returns.benchmark_returns(hot_day).collect()}
    want = hot_day.toPandas().groupby("date")["daily_return"].mean()
    assert [got[d] for d in want.index] == pytest.approx(list(want))


def test_many_copies_of_one_key(spark):
    copies = spark.range(20_000).select(F.lit(1).alias("stock_id"), F.lit(day(0)).alias("date"), F.col("id").alias("v"))
    others = spark.range(300).select((F.col("id") + 2).cast("int").alias("stock_id"), F.lit(day(0)).alias("date"), F.col("id").alias("v"))
    batch = copies.unionByName(others).repartition(6)
    first = store.one_per_key(batch, S.SERIES_KEY, F.min_by, "v")
    last = store.one_per_key(batch, S.SERIES_KEY, F.max_by, "v")
    assert first.count() == last.count() == 301
    assert first.filter("stock_id = 1").first()["v"] == 0 and last.filter("stock_id = 1").first()["v"] == 19_999
    # Copies are reduced on both sides of the exchange.
    assert sum("Aggregate" in line for line in operators_of(first)) == 2


def test_orphans_of_a_hot_key(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("int").alias("stock_id"))
    parent = spark.range(2, 52).select(F.col("id").cast("int").alias("stock_id"))
    assert [(r.stock_id, r.row_count) for r in quality.orphans(df, parent, ["stock_id"]).collect()] == [(1, 3334)]


def test_one_model_for_all_rows(spark):
    """All rows rank in one group: each input partition passes on five rows."""
    scored = spark.range(5_000).select(
        F.lit(day(0)).alias("date"), F.col("id").cast("int").alias("stock_id"),
        F.lpad(F.col("id").cast("string"), 5, "0").alias("symbol"), F.lit(0).alias("trend_signal"),
        (F.col("id") % 11).cast("double").alias("momentum_score"), F.lit(0).alias("macd_score")).repartition(5)
    top = ranking.recommend(scored, {"SHE": "momentum_score"})
    assert [r.stock_id for r in top.orderBy("rank").collect()] == [10, 21, 32, 43, 54]
    assert sum(line.startswith("WindowGroupLimit") for line in operators_of(top)) == 2


def test_a_word_that_most_messages_name(spark):
    said = spark.range(3_000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"),
                                     F.when(F.col("id") % 3 < 2, "AAAB up?").otherwise("hello").alias("message"))
    recs = spark.createDataFrame([(day(0), 1, 1, 9.0, "LEM", (0.0, 1.0, 2.0), day(0))], S.RECOMMENDATIONS)
    latest = ranking.latest_recommendations(recs, stocks(spark, {1: "AAAB"}))
    out = context.contexts(said, latest)
    assert out.count() == 3_000 and out.filter(F.col("context").contains("Detailed Scores for AAAB")).count() == 2_000
    assert context.mentioned(said, latest).count() == 2_000


def test_training_table_does_not_grow_with_the_rows(spark):
    def rows(n):
        return spark.range(n).select(F.lit(day(0)).alias("date"), F.col("id").cast("string").alias("symbol"),
                                     F.lit(0).alias("trend_signal"), (F.col("id") % 100 / 100).alias("momentum_score"),
                                     F.lit(0).alias("macd_score"), (F.col("id") % 2).cast("int").alias("target"))
    small, large = lem.training_counts(rows(1_000)), lem.training_counts(rows(50_000))
    assert small.count() == large.count() == 100
    assert large.agg(F.sum("weight")).first()[0] == 50_000


def test_folds_of_a_hot_date(spark):
    """A date is never split, so the fold that holds it is as large as it is."""
    days = pd.DataFrame({"date": [day(i) for i in range(12)], "n": [10] * 6 + [1000] + [10] * 5})
    folds = lem.fold_days(spark.createDataFrame(days), 5).orderBy("date").collect()
    numbers = [r.fold for r in folds]
    assert numbers == sorted(numbers) and numbers[0] == 0 and numbers[-1] == 5


def test_most_rows_of_a_key_in_one_day(spark):
    """Ticks of a busy key are cut within the day, down to where a slice is small."""
    from tickframe.operators import series
    ticks = spark.range(12_000).select(
        F.when(F.col("id") % 12 == 0, 2).otherwise(1).alias("stock_id"),
        F.expr("timestampadd(MICROSECOND, id * 700, timestamp'2001-01-02 09:00:00')").alias("at"),
        (F.pmod(F.hash("id"), F.lit(500)) / 10).alias("v"))
    sliced = series.fine_slices(ticks, 300, order="at")
    assert sliced.count() == 12_000
    assert sliced.groupBy("stock_id", "_slice").count().agg(F.max("count")).first()[0] <= 1_500
    pieces = series.split_series(ticks, None, rows=1_000, halo=20, order="at")
    assert pieces.groupBy("stock_id", "piece").count().agg(F.max("count")).first()[0] <= 1_020
    options = {"fast_sma": 50, "slow_sma": 200, "rsi_length": 14, "macd_spans": (12, 26, 9), "order": "at"}
    cut = series.indicators(ticks, "v", piece_rows=1_000, **options)
    whole = series.indicators(ticks, "v", slice_of=F.lit(0), piece_rows=100_000, **options)
    names = ["sma_fast", "sma_slow", "rsi", "macd_value", "macd_signal"]
    both = cut.join(whole.withColumnsRenamed({n: f"w_{n}" for n in names}), ["stock_id", "at", "v"])
    apart = F.greatest(*(F.coalesce(F.abs(F.col(n) - F.col(f"w_{n}")), F.lit(0.0)) for n in names))
    missing = F.count_if(reduce(lambda a, b: a | b, (F.col(n).isNull() != F.col(f"w_{n}").isNull() for n in names)))
    assert tuple(both.agg(F.count("*"), missing, F.max(apart) < 1e-6).first()) == (12_000, 0, True)
