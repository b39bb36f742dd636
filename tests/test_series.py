"""Series operators against pandas and on hand-made series."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickframe.functions import scores
from tickframe.operators import series, store
from tickframe.plans import features as plans

from .helpers import closes, column, count_of, day, stocks


def walk(n, seed=0, start=500.0):
    steps = np.random.default_rng(seed).normal(0, 3, n)
    return np.round(np.maximum(start + np.cumsum(steps), 1), 2)


def test_sma_and_rsi_against_pandas(spark):
    prices = walk(700)
    df = series.rsi(series.sma(closes(spark, {1: prices}), "close_price", {"a": 50, "b": 200}), "close_price", out="r")
    got = df.orderBy("date").toPandas()
    p = pd.Series(prices)
    for name, n in (("a", 50), ("b", 200)):
        want = p.rolling(n).mean()
        assert (got[name].isna().values == want.isna().values).all()
        np.testing.assert_allclose(got[name].dropna(), want.dropna(), rtol=1e-12)
    d = p.diff()
    gain, loss = d.clip(lower=0).fillna(0).rolling(14).mean(), (-d).clip(lower=0).fillna(0).rolling(14).mean()
    want = 100 - 100 / (1 + gain / loss)
    np.testing.assert_allclose(got["r"].astype(float), want, rtol=1e-9, equal_nan=True)


@pytest.mark.parametrize("n", [1, 2, 541, 542, 3000])
def test_ema_and_macd_against_pandas(spark, n):
    prices = walk(n, seed=n)
    df = series.macd(series.ema(closes(spark, {1: prices}), "close_price", {"e3": 3, "e26": 26, "e1": 1}), "close_price")
    got = df.orderBy("date").toPandas()
    p = pd.Series(prices)

    def smooth(x, span):
        return x.ewm(span=span, adjust=False).mean()

    np.testing.assert_allclose(got["e1"], p)
    np.testing.assert_allclose(got["e3"], smooth(p, 3), rtol=1e-12)
    np.testing.assert_allclose(got["e26"], smooth(p, 26), rtol=1e-12)
    line = smooth(p, 12) - smooth(p, 26)
    np.testing.assert_allclose(got["macd_value"], line, atol=1e-9)
    np.testing.assert_allclose(got["macd_signal"], smooth(line, 9), atol=1e-9)


def test_spans_far_apart(spark):
    prices = [1000 + (i * 37) % 91 for i in range(900)]
    df = series.macd(series.ema(closes(spark, {1: prices}), "close_price", {"a": 2, "b": 5, "c": 500}), "close_price", 3, 400, 9)
    got, p = df.orderBy("date").toPandas(), pd.Series(prices)
    for name, span in (("a", 2), ("b", 5), ("c", 500)):
        np.testing.assert_allclose(got[name], p.ewm(span=span, adjust=False).mean(), rtol=1e-11)
    line = p.ewm(span=3, adjust=False).mean() - p.ewm(span=400, adjust=False).mean()
    np.testing.assert_allclose(got["macd_value"], line, atol=1e-8)
    np.testing.assert_allclose(got["macd_signal"], line.ewm(span=9, adjust=False).mean(), atol=1e-8)


def test_nothing_of_a_series_is_left_out_of_its_mean(spark):
    values = [1e200] + [0.0] * 2000
    df = spark.createDataFrame([(1, day(i), v) for i, v in enumerate(values)], "stock_id int, date date, v double")
    got = column(series.ema(df, "v", {"e": 9}), "e")
    wanted = pd.Series(values).ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(got, wanted, rtol=1e-9)
    assert got[-1] > 0


def test_means_keep_every_decimal_place(spark):
    df = spark.createDataFrame([(1, day(i), v) for i, v in enumerate(["1.0801", "1.0808", "1.0815"])], "stock_id int, date date, v string")
    as_decimal = df.withColumn("v", df.v.cast("decimal(10,4)"))
    assert column(series.sma(as_decimal, "v", {"m": 3}), "m")[-1] == 1.0808
    assert column(series.sma(df.withColumn("v", df.v.cast("double")), "v", {"m": 3}), "m")[-1] == pytest.approx(1.0808, rel=1e-15)
    wide = df.withColumn("v", df.v.cast("decimal(30,10)"))
    assert column(series.sma(wide, "v", {"m": 3}), "m")[-1] == pytest.approx(1.0808, rel=1e-15)
    bad = spark.createDataFrame([(1, day(i), v) for i, v in enumerate([1.0, float("nan"), 3.0, 5.0])], "stock_id int, date date, v double")
    assert column(series.sma(bad, "v", {"m": 2}), "m") == [None, None, None, 4.0]


def test_ema_of_a_long_span(spark):
    prices = walk(9000, seed=5)
    got = series.ema(closes(spark, {1: prices}), "close_price", {"e": 200}).orderBy("date").toPandas()
    np.testing.assert_allclose(got["e"], pd.Series(prices).ewm(span=200, adjust=False).mean(), rtol=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(100, 99_999), min_size=1, max_size=60))
def test_small_windows_against_pandas(spark, cents):
    prices = [c / 100 for c in cents]
    got = series.sma(closes(spark, {1: prices}), "close_price", {"m": 3}).orderBy("date").toPandas()
    want = pd.Series(prices).rolling(3).mean()
    np.testing.assert_allclose(got["m"].astype(float), want, rtol=1e-9, equal_nan=True)


def test_flat_series_has_no_rsi_and_no_features(spark):
    flat = closes(spark, {1: [100] * 220})
    assert set(column(series.rsi(flat, "close_price"), "rsi")) == {None}
    assert plans.features(flat).count() == 0


def test_rising_series_has_rsi_100(spark):
    rising = closes(spark, {1: range(100, 320)})
    values = column(series.rsi(rising, "close_price"), "rsi")
    assert values[:13] == [None] * 13 and set(values[13:]) == {100.0}
    assert set(column(plans.features(rising), "rsi_14")) == {100}


def test_history_rule(spark):
    df = closes(spark, {1: range(100, 299), 2: range(100, 300)})
    assert [r.stock_id for r in plans.features(df).collect()] == [2]
    assert series.min_history(df, 200).select("stock_id").distinct().collect()[0][0] == 2
    assert plans.features(df, min_rows=201).count() == 0


def test_null_inside_a_window(spark):
    df = series.sma(closes(spark, {1: [1, 2, None, 4, 5, 6, 7]}), "close_price", {"m": 3})
    assert column(df, "m") == [None] * 5 + [5.0, 6.0]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, day(i), x) for i, x in enumerate([1.0, float("nan"), 3.0, 5.0])],
                               "stock_id int, date date, close_price double")
    assert column(series.sma(df, "close_price", {"m": 2}), "m") == [None, None, None, 4.0]


def test_rounding_is_half_up(spark):
    df = series.sma(closes(spark, {1: [1.00, 1.01]}), "close_price", {"m": 2})
    assert str(df.select(F.col("m").cast("decimal(10,2)")).collect()[1][0]) == "1.01"


def cross_rows(spark, pairs):
    rows = [(1, day(i), float(a), float(b)) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "stock_id int, date date, a double, b double")


def test_cross_is_strict_on_both_sides(spark):
    df = series.crosses(cross_rows(spark, [(1, 2), (2, 2), (3, 2), (1, 2), (3, 2)]), "a", "b")
    assert column(df, "cross_up") == [False, False, False, False, True]
    assert column(df, "cross_down") == [False, False, False, True, False]


def test_no_signal_on_the_first_row(spark):
    rows = [(1, day(0), 3.0, 2.0, 50.0, 1.0, 0.0), (1, day(1), 1.0, 2.0, 40.5, -1.0, 0.0), (1, day(2), 3.0, 2.0, 30.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "stock_id int, date date, sma_50 double, sma_200 double, rsi_14 double, "
                                     "macd_value double, macd_signal double")
    out = scores.she_score(scores.with_signals(df))
    assert column(out, "trend_signal") == [0, -1, 1]
    assert column(out, "macd_score") == [0, 0, 100]
    assert column(out, "momentum_score") == [50.0, 59.5, 70.0]
    assert column(out, "she_score") == pytest.approx([20 + 15, 0 + 17.85, 40 + 21 + 30])
    apart = scores.macd_score(scores.momentum_score(scores.trend_signal(df)))
    assert apart.select("date", "trend_signal", "momentum_score", "macd_score").orderBy("date").collect() == \
        out.select("date", "trend_signal", "momentum_score", "macd_score").orderBy("date").collect()


def test_forward_return_and_label_edge(spark):
    df = series.forward_return(closes(spark, {1: [100, 102, 103]}), "close_price", {"f": 1, "g": 2})
    assert column(df, "f") == [pytest.approx(0.02), pytest.approx(103 / 102 - 1), None]
    assert column(df, "g")[1:] == [None, None]


def test_features_need_one_exchange_and_two_sorts(spark, tmp_path):
    path = str(tmp_path / "closes")
    closes(spark, {1: [1.0, 2.0]}).write.parquet(path)
    out = plans.features(spark.read.parquet(path))
    assert (count_of(out, "Exchange"), count_of(out, "Sort")) == (1, 2)


def test_panel_shares_the_exchange_of_the_features(spark, tmp_path):
    path = str(tmp_path / "closes")
    closes(spark, {1: [1.0, 2.0]}).write.parquet(path)
    out = plans.panel(plans.features(spark.read.parquet(path), keep=["close_price"]))
    assert count_of(out, "Exchange") == 1


def test_panel_of_stored_tables_needs_one_exchange(spark, tmp_path):
    bars = closes(spark, {1: walk(260, seed=1), 2: walk(230, seed=2)})
    bars.write.parquet(str(tmp_path / "bars"))
    plans.features(bars).write.parquet(str(tmp_path / "features"))
    stored = spark.read.parquet(str(tmp_path / "features")), spark.read.parquet(str(tmp_path / "bars"))
    out = plans.panel(plans.training_scan(*stored))
    assert count_of(out, "Exchange") == 1
    assert out.exceptAll(plans.panel(plans.features(bars, keep=["close_price"]))).count() == 0 and out.count() == 72
    some = plans.training_scan(stored[0], stored[1].filter("stock_id = 1"))
    assert [r[0] for r in some.select("stock_id").distinct().collect()] == [1] and some.count() == 61


def test_pieces_give_the_same_features(spark):
    df = closes(spark, {1: walk(2600, seed=1), 2: walk(900, seed=2), 3: walk(150, seed=3)})
    whole = plans.features(df)
    cut = plans.features(df, slice_of=F.year("date"), piece_rows=600)
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_piece_size_is_bounded_for_a_hot_key(spark):
    df = closes(spark, {1: walk(4000, seed=1), 2: walk(30, seed=2)})
    cut = series.split_series(df, F.year("date"), rows=500, halo=40, ahead=10)
    sizes = cut.groupBy("stock_id", "piece").count()
    assert sizes.agg(F.max("count")).first()[0] <= 550
    assert cut.filter("not is_halo").count() == 4030


def test_timestamps_are_cut_without_being_told(spark):
    prices = walk(1500, seed=4)
    rows = [(1, i, float(p)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "stock_id int, i int, close double").select(
        "stock_id", F.timestamp_seconds(F.col("i") * 3600).alias("at"), F.col("close").cast("decimal(10,2)").alias("close_price"))
    cut = plans.features(df, order="at", piece_rows=600)
    daily = plans.features(closes(spark, {1: prices}))
    assert "piece" in cut._jdf.queryExecution().optimizedPlan().toString()
    names = ["sma_50", "sma_200", "rsi_14", "macd_value", "macd_signal"]
    assert [tuple(r) for r in cut.orderBy("at").select(*names).collect()] == \
        [tuple(r) for r in daily.orderBy("date").select(*names).collect()]


def test_integers_need_slices(spark):
    df = spark.createDataFrame([(1, 1, 2.0)], "stock_id int, n int, close_price double")
    with pytest.raises(ValueError):
        plans.features(df, order="n")


def test_results_do_not_depend_on_partitioning(spark):
    df = closes(spark, {k: walk(260, seed=k) for k in range(6)})
    base = {tuple(r) for r in plans.features(df).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert {tuple(r) for r in plans.features(df.repartition(5)).collect()} == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_latest_per_key(spark):
    df = closes(spark, {1: [1, 2, 3], 2: [7]})
    assert {(r.stock_id, float(r.close_price)) for r in series.latest_per_key(df).collect()} == {(1, 3.0), (2, 7.0)}


def test_panel_drops_the_rows_without_a_future(spark):
    rows = plans.features(closes(spark, {1: walk(260, seed=9)}), keep=["close_price"])
    out = plans.with_symbol(plans.panel(rows), stocks(spark, {1: "A"}))
    assert out.count() == rows.count() - 10
    assert out.filter("target = 1").count() == out.filter("future_return > 0.02").count()


def test_since_reads_less_and_gives_the_same(spark, tmp_path):
    path = str(tmp_path / "bars")
    df = closes(spark, {1: walk(2000, seed=1), 2: [None] * 1400 + list(walk(600, seed=2)), 3: walk(300, seed=3)})
    store.with_month(df.dropna()).write.partitionBy("month").parquet(path)
    table = spark.read.parquet(path)
    since = day(1500)
    kept = series.since_with_halo(table, since, 541)
    counts = {r.stock_id: r["count"] for r in kept.filter(F.col("date") < since).groupBy("stock_id").count().collect()}
    assert 541 <= counts[1] < 541 + 31 and counts[2] == 100 and 3 not in counts
    cut, whole = plans.features(table, since=since), plans.features(table).filter(F.col("date") >= since)
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0 and cut.count() == 901
    scans = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert any("month" in line and "subquery" in line.lower() for line in scans)


def test_since_before_all_rows(spark):
    df = closes(spark, {1: walk(260, seed=1)})
    assert plans.features(df, since=day(-10)).count() == plans.features(df).count() == 61


def test_last_rows(spark):
    df = closes(spark, {1: [1, 2, 3], 2: [7]})
    got = sorted((r.stock_id, float(r.close_price)) for r in series.last_rows(df, 2).collect())
    assert got == [(1, 2.0), (1, 3.0), (2, 7.0)]


@pytest.mark.parametrize("name", ["first_difference", "sma", "rsi", "ema", "macd", "crosses", "forward_return",
                                  "trend_signal", "macd_score", "with_signals"])
def test_every_operator_works_on_pieces(spark, monkeypatch, name):
    """Timestamp order: keys are cut, and the values are those of whole keys."""
    monkeypatch.setattr(series.piecewise, "__kwdefaults__", {**series.piecewise.__kwdefaults__, "piece_rows": 60})
    n = 1300 if name in ("ema", "macd") else 250
    prices = walk(n, seed=11)
    rows = [(k, i, float(p + k)) for k in (1, 2) for i, p in enumerate(prices)]
    base = spark.createDataFrame(rows, "stock_id int, i int, x double").select(
        "stock_id", F.timestamp_seconds(F.col("i") * 5000).alias("at"),
        F.date_add(F.lit(day(0)), F.col("i")).alias("date"), F.col("x").cast("decimal(10,2)").alias("close_price"),
        (F.pmod(F.hash("i"), F.lit(7))).alias("a"), (F.pmod(F.hash("i", F.lit(1)), F.lit(7))).alias("b"))
    frame = base.withColumns({"sma_50": F.col("a"), "sma_200": F.col("b"), "macd_value": F.col("b"),
                              "macd_signal": F.col("a"), "rsi_14": F.col("a") * 10})
    calls = {
        "first_difference": lambda df, **o: series.first_difference(df, "close_price", "out", **o),
        "sma": lambda df, **o: series.sma(df, "close_price", {"out": 20, "out2": 5}, **o),
        "rsi": lambda df, **o: series.rsi(df, "close_price", 14, "out", **o),
        "ema": lambda df, **o: series.ema(df, "close_price", {"out": 12, "out2": 26}, **o),
        "macd": lambda df, **o: series.macd(df, "close_price", line_out="out", signal_out="out2", **o),
        "crosses": lambda df, **o: series.crosses(df, "a", "b", up="out", down="out2", **o),
        "forward_return": lambda df, **o: series.forward_return(df, "close_price", {"out": 1, "out2": 10}, **o),
        "trend_signal": lambda df, **o: scores.trend_signal(df, **o).withColumnRenamed("trend_signal", "out"),
        "macd_score": lambda df, **o: scores.macd_score(df, **o).withColumnRenamed("macd_score", "out"),
        "with_signals": lambda df, **o: scores.with_signals(df, **o).withColumnsRenamed(
            {"trend_signal": "out", "macd_score": "out2"}),
    }
    whole = calls[name](frame, order="date")
    cut = calls[name](frame, order="at")
    assert "piece" not in cut.columns and cut.columns == whole.columns
    assert "piece" in cut._jdf.queryExecution().optimizedPlan().toString()
    for c in [c for c in ("out", "out2") if c in whole.columns]:
        a, b = ([r[c] for r in df.orderBy("stock_id", "date").select(c).collect()] for df in (whole, cut))
        assert len(a) == len(b) == 2 * n
        assert [x is None for x in a] == [x is None for x in b]
        assert [float(x) for x in a if x is not None] == pytest.approx([float(x) for x in b if x is not None], rel=1e-9, abs=1e-9)
