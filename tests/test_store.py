"""Keyed writes, landing files, daily jobs and streaming."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas as S
from tickframe.operators import model, quality, ranking, store
from tickframe.plans import daily
from tickframe.plans import features as plans
from tickframe.plans import incremental
from tickframe.session import stage
from tickframe.sources import landing, tables
from tickframe.sources import testdata as data
from tickframe.streaming import ingest

from .helpers import closes, count_of, day, stocks


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def kv(spark, pairs):
    return spark.createDataFrame([(k, day(d), v) for k, d, v in pairs], "stock_id int, date date, v int")


KEYS = ["stock_id", "date"]


def test_insert_keeps_the_stored_row_and_the_first_new_one(spark):
    old, new = kv(spark, [(1, 0, 10)]), kv(spark, [(1, 0, 99), (2, 0, 5), (2, 0, 6)])
    once = store.insert_if_absent(old, new, KEYS, order="v")
    assert rows(once, "stock_id", "v") == [(1, 10), (2, 5)]
    assert rows(store.insert_if_absent(once, new, KEYS, order="v"), *once.columns) == rows(once, *once.columns)


def test_upsert_takes_the_last_new_row(spark):
    old, new = kv(spark, [(1, 0, 10), (3, 0, 1)]), kv(spark, [(1, 0, 99), (2, 0, 5), (2, 0, 6)])
    once = store.upsert(old, new, KEYS, order="v")
    assert rows(once, "stock_id", "v") == [(1, 99), (2, 6), (3, 1)]
    assert rows(store.upsert(once, new, KEYS, order="v"), *once.columns) == rows(once, *once.columns)


def test_every_date_of_the_batch_is_replaced(spark):
    old, new = kv(spark, [(1, 0, 1), (2, 0, 1), (1, 1, 1), (1, 2, 1)]), kv(spark, [(9, 0, 2), (9, 1, 2)])
    assert rows(store.replace_dates(old, new), "stock_id", "v") == [(1, 1), (9, 2), (9, 2)]


def bar_rows(spark, marks):
    """Bars of ``(stock_id, date, close)``."""
    df = spark.createDataFrame([(k, d, float(p)) for k, d, p in marks], "stock_id int, date date, p double")
    price = F.col("p").cast(S.PRICE)
    return df.select("stock_id", "date", *(price.alias(c) for c in S.BARS.names[2:7]), F.lit(10).cast("bigint").alias("volume"))


def test_append_touches_only_new_rows(spark, tmp_path):
    path = str(tmp_path / "bars")
    a, b = dt.date(2001, 1, 5), dt.date(2001, 2, 5)
    store.append_absent(bar_rows(spark, [(1, a, 10)]), path, S.BARS, KEYS)
    batch = bar_rows(spark, [(1, a, 99), (1, b, 20), (2, a, 30)])
    for _ in range(2):
        store.append_absent(batch, path, S.BARS, KEYS)
        got = rows(store.open_table(spark, path, S.BARS), "stock_id", "date", "close_price")
        assert [(k, d, float(p)) for k, d, p in got] == [(1, a, 10.0), (1, b, 20.0), (2, a, 30.0)]


def test_merge_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "features")
    a, b = dt.date(2001, 1, 5), dt.date(2001, 2, 5)
    store.merge_rows(bar_rows(spark, [(1, a, 10), (1, b, 20), (2, b, 21)]), path, S.BARS, KEYS)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "features" / "month=200101").glob("*.parquet")}
    store.merge_rows(bar_rows(spark, [(1, b, 77), (3, b, 5)]), path, S.BARS, KEYS)
    got = rows(store.open_table(spark, path, S.BARS), "stock_id", "date", "close_price")
    assert [(k, float(p)) for k, _, p in got] == [(1, 10.0), (1, 77.0), (2, 21.0), (3, 5.0)]
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "features" / "month=200101").glob("*.parquet")}
    assert before == after


def test_touched_months_prune_the_stored_table(spark, tmp_path):
    path = str(tmp_path / "bars")
    store.append_absent(bar_rows(spark, [(1, dt.date(2001, m, 1), m) for m in range(1, 13)]), path, S.BARS, KEYS)
    table = store.open_table(spark, path, S.BARS).filter(F.col("month").isin([200103]))
    assert len(table.inputFiles()) == 12
    assert "PartitionFilters: [isnotnull(month" in table._jdf.queryExecution().executedPlan().toString()


def test_bucketed_series_need_no_exchange(spark, tmp_path):
    store.save_bucketed(closes(spark, {1: [1, 2, 3], 2: [4, 5, 6]}), "closes_by_key", str(tmp_path / "c"), 4,
                        "stock_id", "date")
    out = plans.panel(plans.features(spark.table("closes_by_key"), keep=["close_price"]))
    assert count_of(out, "Exchange") == 0


def test_cleaning_and_rejects_split_the_rows(spark, root):
    raw = data.raw_bars(spark, root)
    good, bad = quality.clean_bars(raw), quality.rejects(raw)
    assert good.count() + bad.count() == raw.count() and bad.count() > 0
    assert good.filter("adjusted_close_price is null").count() == 0


def test_adjusted_price_may_be_missing(spark):
    df = bar_rows(spark, [(1, day(0), 5)]).withColumn("adjusted_close_price", F.lit(None).cast(S.PRICE))
    assert quality.clean_bars(df).count() == 1


def test_csv_with_bad_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Ticker,Date,Open,High,Low,Close,Adj Close,Volume\n"
                    "M&M.NS,2024-01-02,1,2,0.5,1.505,,100\n"
                    "M&M.NS,2024-01-03,x,2,0.5,1.5,1.5,100.0\n"
                    "TCS.NS,2024-01-03,1,2,0.5,1.5,1.5,0\n"
                    "NONE.NS,2024-01-03,1,2,0.5,1.5,1.5,9\n")
    got = landing.to_bars(landing.read_landing(spark, str(path), "csv"), stocks(spark, {7: "M&M", 8: "TCS"}))
    good = quality.clean_bars(got).collect()
    assert [(r.stock_id, str(r.close_price), r.volume, r.adjusted_close_price) for r in good] == [(7, "1.51", 100, None)]
    assert sorted(r.reason for r in quality.rejects(got).collect()) == ["missing open_price", "no volume"]


def test_json_and_parquet_landing(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text(
        '{"Ticker":"TCS.NS","Date":"2024-01-03","Open":1,"High":2,"Low":1,"Close":1.5,"Adj Close":1.4,"Volume":3}\n')
    names = stocks(spark, {8: "TCS"})
    first = landing.to_bars(landing.read_landing(spark, str(tmp_path / "j"), "json"), names)
    typed = landing.read_landing(spark, str(tmp_path / "j"), "json").select(
        "Ticker", F.col("Date").cast("date"), *(F.col(f"`{c}`").cast("double") for c in landing.VENDOR_FIELDS))
    typed.write.parquet(str(tmp_path / "p"))
    second = landing.to_bars(landing.read_landing(spark, str(tmp_path / "p")), names)
    assert first.collect() == second.collect()
    assert first.dtypes == second.dtypes == [(f.name, f.dataType.simpleString()) for f in S.BARS]


def test_headers(spark):
    one = spark.createDataFrame([(day(0), 1.0, 2.0)], ["Date", "Open|A.NS", "Close|A.NS"])
    assert landing.flatten_header(one).columns == ["Date", "Open", "Close"]
    two = spark.createDataFrame([(day(0), 1.0, 2.0, 3.0)], ["Date", "Open|A.NS", "Close|A.NS", "Close|B.NS"])
    assert rows(landing.wide_to_long(two).fillna(-1.0), "Ticker", "Open", "Close") == [("A.NS", 1.0, 2.0), ("B.NS", -1.0, 3.0)]


def test_ticker_keys(spark):
    df = spark.createDataFrame([("TCS.NS",), ("TCSNS",), ("A.NS.NS",)], "t string")
    assert [r[0] for r in df.select(landing.symbol_of("t")).collect()] == ["TCS", "TCSNS", "A.NS"]


def test_bootstrap_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "db")
    for _ in range(2):
        tables.bootstrap(spark, root)
    assert tables.scan(spark, root, "stocks").count() == 50
    for name, (schema, _) in tables.TABLES.items():
        df = tables.scan(spark, root, name)
        assert df.columns == schema.names
        assert name == "stocks" or df.count() == 0
    again = tables.add_seed(tables.scan(spark, root, "stocks"), tables.seed_stocks(spark))
    assert again.count() == 50


def test_seed_order_and_spelling():
    symbols = [s for s, _ in tables.SEED_STOCKS]
    assert len(set(symbols)) == 50 and "M&M" in symbols and "BAJAJ-AUTO" in symbols


def test_daily_jobs(spark, root, tmp_path):
    db, model_path = str(tmp_path / "db"), str(tmp_path / "model")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    raw = data.raw_bars(spark, root).join(data.stocks(spark, root), "stock_id")
    back = {c: f for f, c in landing.VENDOR_FIELDS.items()}
    landed = stage(raw.select(landing.ticker_of("symbol").alias("Ticker"), F.col("date").alias("Date"),
                              *(F.col(c).cast("double").alias(back[c]) for c in back)), "landed")
    for _ in range(2):
        daily.ingest(spark, db, landed)
        daily.build_features(spark, db)
        daily.rank(spark, db)
    bars = quality.clean_bars(data.raw_bars(spark, root))
    assert tables.scan(spark, db, "bars").exceptAll(bars).count() == 0
    assert tables.scan(spark, db, "bars").count() == bars.count()
    want = plans.features(bars)
    assert tables.scan(spark, db, "features").exceptAll(want).count() == 0
    recs = tables.scan(spark, db, "recommendations")
    assert recs.count() == 10 and recs.filter("model_type = 'LEM' and score <> 0").count() == 0
    panel = plans.with_symbol(plans.panel(plans.training_scan(tables.scan(spark, db, "features"),
                                                              tables.scan(spark, db, "bars"))),
                              tables.scan(spark, db, "stocks"))
    model.save(model.train(panel, maxIter=3, maxDepth=2), model_path)
    daily.rank(spark, db, model_path)
    recs = tables.scan(spark, db, "recommendations")
    assert recs.count() == 10 and recs.filter("model_type = 'LEM' and score between 1 and 99").count() == 5
    assert daily.latest(spark, db).count() >= 1
    stored = tables.scan(spark, db, "features")
    last = stored.agg(F.max("date")).first()[0]
    daily.rank(spark, db, as_of=last)
    assert daily.latest(spark, db).count() == 10
    old = stored.filter(F.col("date") < "2000-06-01").agg(F.max("date")).first()[0]
    daily.rank(spark, db, as_of=old)
    picked = tables.scan(spark, db, "recommendations").filter((F.col("date") == old) & (F.col("model_type") == "SHE"))
    whole = ranking.latest_scores(stored.filter(F.col("date") <= old), tables.scan(spark, db, "stocks"))
    assert rows(picked, "stock_id", "score") == rows(ranking.recommend(whole, {"SHE": "she_score"}), "stock_id", "score")
    one = tables.series_of(tables.scan(spark, db, "bars"), 1).collect()
    assert [r.date for r in one] == sorted(r.date for r in one) and len(one) > 400


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    table, landed, checkpoint, rejects = (str(tmp_path / n) for n in ("t", "landing", "c", "r"))
    bad = bar_rows(spark, [(5, day(0), 9)]).withColumn("volume", F.lit(0).cast("bigint"))
    bar_rows(spark, [(1, day(0), 10), (2, day(0), 20)]).unionByName(bad).write.mode("append").parquet(landed)
    ingest.ingest_available(spark, landed, table, checkpoint, rejects)
    ingest.ingest_available(spark, landed, table, checkpoint, rejects)
    bar_rows(spark, [(1, day(0), 99), (1, day(40), 11)]).write.mode("append").parquet(landed)
    ingest.ingest_available(spark, landed, table, checkpoint, rejects)
    got = rows(store.open_table(spark, table, S.BARS), "stock_id", "date", "close_price")
    assert [(k, d, float(p)) for k, d, p in got] == [(1, day(0), 10.0), (1, day(40), 11.0), (2, day(0), 20.0)]
    assert [r.stock_id for r in spark.read.parquet(rejects).collect()] == [5]


def test_stream_in_small_batches(spark, tmp_path):
    table, landed, checkpoint = (str(tmp_path / n) for n in ("t", "landing", "c"))
    for n in range(3):
        bar_rows(spark, [(1, day(0), 10 + n), (n + 2, day(0), 20)]).coalesce(1).write.mode("append").parquet(landed)
    ingest.ingest_available(spark, landed, table, checkpoint, files_per_batch=1)
    got = rows(store.open_table(spark, table, S.BARS), "stock_id", "close_price")
    assert [(k, float(p)) for k, p in got] == [(1, 10.0), (2, 20.0), (3, 20.0), (4, 20.0)]


def test_jdbc_options():
    from tickframe.sources import jdbc
    options = jdbc.read_options("jdbc:x", "bars", partitions=8, bounds=(1, 1000))
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "stock_id"
    assert int(jdbc.read_options("jdbc:x", "stocks", bounds=(1, 50))["numPartitions"]) > 1
    with pytest.raises(TypeError):
        jdbc.read_options("jdbc:x", "stocks")
    assert jdbc.bounds_query("bars") == "select min(stock_id) as low, max(stock_id) as high from bars"


def test_features_by_since_equal_a_full_run(spark, root, tmp_path):
    db = str(tmp_path / "db")
    tables.bootstrap(spark, db)
    bars = data.bars(spark, root)
    store.append_absent(bars, f"{db}/bars", S.BARS, S.SERIES_KEY)
    daily.build_features(spark, db)
    want = rows(tables.scan(spark, db, "features"), *S.FEATURES.names)
    late = (tmp_path / "db" / "features" / "month=199803")
    before = {p.name: p.stat().st_mtime_ns for p in late.glob("*.parquet")}
    daily.build_features(spark, db, since=dt.date(2001, 1, 1))
    assert rows(tables.scan(spark, db, "features"), *S.FEATURES.names) == want
    assert before and before == {p.name: p.stat().st_mtime_ns for p in late.glob("*.parquet")}


def test_missing_and_impossible_cells_cost_only_their_row(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    cells = [("A.NS", 1.0, 5.0), ("B.NS", nan, 5.0), ("C.NS", 1.0, nan), ("D.NS", 1e12, 5.0), ("E.NS", inf, 5.0)]
    df = spark.createDataFrame([(t, dt.date(2024, 1, 2), 1.0, 1.0, 1.0, c, 1.0, v) for t, c, v in cells],
                               landing.vendor_schema(text=False))
    df.write.parquet(str(tmp_path / "l"))
    names = stocks(spark, {i: c for i, c in enumerate("ABCDE")})
    got = landing.to_bars(landing.read_landing(spark, str(tmp_path / "l")), names)
    assert [r.stock_id for r in quality.clean_bars(got).collect()] == [0]
    assert sorted((r.stock_id, r.reason) for r in quality.rejects(got).collect()) == [
        (1, "missing close_price"), (2, "missing volume"), (3, "missing close_price"), (4, "missing close_price")]


def test_a_key_that_storage_cannot_hold_does_not_stop_the_others(spark):
    rows = [(k, day(i), p + i % 7) for k, p in ((1, 100.0), (2, 1e9), (3, 1e15), (4, 1e300), (5, float('nan'))) for i in range(230)]
    df = spark.createDataFrame(rows, "stock_id int, date date, close_price double")
    assert {r.stock_id for r in plans.features(df).collect()} == {1}


def vendor(spark, rows):
    return spark.createDataFrame(rows, landing.vendor_schema(text=True))


def test_ingest_reads_once_and_loses_no_row(spark, tmp_path):
    db = str(tmp_path / "db")
    stocks(spark, {1: "AAA", 2: "BBB"}).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    good = ("1.5", "2", "1", "1.75", "1.75", "10")
    landed = vendor(spark, [("AAA.NS", "2001-01-02", *good), ("AAA.NS", "notadate", *good), ("ZZZ.NS", "2001-01-02", *good),
                            ("BBB.NS", "2001-01-02", "x", *good[1:]), ("BBB.NS", "2001-01-03", *good[:5], "0"), (None, None, *good)])
    read = spark.sparkContext.accumulator(0)

    def seen(ticker):
        read.add(1)
        return True
    counted = landed.repartition(3).filter(F.udf(seen, "boolean")("Ticker"))
    for run in (1, 2):
        daily.ingest(spark, db, counted)
        assert read.value == 6 * run
        assert [(r.stock_id, r.date) for r in tables.scan(spark, db, "bars").collect()] == [(1, dt.date(2001, 1, 2))]
        reasons = sorted((r.ticker or "", r.reason) for r in spark.read.parquet(f"{db}/rejects").collect())
        assert reasons == [("", "missing stock_id"), ("AAA.NS", "missing date"), ("BBB.NS", "missing open_price"),
                           ("BBB.NS", "no volume"), ("ZZZ.NS", "unknown ticker")]


def test_keyed_writes_refuse_null_keys(spark, tmp_path):
    bad = spark.createDataFrame([(1, None, 1.0)], "stock_id int, date date, v double")
    with pytest.raises(Exception, match="null date in a keyed write"):
        store.absent_rows(bad.limit(0), bad, ["stock_id", "date"]).collect()
    schema = T.StructType([T.StructField(n, t) for n, t in (("stock_id", T.IntegerType()), ("date", T.DateType()), ("v", T.DoubleType()))])
    with pytest.raises(Exception, match="null"):
        store.merge_rows(bad, str(tmp_path / "t"), schema, ["stock_id", "date"])


def test_symbols_of_very_many_stocks_differ(spark):
    numbers = spark.range(1, 12_001).select(data.letters(F.col("id")).alias("symbol"))
    assert numbers.distinct().count() == 12_000


def test_a_later_ranking_keeps_earlier_days(spark, tmp_path):
    db = str(tmp_path / "db")
    names = {k: f"S{k}" for k in range(1, 8)}
    stocks(spark, names).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    def features_on(day_, keys):
        made = [(k, day_, 1.0, 2.0, 10.0 * k, 0.0, 1.0) for k in keys]
        df = spark.createDataFrame(made, "stock_id int, date date, sma_50 double, sma_200 double, rsi_14 double, macd_value double, macd_signal double")
        return df.select(*(F.col(f.name).cast(f.dataType) for f in S.FEATURES.fields))
    store.merge_rows(features_on(day(10), names), f"{db}/features", S.FEATURES, S.SERIES_KEY)
    daily.rank(spark, db, as_of=day(10))
    store.merge_rows(features_on(day(11), list(names)[1:]), f"{db}/features", S.FEATURES, S.SERIES_KEY)
    daily.rank(spark, db)
    counts = {r.date: r["count"] for r in tables.scan(spark, db, "recommendations").groupBy("date").count().collect()}
    assert counts == {day(10): 10, day(11): 10}
    assert {r.data_date for r in daily.latest(spark, db).collect()} == {day(10), day(11)}


def test_features_from_state_read_only_changed_months(spark, tmp_path):
    db = str(tmp_path / "db")
    pick = random.Random(8)
    def bars_of(keys, days):
        made = [(k, day(i), *[decimal.Decimal(f"{pick.uniform(900, 1100):.2f}")] * 5, 5) for k in keys for i in days]
        return spark.createDataFrame(made, S.BARS)
    def arrive(rows_):
        store.append_absent(rows_, f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals")
        daily.build_features(spark, db)
    def same():
        whole = plans.features(store.open_table(spark, f"{db}/bars", S.BARS))
        got = store.open_table(spark, f"{db}/features", S.FEATURES).select(*whole.columns)
        assert got.count() > 0 and got.exceptAll(whole).count() == 0 == whole.exceptAll(got).count()
    arrive(bars_of([1, 2], range(700)))
    same()
    # Some new days, a gap, a new key with a long history, and a key that is still short.
    arrive(bars_of([1], range(700, 705)).unionByName(bars_of([3], range(0, 690))).unionByName(bars_of([4], range(690, 700))))
    same()
    arrive(bars_of([1, 2, 3, 4], range(720, 740)))
    same()
    # A late bar, and a run without news.
    arrive(bars_of([2], [710]).unionByName(bars_of([1], range(740, 742))))
    same()
    before = incremental._versions(spark, db)
    daily.build_features(spark, db)
    assert incremental._versions(spark, db) == before
    state = incremental.stored_state(spark, db)
    assert max(len(r.closes) for r in state.collect()) == incremental.HELD


def test_vendor_files_through_the_stream(spark, tmp_path):
    table, landed, checkpoint, bad = (str(tmp_path / n) for n in ("t", "landing", "c", "r"))
    names = stocks(spark, {1: "AAA"})
    day_one = spark.createDataFrame([("AAA.NS", dt.date(2001, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0, 5.0), ("QQQ.NS", dt.date(2001, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0, 5.0)],
                                    landing.vendor_schema(text=False))
    for _ in range(2):
        day_one.write.mode("append").parquet(landed)
        ingest.ingest_vendor_files(spark, landed, table, checkpoint, names, rejects=bad)
    assert [(r.stock_id, r.date) for r in store.open_table(spark, table, S.BARS).collect()] == [(1, dt.date(2001, 1, 2))]
    assert {r.reason for r in spark.read.parquet(bad).collect()} == {"unknown ticker"}
