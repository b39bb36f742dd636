"""The checked queries: each takes a session and a folder of tables.

Results show decimals as doubles and round quotients, so that they can be
compared by value with SQL on another engine.
"""

from __future__ import annotations

import datetime as dt
import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas as S
from tickframe.functions import scores, text
from tickframe.operators import boosting, curves, metrics, quality, ranking, returns, series, store
from tickframe.operators import model as lem
from tickframe.plans import backtest, context, daily
from tickframe.plans import features as plans
from tickframe.session import new_path, stage, stage_once
from tickframe.sources import landing, tables
from tickframe.sources import testdata as data
from tickframe.streaming import ingest

TRAIN_END = dt.date(1999, 12, 31)
TEST_START = dt.date(2000, 1, 1)
PAST_DATES = [dt.date(1997, 2, 1), dt.date(1998, 12, 31), dt.date(2000, 5, 17)]
STORED_UNTIL = dt.date(1999, 1, 1)
STRATEGIES = backtest.BASE_STRATEGIES
SERIES = [*STRATEGIES, returns.BENCHMARK]
# The smallest setting of the tuning grid.
SMALLEST = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3}
# A second score that SQL can follow, in the place of the learned one.
STAND_IN = {"SHE": "she_score", "LEM": "momentum_score"}


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Decimals as doubles, doubles rounded to ``digits``."""
    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if digits is not None and isinstance(field.dataType, T.DoubleType):
            return F.round(column, digits).alias(field.name)
        return column
    return df.select(*(shown(f) for f in df.schema.fields))


# ---- inputs shared by several queries

def feature_rows(spark, root):
    return plans.features(data.bars(spark, root))


def panel(spark, root):
    closes = series.dealt(data.bars(spark, root).select("stock_id", "date", "close_price"))
    return plans.panel_from_bars(closes, data.stocks(spark, root))


def panel_once(spark, root):
    """The panel written aside, where training and scoring both read it."""
    return stage(panel(spark, root), "panel")


def base_returns(spark, root):
    """Daily returns, staged once per session: every report reads the small table."""
    return stage_once(spark, (root, "base-returns"), lambda: backtest.simulate(panel(spark, root), STRATEGIES, start=TEST_START))


def latest_scored(spark, root):
    return ranking.latest_scores(feature_rows(spark, root), data.stocks(spark, root))


def stored_and_batch(spark, root):
    """Bars stored so far, and a batch that sends all bars again at other
    prices, some of them twice."""
    bars = quality.clean_bars(data.raw_bars(spark, root))
    stored = bars.filter(F.col("date") < STORED_UNTIL)
    copies = F.when(F.col("volume") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    batch = bars.withColumn("seq", F.explode(copies)) \
        .withColumn("close_price", (F.col("close_price") + F.col("seq")).cast(S.PRICE))
    return stored, batch


def dual_recommendations(spark, root):
    return ranking.recommend(latest_scored(spark, root), STAND_IN)


def one_date_recommendations(spark, root):
    """Both rankings as of the newest date, stored as the daily job stores them."""
    rows = stage(scores.with_signals(feature_rows(spark, root)), "signals")
    last = rows.agg(F.max("date").alias("last")).scalar()
    scored = plans.with_symbol(scores.she_score(rows.filter(F.col("date") == last)), data.stocks(spark, root))
    return stage(ranking.recommend(scored, STAND_IN), "recommendations")


def vendor_rows(spark, root):
    """Bars as vendor text: some dates and cells do not parse, some tickers are unknown."""
    raw, stocks = data.raw_bars(spark, root), data.stocks(spark, root)
    back = {column: field for field, column in landing.VENDOR_FIELDS.items()}
    spot = F.col("stock_id") * 17 + F.datediff("date", F.lit("1995-01-01").cast("date"))
    named = raw.join(stocks.select("stock_id", "symbol"), "stock_id")
    ticker = F.when(spot % 83 == 0, F.concat(F.lit("NO"), "symbol")).otherwise(F.col("symbol"))
    day = F.when(spot % 79 == 0, F.lit("notadate")).otherwise(F.col("date").cast("string"))
    return named.select(landing.ticker_of(ticker).alias("Ticker"), day.alias("Date"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit("n/a")).alias(back[c]) for c in back))


def daily_tables(spark, root):
    """A database after the ingest job ran twice over landed text files."""
    db, files = new_path(spark, "db"), new_path(spark, "landing")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    vendor_rows(spark, root).write.option("header", "true").csv(files)
    for _ in range(2):
        daily.ingest(spark, db, landing.read_landing(spark, files, "csv"))
    return db


# ---- cleaning, storing, checking

def clean_bars(spark, root):
    return plain(quality.clean_bars(data.raw_bars(spark, root)))


def rejects(spark, root):
    return plain(quality.rejects(data.raw_bars(spark, root)))


def bars_insert_if_absent(spark, root):
    stored, batch = stored_and_batch(spark, root)
    return plain(store.insert_if_absent(stored, batch, S.SERIES_KEY, order="seq"))


def features_upsert(spark, root):
    rows = feature_rows(spark, root)
    stored = rows.filter(F.col("date") < TEST_START)
    batch = rows.filter(F.col("date") >= STORED_UNTIL).withColumn("sma_50", (F.col("sma_50") + 1).cast(S.PRICE))
    return plain(store.upsert(stored, batch, S.SERIES_KEY))


def merged_feature_table(spark, root):
    """The upsert against a stored, month-partitioned table."""
    path = new_path(spark, "features")
    rows = stage(feature_rows(spark, root), "feature-rows")
    store.merge_rows(rows.filter(F.col("date") < TEST_START), path, S.FEATURES, S.SERIES_KEY)
    again = rows.filter(F.col("date") >= STORED_UNTIL).withColumn("sma_50", (F.col("sma_50") + 1).cast(S.PRICE))
    store.merge_rows(again, path, S.FEATURES, S.SERIES_KEY)
    return plain(store.open_table(spark, path, S.FEATURES).select(*S.FEATURES.names))


def replace_dates(spark, root):
    bars = data.bars(spark, root).select("stock_id", "date", "close_price")
    batch = bars.filter((F.col("date") >= TEST_START) & (F.col("close_price") >= 1050)) \
        .withColumn("close_price", F.lit(1).cast(S.PRICE))
    return plain(store.replace_dates(bars, batch))


def dq_report(spark, root):
    raw = data.raw_bars(spark, root)
    untidy = raw.unionByName(raw.filter(F.col("volume") >= 45))
    active = data.table(spark, root, "supplier").filter(F.col("s_acctbal") > 0) \
        .select((F.col("s_suppkey") + 1).cast("int").alias("stock_id"))
    return quality.report(untidy, data.stocks(spark, root).join(active, "stock_id", "left_semi"), min_rows=540)


def orphan_bars(spark, root):
    active = data.table(spark, root, "supplier").filter(F.col("s_acctbal") > 0) \
        .select((F.col("s_suppkey") + 1).cast("int").alias("stock_id"))
    return quality.orphans(data.bars(spark, root), active, ["stock_id"])


def sector_files(spark, root):
    """A wide vendor-like file: one column per field and sector."""
    sectors = [r[0] for r in data.table(spark, root, "nation").select("n_name").orderBy("n_name").collect()]
    joined = data.bars(spark, root).join(data.stocks(spark, root).select("stock_id", "sector"), "stock_id")
    wide = joined.groupBy(F.col("date").alias("Date")).pivot("sector", sectors).agg(
        F.max("high_price").alias("High"), F.min("low_price").alias("Low"), F.sum("volume").alias("Volume"))
    swap = {f"{s}_{f}": f"{f}|{s}" for s in sectors for f in ("High", "Low", "Volume")}
    return wide.withColumnsRenamed(swap)


def wide_to_long_bars(spark, root):
    long = landing.wide_to_long(sector_files(spark, root)).filter(F.col("Volume") > 0)
    return plain(long.select(F.col("Date").alias("date"), F.col("Ticker").alias("ticker"), F.col("High").alias("high"),
                             F.col("Low").alias("low"), F.col("Volume").alias("volume")))


def ticker_key(spark, root):
    keyed = data.stocks(spark, root).withColumn("ticker", landing.ticker_of("symbol"))
    return keyed.select("stock_id", "ticker", landing.symbol_of("ticker").alias("symbol"))


def landed_bars(spark, root):
    """Vendor text rows typed and keyed; cells that do not parse make rejects."""
    raw, stocks = data.raw_bars(spark, root), data.stocks(spark, root)
    back = {column: field for field, column in landing.VENDOR_FIELDS.items()}
    named = raw.join(stocks.select("stock_id", "symbol"), "stock_id")
    files = named.select(
        landing.ticker_of("symbol").alias("Ticker"), F.col("date").cast("string").alias("Date"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("n/a")).alias(back[c]) for c in back))
    return plain(quality.clean_bars(landing.to_bars(files, stocks)))


def daily_ingest_table(spark, root):
    return plain(tables.scan(spark, daily_tables(spark, root), "bars"))


def daily_ingest_rejects(spark, root):
    rows = spark.read.parquet(f"{daily_tables(spark, root)}/rejects")
    return plain(rows.select("ticker", "date_text", *S.BAR_FIELDS, "reason"))


def _write_csv(df, folder):
    df.write.mode("append").option("header", "true").csv(folder)


def vendor_csv_any_order(spark, root):
    """Bars from text files whose columns stand in other orders, with columns too many and too few."""
    db, files = new_path(spark, "db"), new_path(spark, "landing")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    rows = stage(vendor_rows(spark, root), "vendor")
    kind = F.pmod(F.length(F.col("Date")) + F.ascii(F.reverse(F.regexp_replace("Ticker", r"\.NS$", ""))), F.lit(3))
    parts = [rows.filter(kind == k) for k in range(3)]
    _write_csv(parts[0], files)
    _write_csv(parts[1].select("Date", "Ticker", "Volume", "Adj Close", "Close", "Low", "High", "Open"), files)
    _write_csv(parts[2].select("Low", F.lit("x").alias("Note"), "High", "Open", "Date", F.lit("1").alias("Close 2"), "Volume", "Close", "Ticker"), files)
    daily.ingest(spark, db, landing.read_landing(spark, files, "csv"))
    return plain(tables.scan(spark, db, "bars"))


def rejects_of_two_days(spark, root):
    """Rejects after two days of JSON lines, some of them broken off; the second day is sent twice."""
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    rows = stage(vendor_rows(spark, root), "vendor")
    number = F.ascii(F.reverse(F.regexp_replace("Ticker", r"\.NS$", "")))
    broken = F.concat(F.lit('{"Ticker": "'), F.col("Ticker"), F.lit('", "Date": "'), F.col("Date"))
    whole = F.to_json(F.struct(*reversed(rows.columns)))
    lines = rows.select("Date", F.when((number % 5 == 0) & F.col("Date").endswith("-17"), broken).otherwise(whole).alias("value"))
    early = F.col("Date") < "1999-01-01"
    for k, day in enumerate((early, ~early, ~early)):
        files = new_path(spark, "landing")
        landed = lines.filter(day).select("value")
        # The last day once more, in other files; their number grows with the rows.
        (landed.hint("rebalance") if k == 2 else landed).write.text(files)
        daily.ingest(spark, db, landing.read_landing(spark, files, "json"))
    found = spark.read.parquet(f"{db}/rejects")
    return plain(found.select("ticker", "date_text", *S.BAR_FIELDS, "line", "reason"))


def stream_then_features(spark, root):
    """Features after bars came in through the stream, twice, and then as a batch; built after each."""
    db, files = new_path(spark, "db"), new_path(spark, "landing")
    stocks = data.stocks(spark, root)
    stocks.write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    back = {column: field for field, column in landing.VENDOR_FIELDS.items()}
    rows = stage(data.bars(spark, root).join(stocks.select("stock_id", "symbol"), "stock_id").select(
        landing.ticker_of("symbol").alias("Ticker"), F.col("date").alias("Date"), *(F.col(c).cast("double").alias(back[c]) for c in back)), "vendor")
    for part in (F.col("Date") < STORED_UNTIL, F.col("Date").between(STORED_UNTIL, dt.date(2000, 3, 9))):
        rows.filter(part).write.mode("append").parquet(files)
        daily.ingest_files(spark, db, files)
        daily.build_features(spark, db)
    daily.ingest(spark, db, rows)
    daily.build_features(spark, db)
    return plain(tables.scan(spark, db, "features"))


def daily_rank_both(spark, root):
    """Both rankings of the newest day as the daily jobs make them: from the state of each key and a stored model."""
    db, path = new_path(spark, "db"), new_path(spark, "model")
    stocks = data.stocks(spark, root)
    stocks.write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    bars = stage(data.bars(spark, root), "bars")
    for part in (bars.filter(F.col("date") < TEST_START), bars):
        store.append_absent(part, f"{db}/bars", S.BARS, S.SERIES_KEY, staged_already=True, arrivals=f"{db}/arrivals")
        daily.build_features(spark, db)
    lem.save(trained(spark, root), path)
    daily.rank(spark, db, path)
    named = plans.with_symbol(tables.scan(spark, db, "recommendations"), stocks)
    return plain(named.select("date", "data_date", "rank", "symbol", "score", "model_type"), 6)


def _checked_db(spark, root):
    """Tables of the stocks with numbers not divisible by nine, and bars of all stocks sent in two batches, the later ones as a stream."""
    db, landed = new_path(spark, "db"), new_path(spark, "landing")
    data.stocks(spark, root).filter("stock_id % 9 > 0").write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    raw = data.raw_bars(spark, root)
    daily.ingest_bars(spark, db, raw.filter(F.col("date") < TEST_START))
    raw.filter(F.col("date") >= TEST_START).write.parquet(landed)
    ingest.ingest_available(spark, landed, f"{db}/bars", f"{db}/ingested", f"{db}/rejects", stocks=tables.scan(spark, db, "stocks"))
    return db


def bars_with_parents(spark, root):
    """The bar table where bars of unknown stocks were sent too."""
    return plain(tables.scan(spark, _checked_db(spark, root), "bars"))


def rejects_of_rules(spark, root):
    """What the rules kept from the bar table, with the reason."""
    return plain(spark.read.parquet(f"{_checked_db(spark, root)}/rejects").select(*S.BARS.names, "reason"))


def daily_features_table(spark, root):
    """Features built in three daily runs: old bars, then some late ones, then the rest."""
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    bars = stage(data.bars(spark, root), "bars")
    late = (F.col("stock_id") % 7 == 0) & F.col("date").between("1997-01-01", "1997-03-31")
    newest = (F.col("date") >= TEST_START) | (F.col("stock_id") % 11 == 0)
    for part in (bars.filter(~late & ~newest), bars.filter(late | (newest & (F.col("date") < "2000-03-01"))), bars):
        store.append_absent(part, f"{db}/bars", S.BARS, S.SERIES_KEY, staged_already=True, arrivals=f"{db}/arrivals")
        daily.build_features(spark, db)
    return plain(tables.scan(spark, db, "features"))


def daily_rank_table(spark, root):
    """Rankings of two days; on the second some symbols have no newer features."""
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    rows = stage(feature_rows(spark, root), "features")
    stale = rows.filter((F.col("date") < TEST_START) | (F.col("stock_id") % 3 > 0))
    store.merge_rows(stale, f"{db}/features", S.FEATURES, S.SERIES_KEY, distinct_keys=True)
    daily.rank(spark, db, as_of=TEST_START)
    daily.rank(spark, db)
    named = plans.with_symbol(tables.scan(spark, db, "recommendations"), data.stocks(spark, root))
    return plain(named.filter("model_type = 'SHE'").select("date", "data_date", "rank", "symbol", "score"), 6)


def rankings_of_past_dates(spark, root):
    """SHE rankings of three dates in the past after three daily runs, the last of which brings late bars too."""
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    bars = stage(data.bars(spark, root), "bars")
    late = (F.col("stock_id") % 5 == 0) & F.col("date").between("1996-10-01", "1996-12-31")
    for part in (bars.filter(~late & (F.col("date") < "1999-01-01")), bars.filter(~late & (F.col("date") < "2000-03-15")), bars):
        store.append_absent(part, f"{db}/bars", S.BARS, S.SERIES_KEY, staged_already=True, arrivals=f"{db}/arrivals")
        daily.build_features(spark, db)
    for day in PAST_DATES:
        daily.rank(spark, db, as_of=day)
    named = plans.with_symbol(tables.scan(spark, db, "recommendations"), data.stocks(spark, root))
    return plain(named.filter("model_type = 'SHE'").select("date", "data_date", "rank", "symbol", "score"), 6)


def bootstrap_twice(spark, root):
    """Row counts of the tables after two bootstraps over a given dimension."""
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    for _ in range(2):
        tables.bootstrap(spark, db)
    counts = [tables.scan(spark, db, t).agg(F.lit(t).alias("name"), F.count("*").alias("row_count")) for t in tables.TABLES]
    return reduce(DataFrame.unionByName, counts)


def empty_metrics(spark, root):
    """Measures of returns that hold no rows: none, without failing."""
    nothing = base_returns(spark, root).filter("date < DATE'1900-01-01'")
    return metrics.performance(nothing).groupBy().agg(F.count("*").alias("row_count"))


def stream_vendor_files(spark, root):
    """Vendor text files through the stream, in two runs; the second sends all again at other prices."""
    table, checkpoint, landed, bad = (new_path(spark, n) for n in ("bars", "ingest", "landing", "rejects"))
    rows, stocks = vendor_rows(spark, root), stage(data.stocks(spark, root), "stocks")
    for part in (rows.filter(F.col("Date") < "2000-01-01"), rows.withColumn("Close", F.col("Close").try_cast("double") + 1)):
        part.write.mode("append").option("header", "true").csv(landed)
        ingest.ingest_vendor_files(spark, landed, table, checkpoint, stocks, "csv", bad)
    return plain(store.open_table(spark, table, S.BARS).select(*S.BARS.names))


def stock_scan(spark, root):
    """The dimension, as the jobs read it."""
    return data.stocks(spark, root)


def seed_stocks(spark, root):
    return tables.add_seed(data.stocks(spark, root), tables.seed_stocks(spark))


def stream_ingest(spark, root):
    """Two runs over a growing landing folder, against stored bars."""
    table, checkpoint, landed = (new_path(spark, n) for n in ("bars", "ingest", "landing"))
    stored, _ = stored_and_batch(spark, root)
    store.append_absent(stored, table, S.BARS, S.SERIES_KEY)
    raw = data.raw_bars(spark, root)
    sent = raw.withColumn("close_price", (F.col("close_price") + 1).cast(S.PRICE))
    sent.filter(F.col("date") < TEST_START).write.mode("append").parquet(landed)
    ingest.ingest_available(spark, landed, table, checkpoint)
    late = raw.withColumn("close_price", (F.col("close_price") + 2).cast(S.PRICE))
    late.write.mode("append").parquet(landed)
    ingest.ingest_available(spark, landed, table, checkpoint)
    return plain(store.open_table(spark, table, S.BARS).select(*S.BARS.names))


# ---- series operators

def _closes(spark, root):
    return data.bars(spark, root).select("stock_id", "date", "close_price")


def bar_series(spark, root):
    """Every key's series with row positions."""
    at = F.row_number().over(series.series_window())
    return plain(_closes(spark, root).withColumn("position", at))


def min_history(spark, root):
    return plain(series.min_history(_closes(spark, root), 540))


def first_difference(spark, root):
    return plain(series.first_difference(_closes(spark, root), "close_price"))


def sma(spark, root):
    return plain(series.sma(_closes(spark, root), "close_price", {"sma_50": 50, "sma_200": 200}))


def sma_with_gaps(spark, root):
    """Means over bars with missing closes: null while a gap is in the window."""
    raw = data.raw_bars(spark, root).select("stock_id", "date", "close_price")
    return plain(series.sma(raw, "close_price", {"sma_5": 5, "sma_50": 50}))


def rsi(spark, root):
    return plain(series.rsi(_closes(spark, root), "close_price", out="rsi_14"), 6)


def ema(spark, root):
    return plain(series.ema(_closes(spark, root), "close_price", {"ema_12": 12, "ema_26": 26}), 4)


def macd(spark, root):
    return plain(series.macd(_closes(spark, root), "close_price"), 4)


def ema_far_spans(spark, root):
    return plain(series.ema(series.dealt(_closes(spark, root)), "close_price", {"ema_5": 5, "ema_200": 200}), 4)


def macd_far_spans(spark, root):
    return plain(series.macd(series.dealt(_closes(spark, root)), "close_price", 12, 200, 9), 4)


def forward_return(spark, root):
    return plain(series.forward_return(_closes(spark, root), "close_price", {"ret_1": 1, "ret_10": 10}), 9)


def features(spark, root):
    return plain(feature_rows(spark, root))


def features_since(spark, root):
    """Features of the test period from a stored table, reading no more history
    than they need."""
    path = new_path(spark, "bars")
    store.append_absent(data.bars(spark, root), path, S.BARS, S.SERIES_KEY)
    return plain(plans.features(store.open_table(spark, path, S.BARS), since=TEST_START))


def features_in_pieces(spark, root):
    """The same features with every key cut into pieces of bounded length."""
    return plain(plans.features(_closes(spark, root), slice_of=F.year("date"), piece_rows=600))


def panel_in_pieces(spark, root):
    cut = {"slice_of": F.year("date"), "piece_rows": 600}
    rows = plans.features(data.bars(spark, root), keep=["close_price"], **cut)
    return plain(plans.with_symbol(plans.panel(rows, **{**cut, "piece_rows": 100}), data.stocks(spark, root)), 9)


def crosses(spark, root):
    flagged = series.crosses(feature_rows(spark, root), "sma_50", "sma_200", up="golden", down="death")
    return flagged.filter("golden or death").select("stock_id", "date", "golden", "death")


def trend_signal(spark, root):
    return scores.trend_signal(feature_rows(spark, root)).select("stock_id", "date", "trend_signal")


def momentum_score(spark, root):
    return scores.momentum_score(feature_rows(spark, root)).select("stock_id", "date", "momentum_score")


def macd_score(spark, root):
    return scores.macd_score(feature_rows(spark, root)).select("stock_id", "date", "macd_score")


def she_score(spark, root):
    rows = scores.she_score(scores.with_signals(feature_rows(spark, root)))
    return plain(rows.select("stock_id", "date", "she_score"), 6)


# ---- scans, panel, ranking

def feature_scan(spark, root):
    return plain(plans.with_symbol(feature_rows(spark, root), data.stocks(spark, root)))


def training_scan(spark, root):
    bars = data.bars(spark, root)
    joined = plans.training_scan(plans.features(bars), bars)
    return plain(plans.with_symbol(joined, data.stocks(spark, root)))


def panel_rows(spark, root):
    return plain(panel(spark, root), 9)


def panel_from_tables(spark, root):
    """The panel by way of the joined scan of stored features and prices."""
    bars = data.bars(spark, root)
    rows = stage(plans.features(bars), "features")
    return plain(plans.with_symbol(plans.panel(plans.training_scan(rows, bars)), data.stocks(spark, root)), 9)


def label_profile(spark, root):
    return plans.profile(panel(spark, root), "target")


def symbol_profile(spark, root):
    return plans.profile(panel(spark, root), "symbol")


def split_profile(spark, root):
    side = F.when(F.col("date") <= TRAIN_END, "train").when(F.col("date") >= TEST_START, "test")
    return plans.profile(panel(spark, root).withColumn("split", side).filter(F.col("split").isNotNull()), "split")


def latest_per_key(spark, root):
    return plain(series.latest_per_key(feature_rows(spark, root)))


def top5_she(spark, root):
    ranked = ranking.recommend(latest_scored(spark, root), {"SHE": "she_score"})
    return plain(ranked.select("date", "rank", "stock_id", "score", "model_type", "data_date", "algorithm_scores.*"), 6)


def recommendations(spark, root):
    rows = dual_recommendations(spark, root)
    return plain(rows.select("date", "rank", "stock_id", "score", "model_type", "data_date", "algorithm_scores.*"), 6)


def latest_recommendations(spark, root):
    """The newest ranking in full, each symbol with its own last date beside it."""
    rows = ranking.latest_recommendations(dual_recommendations(spark, root), data.stocks(spark, root))
    return plain(rows.select("date", "rank", "symbol", "company_name", "score", "model_type", "data_date", "algorithm_scores.*")
                 .orderBy("model_type", "rank"), 6)


def recommendation_response(spark, root):
    """The nested answer, shown flat: one row per array entry."""
    latest = ranking.latest_recommendations(one_date_recommendations(spark, root), data.stocks(spark, root))
    answer = ranking.recommendation_response(latest)
    flat = answer.select("date", F.posexplode(F.arrays_zip("she_recommendations", "lem_recommendations")))
    return plain(flat.select(
        "date", (F.col("pos") + 1).alias("position"),
        F.col("col.she_recommendations.symbol").alias("she_symbol"),
        F.col("col.she_recommendations.score").alias("she_score"),
        F.col("col.lem_recommendations.symbol").alias("lem_symbol"),
        F.col("col.lem_recommendations.score").alias("lem_score")), 6)


def score_lookup(spark, root):
    """Component scores of the symbol that ranks first on the newest date."""
    recs = one_date_recommendations(spark, root)
    stocks = data.stocks(spark, root)
    first = plans.with_symbol(recs, stocks).orderBy("model_type", "rank").first()
    if first is None:
        return ranking.score_lookup(recs, stocks, "", None).select("date", "symbol", "algorithm_scores.*")
    found = ranking.score_lookup(recs, stocks, first["symbol"].lower(), first["date"])
    return found.select("date", "symbol", "algorithm_scores.*")


def score_json(spark, root):
    """Component scores as JSON text and read back from it."""
    rows = latest_scored(spark, root).select("stock_id", text.scores_json(scores.algorithm_scores()).alias("json"))
    return rows.select("stock_id", "json", text.scores_from_json("json").alias("s")).select("stock_id", "json", "s.*")


# ---- returns and reports

def topn_returns(spark, root):
    scored = backtest.scored_panel(panel(spark, root), TEST_START)
    return plain(returns.topn_returns(scored, {"she": "she_score"}), 9)


def benchmark_returns(spark, root):
    return plain(returns.benchmark_returns(backtest.scored_panel(panel(spark, root), TEST_START)), 9)


def base_strategy_returns(spark, root):
    return plain(base_returns(spark, root), 9)


def returns_wide(spark, root):
    return plain(curves.wide(base_returns(spark, root), SERIES), 9)


def performance(spark, root):
    return plain(metrics.performance(base_returns(spark, root)), 6)


def strategy_summary(spark, root):
    return metrics.summary(metrics.performance(base_returns(spark, root), neutral_benchmark=True))


def equity_curve(spark, root):
    return plain(curves.equity_curve(base_returns(spark, root), SERIES), 6)


def drawdown_curve(spark, root):
    return plain(curves.drawdown_curve(base_returns(spark, root), SERIES), 6)


def chart_json(spark, root):
    fields = {"she_returns": "she", "momentum_returns": "momentum", "benchmark_returns": returns.BENCHMARK}
    return plain(curves.read_chart(curves.chart_json(base_returns(spark, root), fields), list(fields)), 12)


def welch_t(spark, root):
    return plain(metrics.welch(base_returns(spark, root), "she", "macd"), 6)


# ---- questions

def chat_context(spark, root):
    latest = ranking.latest_recommendations(one_date_recommendations(spark, root), data.stocks(spark, root))
    return context.contexts(data.messages(spark, root), latest).select("conv_id", "turn", "context")


def mention_any(spark, root):
    latest = ranking.latest_recommendations(one_date_recommendations(spark, root), data.stocks(spark, root))
    return context.mentioned(data.messages(spark, root), latest)


def first_mention(spark, root):
    return data.messages(spark, root).select("conv_id", "turn", text.first_mention("message").alias("word"))


# ---- the learned score

def time_folds(spark, root):
    """Row counts and date ranges of the time-ordered folds of the training rows."""
    return plans.profile(lem.time_folds(_split(spark, root)[0]), "fold")


def _split(spark, root, rows=None):
    return plans.temporal_split(panel(spark, root) if rows is None else rows, TRAIN_END, TEST_START)


def training_counts(spark, root):
    return lem.training_counts(_split(spark, root)[0])


def fold_counts(spark, root):
    """Training counts per time-ordered fold."""
    return lem.fold_counts(_split(spark, root)[0])


_models: dict[tuple[str, str], str] = {}
_model_lock = threading.Lock()


def trained(spark: SparkSession, root: str, training: DataFrame | None = None):
    """A model of the training period, saved once per session and loaded after that; ``training`` are its rows, if at hand."""
    key = (spark.sparkContext.applicationId, root)
    with _model_lock:
        if key not in _models:
            path = new_path(spark, "model")
            lem.save(lem.train_trees(_split(spark, root)[0] if training is None else training, **SMALLEST), path)
            _models[key] = path
    return lem.load(_models[key])


def lem_scores(spark, root):
    training, test = _split(spark, root, panel_once(spark, root))
    rows = lem.score_by_table(test, trained(spark, root, training))
    return plain(rows.select("symbol", "date", "lem_score"), 6)


def lem_score_checks(spark, root):
    """Per symbol: rows scored, rows without a score or outside 0..100, and rows
    where the looked-up score is not that of the trees."""
    training, test = _split(spark, root, panel_once(spark, root))
    model = trained(spark, root, training)
    both = lem.score(lem.score_by_table(test, model), model, "by_trees")
    return both.groupBy("symbol").agg(
        F.count("lem_score").alias("scored"),
        F.count_if(F.col("lem_score").isNull() | ~F.col("lem_score").between(0, 100)).alias("out_of_range"),
        F.count_if(F.abs(F.col("lem_score") - F.col("by_trees")) > 1e-9).alias("differing"))


def lem_scores_from_table(spark, root):
    """The same scores by joins with the stored table of nodes, a level at a time."""
    training, test = _split(spark, root, panel_once(spark, root))
    model = trained(spark, root, training)
    combinations = stage(test.select(*S.SIGNALS).distinct().withColumn("id", F.xxhash64(*S.SIGNALS)), "combinations")
    found = boosting.follow(combinations, stage(model.table(spark), "nodes"), ["id"])
    rows = test.select("symbol", "date", F.xxhash64(*S.SIGNALS).alias("id")).join(found, "id")
    return plain(rows.select("symbol", "date", "lem_score"), 6)


def lem_top5(spark, root):
    scored = lem.score(latest_scored(spark, root), trained(spark, root))
    ranked = ranking.recommend(scored, {"SHE": "she_score", "LEM": "lem_score"})
    return plain(ranked.select("date", "data_date", "rank", "stock_id", "score", "model_type"), 6)


def _simulated(spark, root, fitted):
    """Returns of all strategies with the model that ``fitted`` makes of the training rows."""
    rows = panel_once(spark, root)
    return backtest.simulate(rows, backtest.ALL_STRATEGIES, start=TEST_START, model=fitted(spark, root, _split(spark, root, rows)[0]))


def _lem_returns(spark, root):
    return stage_once(spark, (root, "lem-returns"), lambda: _simulated(spark, root, trained))


def lem_metrics(spark, root):
    return plain(metrics.labelled(metrics.performance(_lem_returns(spark, root), neutral_benchmark=True)), 6)


def lem_summary(spark, root):
    return metrics.summary(metrics.performance(_lem_returns(spark, root), neutral_benchmark=True))


def lem_significance(spark, root):
    return plain(metrics.welch(_lem_returns(spark, root), "lem", "she"), 6)


def lem_equity_curve(spark, root):
    return plain(curves.equity_curve(_lem_returns(spark, root), ["lem", "she", returns.BENCHMARK]), 6)


def _search(training):
    return lem.grid_search(training, {"maxIter": [10, 20], "stepSize": [0.1], "maxDepth": [3],
                                      "subsamplingRate": [0.8, 1.0]})


_searches: dict[tuple[str, str], tuple] = {}


def _whole_search(spark, root, training=None):
    """The search over the whole grid, once per session; ``training`` are its rows, if at hand."""
    key = (spark.sparkContext.applicationId, root)
    with _model_lock:
        if key not in _searches:
            _searches[key] = lem.search(_split(spark, root)[0] if training is None else training)
    return _searches[key]


def lem_cv(spark, root):
    """The whole grid: 81 settings, each with its mean F1 over five folds."""
    return _whole_search(spark, root)[0]


def lem_refit(spark, root):
    """Checks of the search over the whole grid and of the model fitted with its best setting."""
    training, test = _split(spark, root, panel_once(spark, root))
    table, best = _whole_search(spark, root, training)
    model = lem.train_trees(training, **best)
    settings = table.collect()
    top = max(r.mean_f1 for r in settings)
    chosen = [r.mean_f1 for r in settings if all(r[k] == v for k, v in best.items())]
    held = lem.score_by_table(test, model).groupBy().agg(
        F.count("lem_score").alias("scored"), F.count_if(~F.col("lem_score").between(0, 100)).alias("bad_scores"))
    return held.select(F.lit(len(settings)).cast("long").alias("settings"),
                       F.lit(sum(not 0 <= r.mean_f1 <= 1 for r in settings)).cast("long").alias("bad_f1"),
                       "scored", "bad_scores", F.lit(chosen == [top] and model.size == best["maxIter"]).alias("best_refitted"))


def lem_tuned(spark, root):
    """Checks of a search and the model refitted with its best setting."""
    training, test = _split(spark, root, panel_once(spark, root))
    table, best = _search(training)
    model = lem.train(training, **best)
    settings = table.collect()
    top = max(r.mean_f1 for r in settings)
    chosen = [r.mean_f1 for r in settings if all(r[k] == v for k, v in best.items())]
    refitted = chosen == [top] and model.stages[-1].getNumTrees == best["maxIter"]
    held = lem.score_by_table(test, model).groupBy().agg(
        F.count("lem_score").alias("scored"), F.count_if(~F.col("lem_score").between(0, 100)).alias("bad_scores"))
    return held.select(F.lit(len(settings)).cast("long").alias("settings"),
                       F.lit(sum(not 0 <= r.mean_f1 <= 1 for r in settings)).cast("long").alias("bad_f1"),
                       "scored", "bad_scores", F.lit(refitted).alias("best_refitted"))


# A learned score that SQL can follow in full: one tree of one split on trend and MACD.

def stump(spark, root, training=None):
    return lem.train(_split(spark, root)[0] if training is None else training, features=["trend_signal", "macd_score"], maxIter=1, maxDepth=1)


def _stump_returns(spark, root):
    return stage_once(spark, (root, "stump-returns"), lambda: _simulated(spark, root, stump))


def lem_stump_scores(spark, root):
    training, test = _split(spark, root, panel_once(spark, root))
    rows = lem.score_by_table(test, stump(spark, root, training))
    return plain(rows.select("symbol", "date", "lem_score"), 9)


def lem_stump_importance(spark, root):
    return plain(lem.importance(spark, stump(spark, root)), 9)


def lem_stump_top5(spark, root):
    scored = lem.score(latest_scored(spark, root), stump(spark, root))
    ranked = ranking.recommend(scored, {"SHE": "she_score", "LEM": "lem_score"})
    return plain(ranked.select("date", "data_date", "rank", "stock_id", "score", "model_type"), 6)


def lem_stump_returns(spark, root):
    return plain(_stump_returns(spark, root), 9)


def lem_stump_metrics(spark, root):
    return plain(metrics.performance(_stump_returns(spark, root)), 6)


def lem_stump_summary(spark, root):
    return metrics.summary(metrics.performance(_stump_returns(spark, root), neutral_benchmark=True))


def lem_stump_significance(spark, root):
    return plain(metrics.welch(_stump_returns(spark, root), "lem", "she"), 6)


def lem_stump_equity_curve(spark, root):
    return plain(curves.equity_curve(_stump_returns(spark, root), ["lem", *SERIES]), 6)


def feature_importance(spark, root):
    return plain(lem.importance(spark, trained(spark, root), lem.REPORT_NAMES), 9)


def importance_checks(spark, root):
    """The importances of the trees are three shares of one, highest first."""
    rows = feature_importance(spark, root)
    return rows.groupBy().agg(F.count("*").alias("features"), F.round(F.sum("importance"), 9).alias("total"),
                              F.count_if(F.col("importance") < 0).alias("negative"))


QUERIES = {
    "clean_bars": clean_bars,
    "rejects": rejects,
    "bars_insert_if_absent": bars_insert_if_absent,
    "features_upsert": features_upsert,
    "merged_feature_table": merged_feature_table,
    "replace_dates": replace_dates,
    "dq_report": dq_report,
    "orphan_bars": orphan_bars,
    "wide_to_long_bars": wide_to_long_bars,
    "ticker_key": ticker_key,
    "landed_bars": landed_bars,
    "daily_ingest_table": daily_ingest_table,
    "daily_ingest_rejects": daily_ingest_rejects,
    "daily_features_table": daily_features_table,
    "bars_with_parents": bars_with_parents,
    "rejects_of_rules": rejects_of_rules,
    "daily_rank_table": daily_rank_table,
    "rankings_of_past_dates": rankings_of_past_dates,
    "vendor_csv_any_order": vendor_csv_any_order,
    "rejects_of_two_days": rejects_of_two_days,
    "stream_then_features": stream_then_features,
    "daily_rank_both": daily_rank_both,
    "stream_vendor_files": stream_vendor_files,
    "bootstrap_twice": bootstrap_twice,
    "empty_metrics": empty_metrics,
    "stock_scan": stock_scan,
    "seed_stocks": seed_stocks,
    "stream_ingest": stream_ingest,
    "bar_series": bar_series,
    "min_history": min_history,
    "first_difference": first_difference,
    "sma": sma,
    "sma_with_gaps": sma_with_gaps,
    "rsi": rsi,
    "ema": ema,
    "macd": macd,
    "ema_far_spans": ema_far_spans,
    "macd_far_spans": macd_far_spans,
    "forward_return": forward_return,
    "features": features,
    "features_in_pieces": features_in_pieces,
    "features_since": features_since,
    "crosses": crosses,
    "trend_signal": trend_signal,
    "momentum_score": momentum_score,
    "macd_score": macd_score,
    "she_score": she_score,
    "feature_scan": feature_scan,
    "training_scan": training_scan,
    "panel": panel_rows,
    "panel_from_tables": panel_from_tables,
    "panel_in_pieces": panel_in_pieces,
    "label_profile": label_profile,
    "symbol_profile": symbol_profile,
    "split_profile": split_profile,
    "latest_per_key": latest_per_key,
    "top5_she": top5_she,
    "recommendations": recommendations,
    "latest_recommendations": latest_recommendations,
    "recommendation_response": recommendation_response,
    "score_lookup": score_lookup,
    "score_json": score_json,
    "topn_returns": topn_returns,
    "benchmark_returns": benchmark_returns,
    "base_strategy_returns": base_strategy_returns,
    "returns_wide": returns_wide,
    "metrics": performance,
    "strategy_summary": strategy_summary,
    "equity_curve": equity_curve,
    "drawdown_curve": drawdown_curve,
    "chart_json": chart_json,
    "welch_t": welch_t,
    "chat_context": chat_context,
    "mention_any": mention_any,
    "first_mention": first_mention,
    "time_folds": time_folds,
    "training_counts": training_counts,
    "fold_counts": fold_counts,
    "lem_scores": lem_scores,
    "lem_scores_from_table": lem_scores_from_table,
    "lem_score_checks": lem_score_checks,
    "lem_top5": lem_top5,
    "lem_metrics": lem_metrics,
    "lem_summary": lem_summary,
    "lem_significance": lem_significance,
    "lem_equity_curve": lem_equity_curve,
    "lem_cv": lem_cv,
    "lem_refit": lem_refit,
    "lem_tuned": lem_tuned,
    "importance_checks": importance_checks,
    "lem_stump_scores": lem_stump_scores,
    "lem_stump_importance": lem_stump_importance,
    "lem_stump_top5": lem_stump_top5,
    "lem_stump_returns": lem_stump_returns,
    "lem_stump_metrics": lem_stump_metrics,
    "lem_stump_summary": lem_stump_summary,
    "lem_stump_significance": lem_stump_significance,
    "lem_stump_equity_curve": lem_stump_equity_curve,
    "feature_importance": feature_importance,
}
