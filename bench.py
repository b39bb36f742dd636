"""Times the daily jobs and headline queries over stored bars; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Deriving bars from the raw sales rows is timed apart as ``prepare_bars``.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickframe import registry as R  # noqa: E402
from tickframe import schemas as S  # noqa: E402
from tickframe.operators import curves, metrics, quality, ranking, series, store  # noqa: E402
from tickframe.operators import model as lem  # noqa: E402
from tickframe.plans import backtest, context, daily  # noqa: E402
from tickframe.plans import features as plans  # noqa: E402
from tickframe.session import new_path, session, stage  # noqa: E402
from tickframe.sources import landing, tables  # noqa: E402
from tickframe.sources import testdata as data  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", **{"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
                                "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s}{times[name]:8.3f}", file=sys.stderr, flush=True)
        return result

    # Stored inputs
    db = new_path(spark, "db")
    data.stocks(spark, root).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    stocks = tables.scan(spark, db, "stocks")
    raw = timed("prepare_bars", lambda: stage(data.raw_bars(spark, root), "raw"))
    bars = stage(quality.clean_bars(raw), "bars")
    cells = (F.col(c).cast("double").alias(f) for f, c in landing.VENDOR_FIELDS.items())
    landed = stage(raw.join(stocks, "stock_id")
                   .select(landing.ticker_of("symbol").alias("Ticker"), F.col("date").alias("Date"), *cells), "landed")
    closes = bars.select("stock_id", "date", "close_price")
    rows = bars.count()

    # The daily jobs, each from stored table to stored table
    timed("daily_ingest", lambda: daily.ingest(spark, db, landed))
    timed("daily_ingest_again", lambda: daily.ingest(spark, db, landed))
    timed("daily_features", lambda: daily.build_features(spark, db))
    timed("daily_rank", lambda: daily.rank(spark, db))
    # A day's work after the first: the bars of the last weeks arrive in a second database.
    later, since = new_path(spark, "db"), dt.date(2001, 10, 1)
    stocks.write.parquet(f"{later}/stocks")
    tables.bootstrap(spark, later)
    daily.ingest(spark, later, landed.filter(F.col("Date") < since))
    daily.build_features(spark, later)
    timed("daily_ingest_since", lambda: daily.ingest(spark, later, landed))
    timed("daily_features_since", lambda: daily.build_features(spark, later))
    timed("daily_rank_since", lambda: daily.rank(spark, later))
    stored = tables.scan(spark, db, "features")
    timed("feature_scan", lambda: consume(plans.with_symbol(stored, stocks)))

    # Operators over stored bars
    timed("clean_bars", lambda: consume(quality.clean_bars(raw)))
    timed("dq_report", lambda: consume(quality.report(raw, stocks)))
    batch = bars.withColumn("close_price", (F.col("close_price") + 1).cast(S.PRICE))
    timed("insert_if_absent", lambda: consume(store.insert_if_absent(
        bars.filter(F.col("date") < R.STORED_UNTIL), batch, S.SERIES_KEY)))
    timed("sma", lambda: consume(series.sma(closes, "close_price", {"sma_50": 50, "sma_200": 200})))
    timed("rsi", lambda: consume(series.rsi(closes, "close_price")))
    timed("macd", lambda: consume(series.macd(closes, "close_price")))
    timed("features", lambda: consume(plans.features(bars)))
    timed("panel", lambda: consume(plans.panel_from_bars(bars, stocks)))
    timed("recommendations", lambda: consume(ranking.recommend(ranking.latest_scores(stored, stocks), R.STAND_IN)))

    # Backtest reports, each from the stored panel
    panel = stage(plans.panel_from_bars(bars, stocks), "panel")

    strategy_returns = timed("strategy_returns", lambda: backtest.simulate(panel, start=R.TEST_START))

    def returns():
        return strategy_returns

    timed("metrics", lambda: consume(metrics.performance(returns())))
    timed("equity_curve", lambda: consume(curves.equity_curve(returns(), R.SERIES)))
    timed("drawdown_curve", lambda: consume(curves.drawdown_curve(returns(), R.SERIES)))
    timed("chart_json", lambda: consume(curves.chart_json(returns(), {s: s for s in R.SERIES})))
    timed("welch_t", lambda: consume(metrics.welch(returns(), "she", "macd")))

    # The learned score
    trained = timed("lem_train", lambda: lem.train_trees(panel.filter(F.col("date") <= R.TRAIN_END),
                                                   **R.SMALLEST))
    timed("lem_scores", lambda: consume(lem.score_by_table(panel, trained)))
    timed("lem_metrics", lambda: consume(metrics.performance(backtest.simulate(
        panel, backtest.ALL_STRATEGIES, start=R.TEST_START, model=trained))))

    # Questions
    latest = daily.latest(spark, db)
    timed("latest_recommendations", lambda: consume(latest))
    timed("chat_context", lambda: consume(context.contexts(data.messages(spark, root), latest)))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": root.rstrip("/").rsplit("sf", 1)[-1], "bars": rows,
        "bars_per_second": {k: round(rows / times[k]) for k in ("daily_ingest", "daily_features", "daily_rank",
                                                                "features", "panel")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
