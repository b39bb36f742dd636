"""Table schemas, keys and default parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
RSI = T.DecimalType(5, 2)

STOCKS = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
])

BARS = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open_price", PRICE),
    T.StructField("high_price", PRICE),
    T.StructField("low_price", PRICE),
    T.StructField("close_price", PRICE),
    T.StructField("adjusted_close_price", PRICE),
    T.StructField("volume", T.LongType()),
])

FEATURES = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("sma_50", PRICE),
    T.StructField("sma_200", PRICE),
    T.StructField("rsi_14", RSI),
    T.StructField("macd_value", PRICE),
    T.StructField("macd_signal", PRICE),
])

ALGORITHM_SCORES = T.StructType([
    T.StructField("trend_signal", T.DoubleType()),
    T.StructField("momentum_score", T.DoubleType()),
    T.StructField("macd_score", T.DoubleType()),
])

RECOMMENDATIONS = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("score", T.DoubleType()),
    T.StructField("model_type", T.StringType(), False),
    T.StructField("algorithm_scores", ALGORITHM_SCORES),
    # The date of the symbol's own last features; ``date`` is that of the ranking.
    T.StructField("data_date", T.DateType()),
])

STOCK_KEY = ["stock_id"]
SERIES_KEY = ["stock_id", "date"]
RECOMMENDATION_KEY = ["date", "model_type", "rank"]
BAR_FIELDS = ["open_price", "high_price", "low_price", "close_price", "volume"]
SIGNALS = ["trend_signal", "momentum_score", "macd_score"]

# Parameters of the indicators, scores and backtest.
FAST_SMA, SLOW_SMA = 50, 200
RSI_LENGTH = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
MIN_HISTORY = 200
SHE_WEIGHTS = {"trend": 0.40, "momentum": 0.30, "macd": 0.30}
LABEL_HORIZON, LABEL_THRESHOLD = 10, 0.02
PORTFOLIO_SIZE = 5
TRADING_DAYS = 252
SIGNIFICANCE = 0.05
MARKET_SUFFIX = ".NS"
TRAIN_END = dt.date(2022, 12, 31)
TEST_START = dt.date(2023, 1, 1)
