"""Daily return series of portfolios: ``(strategy, date, ret)``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import ranking

BENCHMARK = "benchmark"


def topn_returns(scored: DataFrame, strategies: Mapping[str, str], n: int = S.PORTFOLIO_SIZE) -> DataFrame:
    """Mean next-day return of each day's ``n`` highest scores, for several
    scores at once; 0 on days with fewer than ``n`` names.

    A day with fewer names also has fewer ranked rows, so the ranked rows alone
    decide and the whole day is never counted.
    """
    long = ranking.by_score(scored, strategies, ["date", "symbol", "daily_return"], "strategy")
    picked = ranking.top_n(long, n, ["strategy", "date"], "score")
    return picked.groupBy("strategy", "date").agg(
        F.when(F.count("*") < n, 0.0)
        .otherwise(F.coalesce(F.avg("daily_return"), F.lit(0.0))).alias("ret"))


def benchmark_returns(scored: DataFrame, name: str = BENCHMARK) -> DataFrame:
    """Equal-weight mean return per date."""
    return scored.groupBy("date").agg(F.coalesce(F.avg("daily_return"), F.lit(0.0)).alias("ret")) \
        .select(F.lit(name).alias("strategy"), "date", "ret")


def strategy_returns(scored: DataFrame, strategies: Mapping[str, str], n: int = S.PORTFOLIO_SIZE) -> DataFrame:
    """All strategies and the benchmark. Reads ``scored`` twice, so pass a stored table."""
    return topn_returns(scored, strategies, n).unionByName(benchmark_returns(scored))
