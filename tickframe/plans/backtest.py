"""Out-of-sample backtest and its reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.functions import scores
from tickframe.operators import model as lem
from tickframe.operators import returns
from tickframe.session import stage, staged

BASE_STRATEGIES = {
    "she": "she_score",
    "trend": "trend_signal",
    "momentum": "momentum_score",
    "macd": "macd_score",
}
ALL_STRATEGIES = {"lem": "lem_score", **BASE_STRATEGIES}


def scored_panel(panel: DataFrame, start: dt.date = S.TEST_START,
                 model: PipelineModel | None = None, with_lem: bool = False) -> DataFrame:
    """Out-of-sample rows with their scores."""
    out = scores.she_score(panel.filter(F.col("date") >= F.lit(start)))
    return lem.score_by_table(out, model) if with_lem else out


def simulate(panel: DataFrame, strategies: Mapping[str, str] = BASE_STRATEGIES, *, start: dt.date = S.TEST_START,
             n: int = S.PORTFOLIO_SIZE, model: PipelineModel | None = None) -> DataFrame:
    """Daily returns of the strategies and the benchmark.

    The scored rows are written aside while ranking and benchmark read them; the
    returns, a row per day and strategy, stay for all reports.
    """
    scored = scored_panel(panel, start, model, with_lem="lem_score" in strategies.values())
    columns = list(dict.fromkeys(["date", "symbol", "daily_return", *strategies.values()]))
    with staged(scored.select(*columns), "scored") as rows:
        return stage(returns.strategy_returns(rows, strategies, n), "returns")
