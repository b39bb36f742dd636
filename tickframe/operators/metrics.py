"""Performance measures of return series ``(strategy, date, ret)``.

Series have one row per strategy and calendar day, so the windows here hold
days, not table rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.returns import BENCHMARK
from tickframe.schemas import SIGNIFICANCE, TRADING_DAYS

# The names of the reported measures, in report order.
MEASURES = {
    "cagr_pct": "CAGR (%)",
    "annualized_volatility_pct": "Annualized Volatility (%)",
    "sharpe_ratio": "Sharpe Ratio",
    "sortino_ratio": "Sortino Ratio",
    "calmar_ratio": "Calmar Ratio",
    "max_drawdown_pct": "Max Drawdown (%)",
    "alpha_pct": "Alpha (vs. Benchmark)",
    "beta": "Beta (vs. Benchmark)",
    "win_rate_pct": "Win Rate (%)",
}

# The names of the strategies in reports and charts.
REPORT_NAMES = {
    "lem": "Learned Ensemble (LEM)",
    "she": "Simple Heuristic (SHE)",
    "trend": "Trend-Following Only",
    "momentum": "Momentum (RSI) Only",
    "macd": "MACD Crossover Only",
    "benchmark": "Benchmark (Equal-Weight)",
}


def _days(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_equity(returns: DataFrame, by: Sequence[str] = ("strategy",)) -> DataFrame:
    """Growth of 1 and the fall from its highest value so far (0 on day one)."""
    out = returns.withColumn("equity", F.product(1.0 + F.col("ret")).over(_days(by)))
    return out.withColumn("_peak", F.max("equity").over(_days(by))) \
        .withColumn("drawdown", F.try_divide(F.col("equity") - F.col("_peak"), F.col("_peak"))).drop("_peak")


def compounded(ret: str | Column) -> Column:
    ret = F.col(ret) if isinstance(ret, str) else ret
    return F.product(1.0 + ret) - 1.0


def annual_growth(total: Column, days: Column) -> Column:
    return F.pow(1.0 + total, F.lit(float(TRADING_DAYS)) / days) - 1.0


def ratio(top: Column, bottom: Column) -> Column:
    """0 where the bottom is 0, null where it is undefined."""
    return F.when(bottom == 0, 0.0).otherwise(F.try_divide(top, bottom))


def performance(returns: DataFrame, benchmark: str = BENCHMARK, *, neutral_benchmark: bool = False) -> DataFrame:
    """One row of measures per strategy, against the benchmark's series.

    The benchmark's return of the day is spread over the day's few rows by a
    window, so the input is read once. ``neutral_benchmark`` reports the
    benchmark itself with alpha 0 and beta 1.
    """
    is_bench = F.col("strategy") == benchmark
    same_day = Window.partitionBy("date")
    paired = returns.withColumn("_bench", F.max(F.when(is_bench, F.col("ret"))).over(same_day))
    year = F.lit(math.sqrt(TRADING_DAYS))
    base = with_equity(paired).groupBy("strategy").agg(
        F.count("ret").alias("n"),
        compounded("ret").alias("total"),
        (F.stddev_samp("ret") * year).alias("vol"),
        F.min("drawdown").alias("dd"),
        (F.stddev_samp(F.when(F.col("ret") < 0, F.col("ret"))) * year).alias("down"),
        F.covar_samp(F.when(F.col("_bench").isNotNull(), F.col("ret")), "_bench").alias("cov"),
        F.var_samp("ret").alias("var"),
        F.avg((F.col("ret") > 0).cast("double")).alias("wins"))
    base = base.withColumn("cagr", annual_growth(F.col("total"), F.col("n")))
    # One row per strategy from here on.
    all_rows = Window.partitionBy(F.lit(0))
    base = base.withColumns({
        "_bvar": F.max(F.when(is_bench, F.col("var"))).over(all_rows),
        "_bcagr": F.max(F.when(is_bench, F.col("cagr"))).over(all_rows),
    })
    beta = ratio(F.col("cov"), F.col("_bvar"))
    alpha = F.col("cagr") - beta * F.col("_bcagr")
    if neutral_benchmark:
        beta, alpha = F.when(is_bench, 1.0).otherwise(beta), F.when(is_bench, 0.0).otherwise(alpha)
    return base.select(
        "strategy",
        (F.col("cagr") * 100).alias("cagr_pct"), (F.col("vol") * 100).alias("annualized_volatility_pct"),
        ratio(F.col("cagr"), F.col("vol")).alias("sharpe_ratio"),
        ratio(F.col("cagr"), F.col("down")).alias("sortino_ratio"),
        ratio(F.col("cagr"), F.abs("dd")).alias("calmar_ratio"),
        (F.col("dd") * 100).alias("max_drawdown_pct"),
        (alpha * 100).alias("alpha_pct"), beta.alias("beta"), (F.col("wins") * 100).alias("win_rate_pct"))


def summary(measures: DataFrame) -> DataFrame:
    """The short comparison table, at two decimals."""
    return measures.select("strategy", *(F.round(c, 2).alias(c)
                                         for c in ("cagr_pct", "sharpe_ratio", "max_drawdown_pct")))


def labelled(measures: DataFrame, names: Mapping[str, str] = REPORT_NAMES) -> DataFrame:
    """The measures and strategies under their report names."""
    return measures.replace(dict(names), subset=["strategy"]).withColumnsRenamed({**MEASURES, "strategy": "Strategy"})


def _simpson(f, start: Column, length: Column, steps: int) -> Column:
    """Simpson's rule as an array fold; ``steps`` is even."""
    h = length / float(steps)

    def term(k: Column) -> Column:
        weight = F.when((k == 0) | (k == steps), 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
        return weight * f(start + h * k)

    return h / 3.0 * F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda acc, k: acc + term(k))


def t_two_sided_p(t: Column, df: Column, steps: int = 4000) -> Column:
    """P(|T| > |t|) of Student's t, as a plain expression.

    With t = sqrt(df) tan(a) the density is proportional to cos(a)**(df - 1) on
    (-pi/2, pi/2), so the p-value is the ratio of two integrals and needs no
    gamma function. Past 12/sqrt(df) the integrand is under 1e-30 of its start.
    """
    half_pi = F.lit(math.pi / 2)
    start = F.atan(F.abs(t) / F.sqrt(df))
    reach = 12.0 / F.sqrt(df)

    def density(a: Column) -> Column:
        return F.pow(F.greatest(F.cos(a), F.lit(0.0)), df - 1.0)

    tail = _simpson(density, start, F.least(half_pi - start, reach), steps)
    whole = _simpson(density, F.lit(0.0), F.least(half_pi, reach), steps)
    return tail / whole


def welch(returns: DataFrame, a: str, b: str, alpha: float = SIGNIFICANCE) -> DataFrame:
    """Two-sample t-test of unequal variances on the daily returns of ``a`` and ``b``."""
    x, y = (F.when(F.col("strategy") == s, F.col("ret")) for s in (a, b))
    one = returns.filter(F.col("strategy").isin(a, b)).groupBy().agg(
        F.avg(x).alias("ma"), F.avg(y).alias("mb"), F.var_samp(x).alias("va"), F.var_samp(y).alias("vb"),
        F.count(x).alias("na"), F.count(y).alias("nb")).filter((F.col("na") > 1) & (F.col("nb") > 1))
    one = one.withColumns({"ea": F.col("va") / F.col("na"), "eb": F.col("vb") / F.col("nb")})
    spread = F.col("ea") + F.col("eb")
    one = one.withColumns({
        "t_stat": F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(spread)),
        "df": F.try_divide(spread * spread, F.col("ea") * F.col("ea") / (F.col("na") - 1)
                           + F.col("eb") * F.col("eb") / (F.col("nb") - 1)),
    }).withColumn("p_value", t_two_sided_p(F.col("t_stat"), F.col("df")))
    return one.select("t_stat", "df", "p_value", verdict("p_value", alpha).alias("verdict"))


def verdict(p: str, alpha: float = SIGNIFICANCE) -> Column:
    return F.when(F.col(p) < alpha, "significant").when(F.col(p).isNotNull(), "not significant")
