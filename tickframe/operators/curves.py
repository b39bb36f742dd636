"""Chart data from return series: wide frames, equity and drawdown curves, JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.operators import metrics


def wide(rows: DataFrame, strategies: Sequence[str], value: str = "ret") -> DataFrame:
    """One row per date, one column per strategy, null where a strategy has no row."""
    return rows.groupBy("date").pivot("strategy", list(strategies)).agg(F.first(value))


def equity_curve(returns: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """Growth of 1 per strategy. Compounded per strategy before the rows are
    put side by side, so no window runs over all dates of a wide frame."""
    grown = metrics.with_equity(returns.filter(F.col("strategy").isin(list(strategies))))
    out = wide(grown, strategies, "equity")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("label"), *strategies).orderBy("label")


def drawdown_curve(returns: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """Percent below the highest value so far, per strategy."""
    fallen = metrics.with_equity(returns.filter(F.col("strategy").isin(list(strategies))))
    return wide(fallen.withColumn("pct", F.col("drawdown") * 100), strategies, "pct").orderBy("date")


def chart_json(returns: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """One JSON text: ``dates`` and one array per field, all in date order, doubles in full.

    ``fields`` names the output arrays. The row holds one entry per calendar day.
    """
    days = wide(returns.filter(F.col("strategy").isin(list(fields.values()))), list(fields.values()))
    row = F.struct("date", *(F.col(s).cast("double").alias(f) for f, s in fields.items()))
    one = days.groupBy().agg(F.array_sort(F.collect_list(row)).alias("rows"))
    record = F.struct(
        F.transform("rows", lambda r: F.date_format(r["date"], "yyyy-MM-dd")).alias("dates"),
        *(F.col(f"rows.{f}").alias(f) for f in fields))
    return one.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))


def read_chart(chart: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The rows of a chart's JSON text: date and one double per field."""
    kind = "dates array<string>, " + ", ".join(f"{f} array<double>" for f in fields)
    parsed = chart.select(F.from_json("json", kind).alias("j")).select("j.*")
    each = parsed.select(F.inline(F.arrays_zip("dates", *fields)))
    return each.select(F.to_date("dates").alias("date"), *fields)


def write_chart(returns: DataFrame, fields: Mapping[str, str], path: str) -> None:
    """The chart data as a text file of one JSON line."""
    chart_json(returns, fields).write.mode("overwrite").text(path)
