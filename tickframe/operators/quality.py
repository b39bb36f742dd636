"""Cleaning, rejected rows and integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.schemas import BAR_FIELDS, MIN_HISTORY, SERIES_KEY

REQUIRED = [*SERIES_KEY, *BAR_FIELDS]


def reject_reason(fields: Sequence[str] = REQUIRED) -> Column:
    """Why a bar is not usable, or null. Missing fields are named first, keys before the others."""
    missing = reduce(lambda a, c: a.when(F.col(c).isNull(), f"missing {c}"), fields[1:],
                     F.when(F.col(fields[0]).isNull(), f"missing {fields[0]}"))
    return missing.when(F.col("volume") <= 0, "no volume")


def clean_bars(raw: DataFrame, fields: Sequence[str] = REQUIRED) -> DataFrame:
    """Complete bars that were traded, keys included; the adjusted price may be missing."""
    return raw.dropna(subset=list(fields)).filter(F.col("volume") > 0)


def rejects(raw: DataFrame, fields: Sequence[str] = REQUIRED) -> DataFrame:
    """The rows that ``clean_bars`` drops, with the reason. A row with a ticker
    but no key is of a ticker that no stock has, a row with ``line`` could not be read."""
    if "ticker" in raw.columns:
        unknown = F.col("stock_id").isNull() & F.col("ticker").isNotNull()
        unreadable = F.col("line").isNotNull() if "line" in raw.columns else F.lit(False)
        reason = F.when(unreadable, "unreadable line").when(unknown, "unknown ticker").otherwise(reject_reason(fields))
        return raw.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return raw.withColumn("reason", reject_reason(fields)).filter(F.col("reason").isNotNull())


@dataclass(frozen=True)
class Rules:
    """What every row of a table must keep: columns that are not null, columns whose
    value the table of that name's parent has, and conditions, by the reason to give
    where they are false. As with SQL's own constraints, a condition that is null
    holds, and so does a null that refers to no parent."""
    required: Sequence[str] = ()
    parents: Mapping[str, DataFrame] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)


def bar_rules(stocks: DataFrame) -> Rules:
    return Rules(REQUIRED, {"stock_id": stocks}, {"no volume": "volume > 0"})


def with_reason(rows: DataFrame, rules: Rules) -> DataFrame:
    """``rows`` with the first rule each breaks as ``reason``, or null: missing columns in order, then parents, then checks.

    One pass: a parent's keys are joined once each, and a key with very many rows
    stays with the side that adaptive joins may split.
    """
    columns, reasons = rows.columns, [F.when(F.col(c).isNull(), f"missing {c}") for c in rules.required]
    for k, (column, parent) in enumerate(rules.parents.items()):
        known = parent.select(F.col(column).alias(f"_parent{k}")).distinct()
        rows = rows.join(known, F.col(column) == F.col(f"_parent{k}"), "left")
        reasons.append(F.when(F.col(column).isNotNull() & F.col(f"_parent{k}").isNull(), f"unknown {column}"))
    reasons += [F.when(~F.expr(condition), reason) for reason, condition in rules.checks.items()]
    return rows.select(*columns, F.coalesce(*reasons, F.lit(None).cast("string")).alias("reason"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)


def orphans(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the parent table lacks, with their row counts. Rows are counted per
    key first, so a key with very many rows crosses the network as one row per task."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.join(parent.select(*keys), list(keys), "left_anti")


def _as_checks(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], list(one_row.columns), "check", "failures")


def null_checks(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in columns]


def report(bars: DataFrame, stocks: DataFrame, min_rows: int = MIN_HISTORY) -> DataFrame:
    """One row per check with the number of failures, in two passes over the bars:
    one for checks on a row, one for checks on keys."""
    row_checks = bars.groupBy().agg(
        *null_checks(["stock_id", "date", *BAR_FIELDS]),
        F.count_if(reject_reason().isNotNull()).alias("rejected bar"))
    per_bar = bars.groupBy("stock_id", "date").agg(F.count("*").alias("n"))
    per_key = per_bar.groupBy("stock_id").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"))
    known = stocks.select("stock_id").distinct().withColumn("known", F.lit(True))
    key_checks = per_key.join(known, "stock_id", "left").groupBy().agg(
        F.coalesce(F.sum("repeated"), F.lit(0)).cast("bigint").alias("duplicate bar"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("orphan bar"),
        F.count_if(F.col("n") < min_rows).alias("short history"))
    parts = [
        _as_checks(row_checks), _as_checks(key_checks),
        _as_checks(stocks.groupBy().agg(*null_checks(["symbol"]))),
        _as_checks(duplicate_keys(stocks, ["stock_id"]).groupBy().agg(F.count("*").alias("duplicate stock_id"))),
        _as_checks(duplicate_keys(stocks, ["symbol"]).groupBy().agg(F.count("*").alias("duplicate symbol"))),
    ]
    return reduce(DataFrame.unionByName, parts)
