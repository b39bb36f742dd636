"""Bars that come late: only the months around them are read, and the result is that of a full build."""

import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import store
from tickframe.plans import daily, features, incremental
from tickframe.sources import tables

from .helpers import closes, day, stocks

DAYS = 4200


@pytest.fixture(scope="module")
def bars(spark):
    """Three keys over more than eleven years."""
    made = closes(spark, {k: [100 + (i * (7 + k)) % 31 + (i // 50) % 9 for i in range(DAYS)] for k in (1, 2, 3)})
    return made.select("stock_id", "date", *(F.col("close_price").alias(c) for c in S.BARS.names[2:7]), F.lit(1).cast("long").alias("volume")).cache()


def rows(df):
    return sorted(map(tuple, df.select(*S.FEATURES.names).collect()))


def state_rows(spark, root):
    return sorted((r.stock_id, r.date, r.closes, r.recent) for r in incremental.stored_state(spark, root).collect())


@pytest.fixture
def db(spark, tmp_path):
    root = str(tmp_path / "db")
    stocks(spark, {1: "AAA", 2: "BBB", 3: "CCC"}).write.parquet(f"{root}/stocks")
    tables.bootstrap(spark, root)
    return root


def add(spark, root, df):
    store.append_absent(df, f"{root}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{root}/arrivals")


@pytest.fixture
def read(monkeypatch):
    """How many bars each run from history reads."""
    seen = []

    def counted(df, real=incremental.from_history):
        seen.append(df.count())
        return real(df)
    monkeypatch.setattr(incremental, "from_history", counted)
    return seen


LATE = f"stock_id = 2 AND date IN ('{day(300)}', '{day(302)}')"


@pytest.mark.parametrize("late, most", [
    (LATE, 2 * incremental.REACH + 200),
    (f"stock_id = 1 AND date = '{day(DAYS - 40)}'", incremental.REACH + 200),
    (f"stock_id < 3 AND date = '{day(2000)}'", 2 * (2 * incremental.REACH + 200)),
    (f"stock_id = 3 AND date = '{day(0)}'", DAYS)])
def test_late_bars_equal_a_full_build(spark, db, bars, read, late, most):
    late, newest = F.expr(late), F.col("date") >= day(DAYS - 5)
    add(spark, db, bars.filter(~late & ~newest))
    daily.build_features(spark, db)
    add(spark, db, bars.filter(late | (newest & (F.col("stock_id") == 3))))
    daily.build_features(spark, db)
    assert len(read) == 2 and read[1] <= most
    add(spark, db, bars)
    daily.build_features(spark, db)
    assert len(read) == 2
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))
    twin = f"{db}-twin"
    stocks(spark, {1: "AAA", 2: "BBB", 3: "CCC"}).write.parquet(f"{twin}/stocks")
    add(spark, twin, bars)
    daily.build_features(spark, twin)
    assert state_rows(spark, db) == state_rows(spark, twin)


def test_notes_that_stand_for_nothing_cost_a_full_build_only(spark, db, bars, read):
    add(spark, db, bars.filter(~F.expr(LATE)))
    daily.build_features(spark, db)
    # A run that noted its rows and failed before it stored them.
    bars.filter("stock_id = 2").groupBy("stock_id", (F.year("date") * 100 + F.month("date")).alias("month")).agg(
        F.min("date").alias("first"), F.max("date").alias("last"), (F.count("*") * 50).alias("n")).write.mode("append").parquet(f"{db}/noted")
    add(spark, db, bars)
    daily.build_features(spark, db)
    assert read[-1] == DAYS
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))


def test_tables_of_bars_that_were_never_noted(spark, db, bars):
    """Bars stored by hand before: the notes know of fewer rows than there are, so windows are too wide, not too short."""
    store.append_absent(bars.filter(~F.expr(LATE) & (F.col("date") < day(1000))), f"{db}/bars", S.BARS, S.SERIES_KEY)
    add(spark, db, bars.filter(~F.expr(LATE) & (F.col("date") >= day(1000))))
    daily.build_features(spark, db)
    add(spark, db, bars)
    daily.build_features(spark, db)
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))
