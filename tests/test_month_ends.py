"""Month ends: the last two feature rows of each key, kept in step by the feature job."""

import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import series, store
from tickframe.plans import daily, month_ends
from tickframe.sources import tables

from .helpers import closes, day, stocks


def bars_of(spark, by_key):
    made = closes(spark, by_key)
    return made.select("stock_id", "date", *(F.col("close_price").alias(c) for c in S.BARS.names[2:7]), F.lit(1).cast("long").alias("volume"))


def rows(df):
    return sorted(map(tuple, df.select(*S.FEATURES.names).collect()))


def kept(spark, db):
    return {m: rows(month_ends._at(spark, db, m)) for m in store.months(spark, f"{db}/{month_ends.FOLDER}")}


def expected(spark, db):
    """Of every month from the first to the one before the newest: the last two rows of each key by its end."""
    table = store.open_table(spark, f"{db}/features", S.FEATURES)
    months = store.months(spark, f"{db}/features")
    every = [m for m in range(months[0], months[-1]) if 1 <= m % 100 <= 12]
    return {m: rows(series.last_rows(table.filter(F.col("month") <= m), 2)) for m in every}


@pytest.fixture
def db(spark, tmp_path):
    root = str(tmp_path / "db")
    stocks(spark, {k: "ABCD"[k] * 3 for k in range(4)}).write.parquet(f"{root}/stocks")
    tables.bootstrap(spark, root)
    return root


def add(spark, db, df):
    store.append_absent(df, f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals")
    daily.build_features(spark, db)


def test_month_ends_follow_the_features(spark, db):
    price = lambda k, i: 100 + (i * (7 + k)) % 31 + (i // 50) % 9
    # Key 2 has one row in many months, key 3 stops early and key 1 has a late bar.
    whole = bars_of(spark, {k: [None if k == 2 and i > 230 and i % 29 else price(k, i) for i in range(520 if k < 3 else 260)] for k in (0, 1, 2, 3)})
    whole = whole.filter("close_price IS NOT NULL").cache()
    late = (F.col("stock_id") == 1) & (F.col("date") == day(300))
    add(spark, db, whole.filter(~late & (F.col("date") < day(400))))
    assert kept(spark, db) == expected(spark, db)
    add(spark, db, whole.filter(~late & (F.col("date") < day(470))))
    assert kept(spark, db) == expected(spark, db)
    before = kept(spark, db)
    add(spark, db, whole)
    assert kept(spark, db) == expected(spark, db)
    assert before != {m: r for m, r in kept(spark, db).items() if m in before}
    daily.build_features(spark, db, since=day(450))
    assert kept(spark, db) == expected(spark, db)
    daily.build_features(spark, db, anew=True)
    assert kept(spark, db) == expected(spark, db)

    # Any date: the rows read hold the last two of each key.
    table = tables.scan(spark, db, "features")
    for d in (100, 225, 301, 365, 419, 519, 900):
        assert rows(series.last_rows(month_ends.rows_until(spark, db, day(d)), 2)) == rows(series.last_rows(table.filter(F.col("date") <= day(d)), 2))


def test_a_past_ranking_reads_one_month_of_features(spark, db):
    add(spark, db, bars_of(spark, {k: [100 + (i * (7 + k)) % 31 for i in range(500)] for k in (0, 1, 2)}))
    daily.rank(spark, db, as_of=day(480))
    first = sorted(map(str, tables.scan(spark, db, "recommendations").collect()))
    # What is put into older months past the feature job is not seen, so they are not read.
    false = tables.scan(spark, db, "features").filter(F.col("date") == day(480)) \
        .withColumns({"date": F.lit(day(430)), "stock_id": F.lit(3)})
    store._write(store.with_month(false.dropDuplicates(["stock_id"])), f"{db}/features", "append", store.MONTH, S.SERIES_KEY)
    daily.rank(spark, db, as_of=day(480))
    assert sorted(map(str, tables.scan(spark, db, "recommendations").collect())) == first
    # Without month ends all months before are read.
    month_ends.forget(spark, db, 0)
    assert kept(spark, db) == {}
    assert {r.stock_id for r in month_ends.rows_until(spark, db, day(480)).select("stock_id").distinct().collect()} == {0, 1, 2, 3}


def test_empty_and_short_tables(spark, db):
    month_ends.bring_up(spark, db)
    assert month_ends.rows_until(spark, db, day(3)).count() == 0
    add(spark, db, bars_of(spark, {0: [100 + i % 7 for i in range(205)]}))
    assert kept(spark, db) == expected(spark, db) == {}
