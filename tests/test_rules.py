"""Rules that rows must keep to be stored."""

import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import quality, store
from tickframe.plans import daily
from tickframe.sources import tables

from .helpers import count_of, day, stocks


def bars(spark, rows):
    df = spark.createDataFrame(rows, "stock_id int, date date, close_price double, volume long")
    price = F.col("close_price").cast(S.PRICE)
    return df.select("stock_id", "date", *(price.alias(c) for c in S.BARS.names[2:7]), "volume")


def reasons(df):
    return sorted((r.reason or "", r.stock_id or 0) for r in df.collect())


ROWS = [(1, day(0), 5.0, 1), (9, day(0), 5.0, 1), (None, day(0), 5.0, 1), (1, None, 5.0, 1), (2, day(1), None, 1), (9, day(1), 5.0, 0), (2, day(2), 5.0, 0)]


def test_the_first_broken_rule_is_named(spark):
    marked = quality.with_reason(bars(spark, ROWS), quality.bar_rules(stocks(spark, {1: "A", 2: "B", 3: "C"})))
    # All rules in one pass: one join, looked at before adaptive execution adds its own.
    assert count_of(marked, "BroadcastHashJoin") + count_of(marked, "SortMergeJoin") == 1
    assert reasons(marked) == [("", 1), ("missing date", 1), ("missing open_price", 2), ("missing stock_id", 0),
                               ("no volume", 2), ("unknown stock_id", 9), ("unknown stock_id", 9)]
    # A parent that holds a key twice neither loses rows nor doubles them.
    twice = stocks(spark, {1: "A"}).unionByName(stocks(spark, {1: "A"}))
    assert quality.with_reason(bars(spark, ROWS), quality.bar_rules(twice)).count() == len(ROWS)


def test_nulls_break_neither_checks_nor_parents_and_empty_rules_hold(spark):
    df = bars(spark, [(None, day(0), 5.0, None)])
    rules = quality.Rules((), {"stock_id": stocks(spark, {1: "A"})}, {"no volume": "volume > 0"})
    assert reasons(quality.with_reason(df, rules)) == reasons(quality.with_reason(df, quality.Rules())) == [("", 0)]
    assert quality.with_reason(df.limit(0), rules).count() == 0


def test_no_orphan_enters_and_a_run_may_be_repeated(spark, tmp_path):
    db = str(tmp_path / "db")
    stocks(spark, {1: "A", 2: "B"}).write.parquet(f"{db}/stocks")
    tables.bootstrap(spark, db)
    for _ in range(2):
        daily.ingest_bars(spark, db, bars(spark, ROWS))
    daily.ingest_bars(spark, db, bars(spark, [(7, day(0), 1.0, 1), (2, day(0), 1.0, 1), (1, day(0), 99.0, 1)]), batch="second")
    stored = sorted((r.stock_id, float(r.close_price)) for r in tables.scan(spark, db, "bars").collect())
    assert stored == [(1, 5.0), (2, 1.0)]
    kept = spark.read.parquet(f"{db}/rejects")
    assert kept.count() == 7 and [r.stock_id for r in kept.filter("batch = 'second'").collect()] == [7]
    assert quality.orphans(tables.scan(spark, db, "bars"), tables.scan(spark, db, "stocks"), ["stock_id"]).count() == 0


def test_other_tables_and_an_order_of_arrival(spark, tmp_path):
    rows = bars(spark, [(1, day(0), 2.0, 1), (1, day(0), 1.0, 1), (5, day(0), 1.0, 1)]).withColumn("place", (2 - F.col("close_price")).cast("int"))
    store.append_checked(rows, str(tmp_path / "t"), S.BARS, S.SERIES_KEY, quality.Rules(parents={"stock_id": stocks(spark, {1: "A"})}),
                         str(tmp_path / "r"), "place")
    assert [float(r.close_price) for r in store.open_table(spark, str(tmp_path / "t"), S.BARS).collect()] == [2.0]
    assert "place" not in spark.read.parquet(str(tmp_path / "r")).columns


def test_streams_need_a_place_for_rejects(spark, tmp_path):
    from tickframe.streaming import ingest
    with pytest.raises(ValueError):
        ingest.ingest_available(spark, str(tmp_path), str(tmp_path / "t"), str(tmp_path / "c"), stocks=stocks(spark, {1: "A"}))
