"""Months of an upsert are swapped together."""

import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import store

from .helpers import day


def rows(spark, value, days=range(0, 120, 7)):
    made = [(k, day(d), value) for k in (1, 2) for d in days]
    df = spark.createDataFrame(made, "stock_id int, date date, sma_50 int")
    price = F.col("sma_50").cast(S.PRICE)
    return df.select("stock_id", "date", price.alias("sma_50"), price.alias("sma_200"), F.col("sma_50").cast(S.RSI).alias("rsi_14"),
                     price.alias("macd_value"), price.alias("macd_signal"))


def stored(spark, path):
    return sorted((r.stock_id, r.date, int(r.sma_50)) for r in store.open_table(spark, path, S.FEATURES).collect())


def test_a_job_that_fails_between_months_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "features")
    store.merge_rows(rows(spark, 1), path, S.FEATURES, S.SERIES_KEY)
    before = stored(spark, path)
    assert len(before) == 36 and {v for *_, v in before} == {1}

    def half(df, target, mode, partition, sort, real=store._write):
        real(df.filter(F.col(store.MONTH) == 200102), target, mode, partition, sort)
        raise RuntimeError("the driver is lost after one month")
    with monkeypatch.context() as broken:
        broken.setattr(store, "_write", half)
        with pytest.raises(RuntimeError):
            store.merge_rows(rows(spark, 2), path, S.FEATURES, S.SERIES_KEY)
    assert stored(spark, path) == before
    with monkeypatch.context() as broken:
        broken.setattr(store, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the swap")))
        with pytest.raises(RuntimeError):
            store.merge_rows(rows(spark, 2), path, S.FEATURES, S.SERIES_KEY)
    assert stored(spark, path) == before
    store.merge_rows(rows(spark, 2), path, S.FEATURES, S.SERIES_KEY)
    assert {v for *_, v in stored(spark, path)} == {2} and len(stored(spark, path)) == 36


def test_only_touched_months_are_rewritten_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "features")
    store.merge_rows(rows(spark, 1), path, S.FEATURES, S.SERIES_KEY)
    reader = store.open_table(spark, path, S.FEATURES)
    store.merge_rows(rows(spark, 2, range(40, 50)), path, S.FEATURES, S.SERIES_KEY)
    # A reader of before is still whole, and after one more swap its folders are gone.
    assert {int(r.sma_50) for r in reader.collect()} == {1}
    live, old = store._pointer(spark, path)
    assert old == ["month=200102"] and live == [".gen=000000001/month=200102", "month=200101", "month=200103", "month=200104"]
    store.merge_rows(rows(spark, 3, [0]), path, S.FEATURES, S.SERIES_KEY)
    assert not (tmp_path / "features/month=200102").exists()
    live, old = store._pointer(spark, path)
    assert old == ["month=200101"] and live[:2] == [".gen=000000001/month=200102", ".gen=000000002/month=200101"]
    got = {(k, d): v for k, d, v in stored(spark, path)}
    assert got[1, day(0)] == 3 and got[2, day(42)] == 2 and got[1, day(7)] == 1 and got[1, day(35)] == 1
    assert [int(x) for x in store.open_table(spark, path, S.FEATURES).filter("month = 200103").toPandas().sma_50.unique()] == [1]


def test_tables_of_plain_months_go_on(spark, tmp_path):
    path = str(tmp_path / "features")
    store.with_month(rows(spark, 1)).write.partitionBy(store.MONTH).parquet(path)
    store.merge_rows(rows(spark, 2, [0, 1]), path, S.FEATURES, S.SERIES_KEY)
    got = {(k, d): v for k, d, v in stored(spark, path)}
    assert len(got) == 38 and got[1, day(0)] == got[2, day(1)] == 2 and got[1, day(7)] == 1
    store.merge_rows(rows(spark, 2, []), path, S.FEATURES, S.SERIES_KEY)
    assert len(stored(spark, path)) == 38
