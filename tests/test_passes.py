"""What the daily jobs write aside, and how often."""

from pyspark.sql import functions as F

from tickframe import registry
from tickframe import schemas as S
from tickframe.operators import store
from tickframe.plans import incremental

from .helpers import closes, day


def test_only_new_rows_are_written_aside(spark, monkeypatch):
    rows = closes(spark, {k: [100 + (i * (7 + k)) % 31 for i in range(305)] for k in (1, 2)}).cache()
    whole = rows.filter("stock_id = 1").unionByName(rows.filter(F.col("date") < day(300)).filter("stock_id = 2"))
    features, state = incremental.from_history(rows.filter(F.col("date") < day(300)))
    state = state.cache()
    written = {}

    def counted(df, label, real=incremental.stage):
        out = real(df, label)
        written[label] = out.count()
        return out
    monkeypatch.setattr(incremental, "stage", counted)
    new, after = incremental.from_state(state, rows.filter("stock_id = 1").filter(F.col("date") >= day(300)))
    assert written == {"new-rows": 5}
    again, expected = incremental.from_history(whole)
    # Key 2 got nothing new and keeps its state.
    shown = ["stock_id", "date", "closes", "recent"]
    assert sorted(after.select(*shown).collect()) == sorted(expected.select(*shown).collect())
    assert sorted(features.unionByName(new).collect()) == sorted(again.collect())


def test_rows_without_an_order_come_last_and_stay_whole(spark):
    batch = spark.createDataFrame([(1, None, 5), (1, 7, 6), (1, 8, 1), (2, None, 4), (2, None, 3)], "k int, v int, x int")
    for pick, kept in ((F.min_by, [(1, 7, 6), (2, None, 3)]), (F.max_by, [(1, 8, 1), (2, None, 4)])):
        assert sorted(map(tuple, store.one_per_key(batch, ["k"], pick, "v").collect())) == kept


def test_merged_rows_that_are_written_aside_are_not_written_again(spark, tmp_path, monkeypatch):
    path, labels = str(tmp_path / "t"), []

    def noted(df, label, real=store.staged):
        labels.append(label)
        return real(df, label)
    monkeypatch.setattr(store, "staged", noted)
    rows = spark.createDataFrame([(1, day(0), *[None] * 5), (1, day(1), *[None] * 5)], S.FEATURES)
    for batch in (rows, rows.filter(F.col("date") > day(0))):
        store.merge_rows(batch, path, S.FEATURES, S.SERIES_KEY, distinct_keys=True, staged_already=True)
    assert labels == [] and store.open_table(spark, path, S.FEATURES).count() == 2


def test_staged_bars_are_not_written_aside_again(spark, tmp_path, monkeypatch):
    root, labels = str(tmp_path), []
    spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(1, "S", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{root}/supplier.parquet")
    sold = [(i, 1, 1, 1, 1.0, 10.0 + i, day(i)) for i in range(5)]
    spark.createDataFrame(sold, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate date") \
        .write.parquet(f"{root}/lineitem.parquet")

    def noted(df, label, real=store.staged):
        labels.append(label)
        return real(df, label)
    monkeypatch.setattr(store, "staged", noted)
    for job in ("build_features", "rank"):
        monkeypatch.setattr(registry.daily, job, lambda *args, **named: None)
    registry.rankings_of_past_dates(spark, root)
    assert labels == ["fresh"] * 3
