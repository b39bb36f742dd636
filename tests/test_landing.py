"""Vendor text files: cells by name, unreadable lines kept, rejects of every day; daily jobs that stay in step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import boosting, model, store
from tickframe.plans import daily, features, incremental
from tickframe.session import _staged, new_path, scratch, stage
from tickframe.sources import landing, tables
from tickframe.streaming import ingest

from .helpers import closes, day, stocks


@pytest.fixture
def db(spark, tmp_path):
    root = str(tmp_path / "db")
    stocks(spark, {1: "AAA", 2: "BBB"}).write.parquet(f"{root}/stocks")
    tables.bootstrap(spark, root)
    return root


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("_", ".")).write_text(text, encoding="utf-8")
    return str(folder)


def bars_of(spark, root):
    return {(r.stock_id, str(r.date)): (float(r.open_price), float(r.high_price), float(r.low_price), float(r.close_price), r.volume)
            for r in tables.scan(spark, root, "bars").collect()}


ODD = {
    "a_csv": "Ticker,Date,Open,High,Low,Close,Adj Close,Volume\nAAA.NS,2024-01-02,1,4,0.5,2,2,10\n\n  \nAAA.NS,2024-01-03,1,4,0.5,2,2,10,99\nAAA.NS,2024-01-04,1\n",
    "b_csv": '﻿"Date","Ticker","Close","Open","Note","Low","High","Volume"\n2024-01-02,BBB.NS,2.5,1.5,"hi",0.75,4.5,20\r\n2024-01-05,"BBB.NS",3,1,,1,4,x\n',
    "c_csv": "AAA.NS,2024-01-08,1,4,0.5,2,2,10\n",
    "d_csv": "Ticker,Date,Close,Close,Volume\nAAA.NS,2024-01-09,1,2,3\n",
}
STORED = {(1, "2024-01-02"): (1, 4, 0.5, 2, 10), (2, "2024-01-02"): (1.5, 4.5, 0.75, 2.5, 20)}
UNREADABLE = {"AAA.NS,2024-01-03,1,4,0.5,2,2,10,99", "AAA.NS,2024-01-04,1", "AAA.NS,2024-01-08,1,4,0.5,2,2,10", "AAA.NS,2024-01-09,1,2,3"}


def check(spark, root):
    assert bars_of(spark, root) == STORED
    bad = spark.read.parquet(f"{root}/rejects").collect()
    assert {r.line for r in bad if r.reason == "unreadable line"} == UNREADABLE
    assert all(r.file.endswith(".csv") for r in bad) and {r.file[-5] for r in bad} == {"a", "b", "c", "d"}
    assert [(r.ticker, r.date_text, r.reason) for r in bad if r.line is None] == [("BBB.NS", "2024-01-05", "missing volume")]


def test_csv_cells_by_name_in_a_batch(spark, db, tmp_path):
    files = put(tmp_path / "landed", **ODD)
    for _ in range(2):
        daily.ingest(spark, db, landing.read_landing(spark, files, "csv"))
    check(spark, db)


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_csv_cells_by_name_in_the_stream(spark, db, tmp_path, files_per_batch):
    files = put(tmp_path / "landed", **ODD)
    for _ in range(2):
        daily.ingest_files(spark, db, files, "csv", files_per_batch=files_per_batch)
    check(spark, db)


def test_malformed_json_keeps_its_text(spark, db, tmp_path):
    good = '{"Volume": 5, "Date": "2024-01-02", "Ticker": "AAA.NS", "Open": 1, "High": "2.5", "Low": 1, "Close": 2, "More": [1]}'
    files = put(tmp_path / "landed", x_json="\n".join([good, '{"Ticker": "AAA.NS", "Date": ', "not json", "[1, 2]", '{"Ticker": "ZZZ.NS"}', ""]))
    daily.ingest(spark, db, landing.read_landing(spark, files, "json"))
    assert bars_of(spark, db) == {(1, "2024-01-02"): (1, 2.5, 1, 2, 5)}
    bad = {(r.line, r.reason) for r in spark.read.parquet(f"{db}/rejects").collect()}
    assert {('{"Ticker": "AAA.NS", "Date": ', "unreadable line"), ("not json", "unreadable line"), (None, "unknown ticker")} <= bad


def test_no_files_with_a_header_and_no_lines(spark, tmp_path):
    for name, text in (("p", "x,y\n1,2\n"), ("q", "Ticker,Date\n"), ("r", "\n\n")):
        rows = landing.read_landing(spark, put(tmp_path / name, x_csv=text), "csv").collect()
        assert [r._line for r in rows] == (["x,y", "1,2"] if name == "p" else [])


def vendor(spark, rows):
    return spark.createDataFrame([(t, d, *[c] * 5, v) for t, d, c, v in rows], landing.vendor_schema(text=True))


def test_rejects_of_earlier_days_stay(spark, db):
    one = vendor(spark, [("AAA.NS", "2024-01-02", "5", "1"), ("QQQ.NS", "2024-01-02", "5", "1")])
    two = vendor(spark, [("AAA.NS", "soon", "5", "1"), ("BBB.NS", "2024-01-03", "5", "0")])
    for batch in (one, two, two.repartition(3), one):
        daily.ingest(spark, db, batch)
    assert sorted(r.reason for r in spark.read.parquet(f"{db}/rejects").collect()) == ["missing date", "no volume", "unknown ticker"]
    daily.ingest(spark, db, two, batch="named")
    assert spark.read.parquet(f"{db}/rejects").count() == 5


def walk(spark, n):
    """Bars of two keys over n days."""
    made = closes(spark, {k: [100 + (i * (7 + k)) % 31 for i in range(n)] for k in (1, 2)})
    return made.select("stock_id", "date", *(F.col("close_price").alias(c) for c in S.BARS.names[2:7]), F.lit(1).cast("long").alias("volume"))


def as_vendor(bars):
    back = {c: f for f, c in landing.VENDOR_FIELDS.items()}
    ticker = F.when(F.col("stock_id") == 1, "AAA.NS").otherwise("BBB.NS").alias("Ticker")
    return bars.select(ticker, F.col("date").alias("Date"), *(F.col(c).cast("double").alias(back[c]) for c in back))


def rows(df):
    return sorted(map(tuple, df.select(*S.FEATURES.names).collect()))


def test_streamed_bars_become_features(spark, db, tmp_path):
    bars, files = walk(spark, 330), str(tmp_path / "landed")
    for low, high in ((0, 240), (240, 310)):
        as_vendor(bars.filter(F.col("date").between(day(low), day(high - 1)))).write.mode("append").parquet(files)
        daily.ingest_files(spark, db, files)
        if low == 0:
            daily.build_features(spark, db)
    # 70 days came by the stream and were not built yet; then a batch comes.
    daily.ingest(spark, db, as_vendor(bars))
    daily.build_features(spark, db)
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))


def test_typed_stream_notes_beside_the_table(spark, tmp_path):
    root, files = str(tmp_path / "db"), str(tmp_path / "landed")
    walk(spark, 220).select(*S.BARS.names).write.parquet(files)
    ingest.ingest_available(spark, files, f"{root}/bars", f"{root}/ingested")
    assert spark.read.schema(incremental.ARRIVALS).parquet(f"{root}/arrivals").agg(F.sum("n")).first()[0] == 440


@pytest.mark.parametrize("noted", [True, False])
def test_rankings_are_not_stale_after_since(spark, db, noted):
    bars = walk(spark, 320)
    store.append_absent(bars.filter(F.col("date") < day(300)), f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals")
    daily.build_features(spark, db)
    store.append_absent(bars, f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals" if noted else None)
    daily.build_features(spark, db, since=day(290))
    daily.rank(spark, db)
    assert {r.date for r in tables.scan(spark, db, "recommendations").collect()} == {day(319)}
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))


def test_ranking_with_a_stored_model_of_either_kind(spark, db, tmp_path):
    store.append_absent(walk(spark, 260), f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals")
    daily.build_features(spark, db)
    panel = spark.range(300).selectExpr("0 AS trend_signal", "id / 3 AS momentum_score", "0 AS macd_score", "int(id > 150) AS target")
    for k, fit in enumerate((model.train_trees, model.train)):
        model.save(fit(panel, maxIter=3, maxDepth=2), path := str(tmp_path / f"m{k}"))
        assert isinstance(model.load(path), boosting.Trees) == (k == 0)
        daily.rank(spark, db, path)
        got = tables.scan(spark, db, "recommendations").collect()
        assert {r.model_type for r in got} == {"SHE", "LEM"} and all(r.score > 0 for r in got if r.model_type == "LEM")


def test_old_states_and_staged_copies_go(spark, db):
    bars = walk(spark, 260)
    before = len(_staged.get(spark.sparkContext.applicationId, []))
    for k in (230, 240, 250, 260):
        store.append_absent(bars.filter(F.col("date") < day(k)), f"{db}/bars", S.BARS, S.SERIES_KEY, arrivals=f"{db}/arrivals")
        daily.build_features(spark, db)
    assert len(incremental._versions(spark, db)) == 2
    assert len(_staged.get(spark.sparkContext.applicationId, [])) == before
    assert rows(tables.scan(spark, db, "features")) == rows(features.features(bars))


def test_scratch_leaves_what_was_staged_outside(spark):
    kept = stage(spark.range(3), "kept")
    with scratch(spark):
        gone = new_path(spark, "gone")
        spark.range(2).write.parquet(gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
    assert dt.date(2001, 1, 1) == day(0)
