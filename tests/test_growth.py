"""Steps whose tasks must not grow faster than the input."""

import re

import pytest

from tickframe import registry
from tickframe.operators import model, series
from tickframe.sources import landing

from .helpers import count_of


def test_counts_to_train_on_are_read_not_aggregated_in_two_tasks(spark, root, monkeypatch):
    seen, fit = [], model.fit

    def looked(counts, **params):
        seen.append((count_of(counts, "FileScan"), count_of(counts, "HashAggregate")))
        return fit(counts, **params)

    monkeypatch.setattr(model, "fit", looked)
    registry.stump(spark, root)
    assert seen == [(1, 0)]


@pytest.fixture
def uncoalesced(spark):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_no_day_of_lines_is_written_by_one_task(spark, root, monkeypatch, uncoalesced):
    files, read = [], landing.read_landing

    def looked(spark, path, fmt):
        files.append(len(spark.read.text(path).inputFiles()))
        return read(spark, path, fmt)

    monkeypatch.setattr(landing, "read_landing", looked)
    registry.rejects_of_two_days(spark, root)
    assert len(files) == 3 and min(files) > 1


@pytest.mark.parametrize("name", ["lem_stump_scores", "lem_tuned"])
def test_the_panel_is_worked_out_once(spark, root, monkeypatch, name):
    calls, panel = [], registry.panel

    def looked(*args):
        calls.append(1)
        return panel(*args)

    monkeypatch.setattr(registry, "panel", looked)
    out = registry.QUERIES[name](spark, root)
    assert len(calls) == 1 and count_of(out, "Window") == 0


@pytest.mark.parametrize("name", ["macd_far_spans", "ema_far_spans", "panel"])
def test_series_are_dealt_by_the_size_of_their_files(spark, root, monkeypatch, name):
    whole = registry.QUERIES[name](spark, root)
    monkeypatch.setattr(series, "DEALT_BYTES", 4 << 10)
    dealt = registry.QUERIES[name](spark, root)
    numbers = [int(n) for n in re.findall(r"hashpartitioning\(stock_id#\d+, (\d+)\), REPARTITION_BY_NUM", dealt._jdf.queryExecution().executedPlan().toString())]
    assert len(set(numbers)) == 1 and numbers[0] > spark.sparkContext.defaultParallelism
    assert dealt.exceptAll(whole).isEmpty() and dealt.count() == whole.count()


def test_lines_stay_where_they_are_and_are_parsed_once(spark, tmp_path):
    for k, text in enumerate(("Ticker,Date,Close\nAA.NS,2001-01-01,1.5\nTicker in, Date\n", "Date,Low,Ticker\n2001-01-02,2,BB.NS\n2001-01-03,3\n")):
        (tmp_path / f"{k}.csv").write_text(text)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = landing.read_landing(spark, str(tmp_path), "csv")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(_file" not in plan and count_of(out, "SortMergeJoin") == 0
    assert plan.count("from_csv(") == 2
    found = {(r.Ticker, r.Date, r.Low, r.Close, r._line) for r in out.collect()}
    assert found == {("AA.NS", "2001-01-01", None, "1.5", None), ("BB.NS", "2001-01-02", "2", None, None),
                     (None, None, None, None, "Ticker in, Date"), (None, None, None, None, "2001-01-03,3")}
