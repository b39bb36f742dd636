"""Features and prices stored by key are matched, and the panel made of them, without an exchange."""

import pytest

from tickframe.operators import store
from tickframe.plans import features as plans
from tickframe.sources import testdata as data

from .helpers import count_of


@pytest.fixture
def stored(spark, root, tmp_path):
    bars = data.bars(spark, root)
    for name, df in (("scan_bars", bars), ("scan_features", plans.features(bars))):
        store.save_bucketed(df, name, str(tmp_path / name), 8, "stock_id", "date")
    before = {k: spark.conf.get(k) for k in (plans.STORED_BY_KEY, "spark.sql.autoBroadcastJoinThreshold")}
    # The test tables are small enough for a broadcast, which large ones are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(plans.STORED_BY_KEY, "false")
    yield spark.table("scan_features"), spark.table("scan_bars"), bars
    for k, v in before.items():
        spark.conf.set(k, v)
    for name in ("scan_bars", "scan_features"):
        spark.sql(f"DROP TABLE {name}")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_no_exchange_and_the_same_rows(stored):
    features, bars, plain = stored
    scan = plans.training_scan_bucketed(features, bars)
    assert count_of(scan, "Exchange") == 0 == count_of(plans.panel(scan), "Exchange")
    assert count_of(plans.training_scan(features, bars), "Exchange") > 0
    assert rows(scan) == rows(plans.training_scan(plans.features(plain), plain)) != []
    assert rows(plans.panel(scan)) == rows(plans.panel(plans.features(plain, keep=["close_price"])))


def test_the_setting_is_asked_for(spark, stored):
    spark.conf.set(plans.STORED_BY_KEY, "true")
    with pytest.raises(ValueError, match="requireAllClusterKeysForCoPartition"):
        plans.training_scan_bucketed(*stored[:2])
