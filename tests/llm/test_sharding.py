"""Sharding: a permutation, even shards, gapless slots."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickframe.llm import feistel, registry, sharding

from ..conftest import SMALL
from .helpers import awkward, empty


@pytest.fixture(scope="module")
def places(spark):
    def of(n, seed):
        key = F.xxhash64(F.lit(seed))
        steps = feistel.walks(spark.range(1).select(F.lit(n).cast("long").alias("n"), key.alias("key")))
        return [r[0] for r in spark.range(n, numPartitions=1).select(feistel.permute(F.col("id"), F.lit(n).cast("long"), key, steps)).collect()]
    return of


@given(st.integers(1, 700), st.integers(0, 9))
@settings(max_examples=12, deadline=None)
def test_permutation_of_any_size(places, n, seed):
    assert sorted(places(n, seed)) == list(range(n))


def test_permutation_scatters(places):
    got = places(10_000, 1)
    assert got != places(10_000, 2) and got == places(10_000, 1)
    assert abs(sum(a < b for a, b in zip(got, got[1:])) - 5000) < 300


def check(rows, got):
    wanted = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == wanted
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    shards = Counter(r.shard for r in got)
    counts = [shards[s] for s in range(16)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in shards:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(shards[s]))


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = registry.op9_sharding(spark, SMALL).collect()
    check(rows, got)
    assert sorted(got, key=str) == sorted(sharding.document_shards(
        spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)).collect(), key=str)


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    check([(r[0], r[1]) for r in rows], sharding.document_shards(docs.selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size")).collect())
    assert sharding.document_shards(empty(spark)).count() == 0


def test_no_row_leaves_the_jvm(spark):
    plan = registry.op9_sharding(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
