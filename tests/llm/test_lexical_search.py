"""Ranked lexical search against a plain ranking of all pairs, and its twin in SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tickframe.llm import lexical_search as lexical
from tickframe.llm import registry

from ..conftest import SMALL
from .helpers import awkward, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    """(item, rank, doc, score) by scoring every document for every item."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for d, c, n in counts:
            m = 10 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in own if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(6)
    vocabulary = [f"t{k}" for k in range(60)] + ["Ünï", "日本", "x9", "a_b"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([0, 1, 3, 20, 80, 400])))) for i in range(400)]
    docs += [(1000 + i, "t50 t51 t52 shared copy") for i in range(40)] + [docs[5]] * 3 + [(None, "t50 t51"), (7, None), (8, "--- \x00 !")]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 6, 15])))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "neverseen"), (33, "T50, t51. t50"), (34, "copy shared"), (None, "t3 t4"), (35, "t1"), (35, "t55"), (35, "t1")]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"seeds": 20, "bucket_rows": 16}, {"seeds": 1, "bucket_rows": 1, "block_terms": 12}])
def test_equals_brute_force(spark, tables, settings):
    docs, items = tables
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                         spark.createDataFrame(items, ITEMS), **settings)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows(got) == brute(docs, items)


def test_sql_equals_brute_force(tables):
    docs, items = tables
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    # DuckDB's client cannot pass a NUL character.
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [(d, t and t.replace("\x00", " ")) for d, t in docs])
    connection.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(connection.execute(lexical.SQL).fetchall(), key=repr) == brute(docs, items)


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert rows(registry.op13_lexical_search(spark, SMALL)) == sorted(connection.execute(lexical.SQL).fetchall(), key=repr)


def test_bounds_leave_out_buckets_and_rows(spark):
    """Rare terms in few documents: most buckets and rows are never scored, and no result is lost."""
    r = random.Random(1)
    docs = [(i, " ".join(f"c{r.randrange(30)}" for _ in range(20)) + (f" rare{i % 500} odd{i % 500} only{i % 500}" if i < 3000 else "")) for i in range(20_000)]
    items = [(k, f"rare{k} odd{k} only{k} c1 c2 c3") for k in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    seen = lexical.search(*frame, top=5, bucket_rows=256, seeds=4000, figures=True).groupBy().sum().first()
    assert seen["sum(left_out)"] > 0.5 * seen["sum(met)"] and seen["sum(rescored)"] < 0.01 * len(docs) * len(items)
    assert rows(lexical.search(*frame, top=5, bucket_rows=256, seeds=4000)) == brute(docs, items, 5)


def test_no_bound_is_below_a_score():
    random_ = np.random.default_rng(5)
    for _ in range(60):
        width = 12
        held = [np.flatnonzero(random_.random(width) < 0.4).astype(np.int32) for _ in range(30)]
        xs = [random_.integers(1, 10 ** 9, len(h)) for h in held]
        bounds = np.r_[0, np.cumsum([len(h) for h in held])]
        lengths = np.array([np.sqrt((x.astype(float) ** 2).sum()) for x in xs])
        bucket = lexical.Bucket(np.arange(30), np.ones(30, bool), lengths, np.concatenate(held), np.concatenate(xs), bounds, width)
        terms_ = np.flatnonzero(random_.random(width) < 0.5)
        true = np.array([x[np.isin(h, terms_)].sum() for h, x in zip(held, xs)])
        assert (bucket.scores(np.arange(30), terms_) == true).all()
        for threshold in (0, 1, int(np.median(true)), int(true.max(initial=0))):
            kept = set(bucket.survivors(terms_, threshold).tolist()) if len(terms_) else set()
            assert {i for i in range(30) if true[i] >= max(1, threshold)} <= kept


def test_awkward_and_empty_tables(spark):
    docs, listed = awkward(spark)
    clashing = docs.selectExpr("*", "1 AS n", "2 AS ids", "3 AS length", "4 AS item_id", "5 AS score")
    items = spark.createDataFrame([(1, "One two; Lorem 日本語"), (2, "ünï end")], ITEMS).selectExpr("*", "1 AS doc_id", "2 AS term")
    assert rows(lexical.search(clashing, items)) == brute([(r[0], r[1]) for r in listed], [(1, "One two; Lorem 日本語"), (2, "ünï end")])
    assert lexical.search(empty(spark), items).count() == 0
    assert lexical.search(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert lexical.search(docs, spark.createDataFrame([(1, "!!!"), (2, None)], ITEMS)).count() == 0
