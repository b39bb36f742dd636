"""Search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import nearest_neighbours, registry

from ..conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, vectors, asked, count=10):
    out = {}
    for q in asked:
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != ids[q]][:count]
        out[int(ids[q])] = [(int(ids[k]), distance[k]) for k in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("root", [SMALL, "/root/testdata/sf0.01"])
def test_recall_and_scores_over_the_table(spark, root):
    rows = spark.read.parquet(f"{root}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    wanted = brute(ids, vectors, np.flatnonzero(ids % 100 == 0))
    got = found(registry.op4_nearest_neighbours(spark, root))
    assert got.keys() == wanted.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in wanted[q]}) for q in got)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    at = {int(i): k for k, i in enumerate(ids)}
    for q, near in got.items():
        assert len(near) == len(wanted[q])
        for v, score in near:
            assert score == pytest.approx(np.sqrt(((vectors[at[v]] - vectors[at[q]]) ** 2).sum()), rel=1e-12)


def test_probing_finds_every_code_in_the_radius():
    random = np.random.default_rng(1)
    codes = random.integers(0, 2**64, 3000, dtype=np.uint64)
    codes[::3] = codes[0] ^ random.integers(0, 2**20, 1000, dtype=np.uint64)
    index = nearest_neighbours.Index(codes, 64)
    for radius in (0, 3, 7, 12, 31):
        wanted = np.flatnonzero(np.bitwise_count(codes ^ codes[0]) <= radius)
        assert np.array_equal(index.within(codes[0], radius), wanted)
    short = nearest_neighbours.Index(codes & np.uint64(0xFFFFFF), 24, 3)
    assert np.array_equal(short.within(np.uint64(5), 6), np.flatnonzero(np.bitwise_count(codes & np.uint64(0xFFFFFF) ^ np.uint64(5)) <= 6))


def test_codes_of_several_words():
    random = np.random.default_rng(2)
    codes = random.integers(0, 2**64, (2000, 4), dtype=np.uint64)
    codes[::2] = codes[0] ^ random.integers(0, 2**12, (1000, 4), dtype=np.uint64)
    apart = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
    for bits, substrings in ((256, 16), (256, 11), (200, 13)):
        index = nearest_neighbours.Index(codes, 256, substrings)
        for radius in (0, 10, 25, 40):
            assert np.array_equal(index.within(codes[0], radius), np.flatnonzero(apart <= radius))


def test_under_a_tenth_of_rows_is_reranked(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter(nearest_neighbours.usable()).collect()
    vectors = np.array([r.embedding for r in rows if len(r.embedding) == len(rows[0].embedding)], float)
    codes = nearest_neighbours.Codes(vectors[:nearest_neighbours.SAMPLE])
    made, asked = codes.of(vectors), np.arange(0, len(vectors), 40)
    distance = np.sqrt(((vectors[asked][:, None] - vectors[None]) ** 2).sum(axis=2))
    distance[np.arange(len(asked)), asked] = np.inf
    apart = nearest_neighbours.differing(made[asked][:, None], made[None])
    near = np.argsort(distance, axis=1)[:, :10]
    assert (apart <= codes.radius).mean() < 0.1
    assert (np.take_along_axis(apart, near, 1) <= codes.radius).mean() >= 0.95


def test_awkward_rows(spark):
    random = np.random.default_rng(0)
    rows = [(i, random.standard_normal(8).astype("float32").tolist(), 0) for i in range(1, 60)]
    rows += [(100 + i, rows[4][1], 0) for i in range(15)]
    bad = [(0, None, 0), (200, [0.0] * 8, 0), (300, [1.0] * 7 + [None], 0), (400, [float("nan")] * 8, 0),
           (500, [float("inf")] + [1.0] * 7, 0), (600, [1.0] * 3, 0), (None, [1.0] * 8, 0), (700, [], 0)]
    table = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "1 AS code", "2 AS tile")
    got = found(nearest_neighbours.search(table, F.col("vec_id") % 20 == 0, bits=16, tile=16))
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    wanted = brute(ids, vectors, np.flatnonzero(ids % 20 == 0))
    assert got.keys() == wanted.keys() == {20, 40, 100}
    # Copies are nearest, ties go to the smaller id, and the query itself is no neighbour.
    assert [v for v, _ in got[100]] == [5, *range(101, 110)]
    assert all(len(near) == 10 for near in got.values())


def test_few_rows_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 2.0], 0), (2, [3.0, 0.0], 0)], SCHEMA)
    assert [v for v, _ in found(nearest_neighbours.search(table, F.col("vec_id") == 0))[0]] == [2, 1]
    assert nearest_neighbours.search(table.limit(0), F.lit(True)).count() == 0
    assert nearest_neighbours.search(table.limit(1), F.lit(True)).count() == 0
