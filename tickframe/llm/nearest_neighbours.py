"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, projected on their principal directions and turned
by a learned rotation that brings the signs closest to the projections
(iterative quantisation), on a bounded sample; every vector of the table gets
the signs as its code. Vectors without much structure need more bits than they
have dimensions for the distance of codes to tell near from far: at 64 bits half
of all rows lay in the radius that held the neighbours, at 256 about a twentieth. Index: a code is cut into substrings, and each substring
has its own table from value to rows. Search: of two codes within radius r one
substring differs in at most r / substrings bits (pigeonhole), so probing the
values that near in every table finds every code within the radius; the found
codes are checked, and their rows reranked by exact distance on the original
vectors in double precision.

The radius is learned with the codes: on held-out sample queries, the distance
of codes within which nearly all of their true nearest neighbours lie. Queries
with fewer neighbours than asked for in the radius search the whole table.

Rows are dealt into tiles of bounded size. A tile of the table is indexed once
per tile of queries it meets; no vector leaves a tile unless it is among the
nearest of a query there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.session import stage

NEIGHBOURS = 10
BITS = 256
SUBSTRINGS = 16
WORD = 64
SAMPLE = 4096
HELD_OUT = 128
TURNS = 40
COVERED = 0.98
TILE = 1 << 15


def usable(vector: str = "embedding") -> Column:
    """Not null, not zero, all components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


class Codes:
    """The learned coding; ``radius`` is the Hamming radius to search."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, neighbours: int = NEIGHBOURS, seed: int = 0):
        random = np.random.default_rng(seed)
        self.centre = sample.mean(axis=0)
        moved = sample - self.centre
        dims = sample.shape[1]
        values, directions = np.linalg.eigh(moved.T @ moved)
        kept = directions[:, np.argsort(-values)[:min(bits, dims)]]
        # More bits than dimensions: further random turns of the same projections.
        turns = []
        for k in range(-(-bits // kept.shape[1])):
            width = min(kept.shape[1], bits - k * kept.shape[1])
            projected = moved @ kept
            turn, _ = np.linalg.qr(random.standard_normal((kept.shape[1], kept.shape[1])))
            for _ in range(TURNS):
                u, _, w = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
                turn = (u @ w).T
            turns.append((kept @ turn)[:, :width])
        self.projection = np.hstack(turns)
        self.bits = bits
        self.radius = self._learn_radius(sample, neighbours)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of unsigned 64-bit numbers."""
        signs = np.zeros((len(vectors), -(-self.bits // WORD) * WORD), np.uint8)
        signs[:, :self.bits] = (vectors - self.centre) @ self.projection > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8")

    def _learn_radius(self, sample: np.ndarray, neighbours: int) -> int:
        queries = sample[:HELD_OUT]
        distance = ((queries ** 2).sum(1)[:, None] + (sample ** 2).sum(1)[None, :] - 2 * queries @ sample.T)
        distance[np.arange(len(queries)), np.arange(len(queries))] = np.inf
        near = np.argsort(distance, axis=1)[:, :min(neighbours, len(sample) - 1)]
        codes = self.of(sample)
        apart = differing(codes[:len(queries), None], codes[near])
        return int(np.quantile(apart, COVERED, method="higher")) if apart.size else self.bits


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which codes differ."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Index:
    """Substring tables of a tile's codes, rows of 64-bit numbers (or single numbers)."""

    def __init__(self, codes: np.ndarray, bits: int, substrings: int = SUBSTRINGS):
        codes = codes.reshape(len(codes), -1)
        self.codes, self.edges = codes, [bits * k // substrings for k in range(substrings + 1)]
        self.tables = []
        for lo, hi in zip(self.edges, self.edges[1:]):
            values = self._part(codes, lo, hi)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << hi - lo) + 1))))

    @staticmethod
    def _part(codes: np.ndarray, lo: int, hi: int) -> np.ndarray:
        word, shift = divmod(lo, WORD)
        part = codes[:, word] >> np.uint64(shift)
        if shift + hi - lo > WORD:
            part = part | codes[:, word + 1] << np.uint64(WORD - shift)
        return (part & np.uint64((1 << hi - lo) - 1)).astype(np.int64)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        found, code = np.zeros(len(self.codes), bool), np.atleast_1d(code)
        each = radius // (len(self.edges) - 1)
        for (order, starts), lo, hi in zip(self.tables, self.edges, self.edges[1:]):
            value = int(self._part(code[None], lo, hi)[0])
            # The probes: all values of this substring at most ``each`` bits off.
            probes = near_values(hi - lo, min(each, hi - lo)) ^ value
            sizes = starts[probes + 1] - starts[probes]
            probes, sizes = probes[sizes > 0], sizes[sizes > 0]
            if len(probes):
                ends = np.cumsum(sizes)
                found[order[np.arange(ends[-1]) + np.repeat(starts[probes] - (ends - sizes), sizes)]] = True
        rows = np.flatnonzero(found)
        return rows[differing(self.codes[rows], code) <= radius]


_NEAR: dict[tuple[int, int], np.ndarray] = {}


def near_values(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``most`` set."""
    if (width, most) not in _NEAR:
        if width <= 16:
            every = np.arange(1 << width)
            _NEAR[width, most] = every[np.bitwise_count(every) <= most]
        else:
            _NEAR[width, most] = np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(width), k)])
    return _NEAR[width, most]


def learn(vectors: DataFrame, bits: int, neighbours: int, sample: int, dims: int) -> Codes | None:
    """Codes from at most ``sample`` vectors, those whose ids hash lowest."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    return Codes(np.array([r.embedding for r in rows], float).reshape(len(rows), dims), bits, neighbours) if len(rows) > 1 else None


def _rank(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``count`` nearest, ties to the smaller id."""
    difference = vectors - query
    distance = np.sqrt((difference * difference).sum(axis=1))
    if len(distance) > 4 * count:
        kept = np.flatnonzero(distance <= np.partition(distance, count - 1)[count - 1])
    else:
        kept = np.arange(len(distance))
    order = kept[np.lexsort((ids[kept], distance[kept]))][:count]
    return order, distance[order]


def search(vectors: DataFrame, queries: Column, neighbours: int = NEIGHBOURS, bits: int = BITS, substrings: int = SUBSTRINGS,
           sample: int = SAMPLE, tile: int = TILE) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of each query's nearest rows.

    ``vectors`` has vec_id and embedding; rows where ``queries`` holds are
    searched for among all rows but themselves. Vectors that are null, zero or
    have null or non-finite components take no part, nor do those of another
    length than most, nor rows without id. Rows of equal id are rows of their
    own, but no neighbours of each other.
    """
    spark = vectors.sparkSession
    good = vectors.filter("vec_id IS NOT NULL").filter(usable())
    lengths = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    dims, total = lengths["n"], lengths["count"]
    good = good.filter(F.size("embedding") == dims).select(F.col("vec_id").cast("long").alias("vec_id"),
                                                           F.col("embedding").cast("array<double>").alias("embedding"), queries.alias("asked"))
    codes = learn(good, bits, neighbours, sample, dims)
    if codes is None:
        return empty

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("asked"), pa.array([c.tobytes() for c in codes.of(flat)], pa.binary()),
                 pa.array([v.tobytes() for v in flat], pa.binary())], ["vec_id", "asked", "code", "vector"])
    coded = stage(good.mapInArrow(encode, "vec_id long, asked boolean, code binary, vector binary"), "codes")
    asked_total = coded.filter("asked").count()
    # Tiles are of bounded size; a small table is still dealt to all cores.
    tiles = max(math.ceil(total / tile), min(spark.sparkContext.defaultParallelism, math.ceil(total / 512)))
    query_tiles = max(1, math.ceil(asked_total / tile))

    def dealt(count: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", "code", F.lit(salt)), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def meet(index: DataFrame, asked: DataFrame, radius: int) -> DataFrame:
        rows = index.withColumn("tile", dealt(tiles, "rows")).withColumn("part", every(query_tiles))
        sought = asked.withColumn("part", dealt(query_tiles, "queries")).withColumn("tile", every(tiles))

        def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple] = []
            if len(left) and len(right):
                ids, made = left.vec_id.to_numpy(), np.frombuffer(b"".join(left.code), "<u8").reshape(len(left), -1)
                table = np.frombuffer(b"".join(left.vector), float).reshape(-1, dims)
                tables = Index(made, bits, substrings) if radius < bits else None
                for query_id, code, vector in zip(right.vec_id, right.code, right.vector):
                    near = tables.within(np.frombuffer(code, "<u8"), radius) if tables else np.arange(len(ids))
                    near = near[ids[near] != query_id]
                    order, distance = _rank(np.frombuffer(vector, float), table[near], ids[near], neighbours)
                    out += zip([query_id] * len(order), ids[near[order]].tolist(), distance.tolist())
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        found = rows.groupBy("tile", "part").cogroup(sought.groupBy("tile", "part")) \
            .applyInPandas(nearest, "query_id long, vec_id long, score double")
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= neighbours)
    asked = coded.filter("asked").dropDuplicates(["vec_id", "code", "vector"])
    found = stage(meet(coded, asked, codes.radius), "neighbours")
    # Queries whose radius holds too few rows (in sparse regions) go over everything.
    enough = min(neighbours, total - 1)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= enough).select("query_id")
    sparse = asked.join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    if not sparse.isEmpty():
        again = meet(coded, sparse, bits)
        found = found.join(full, "query_id", "left_semi").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")
