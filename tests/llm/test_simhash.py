"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tickframe.llm import components, registry, simhash

from ..conftest import SMALL
from .helpers import awkward, empty, words


def fingerprint(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[k:k + 3]) for k in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Sorted (doc_id, fingerprint, component) of (doc_id, text) rows."""
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    of = list(range(len(rows)))

    def root(x):
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            of[root(i)] = root(int(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, f"{int(fps[i]):016x}", least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def near_copies(n, seed=1):
    pick, base = random.Random(seed), [f"word{k}" for k in range(60)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(pick.randint(0, 2)):
            text[pick.randrange(60)] = f"z{pick.randint(0, 50)}"
        rows.append((i, " ".join(text)))
    return rows


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(registry.op2_simhash_near_dedup(spark, SMALL)) == brute(rows)


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    rows = [(r[0], r[1]) for r in rows]
    assert got(simhash.near_duplicates(docs.selectExpr("*", "1 AS fp", "2 AS root"))) == brute(rows)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_large_group_of_near_copies(spark):
    rows = near_copies(1500)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(simhash.near_duplicates(df)) == brute(rows)


@pytest.mark.parametrize("chunk", [5, 64])
def test_links_keep_components_whatever_the_chunks(spark, chunk):
    pick = random.Random(4)
    centres = [pick.getrandbits(64) for _ in range(3)]
    fps = {c for c in centres}
    while len(fps) < 300:
        fps.add(pick.choice(sorted(fps)) ^ sum({1 << pick.randrange(64) for _ in range(pick.randint(1, 4))}))
    fps = sorted(fps)
    array = np.array(fps, np.uint64)
    rows = [(int(x),) for x in array.view(np.int64)]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"), chunk=chunk)
    found = {r.node: r.root for r in components.components(edges).collect()}
    pairs = [(r.a, r.b) for r in edges.collect()]
    at = {int(x): k for k, x in enumerate(array.view(np.int64))}
    assert all(bin(fps[at[a]] ^ fps[at[b]]).count("1") <= 3 for a, b in pairs)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 3
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = int(array.view(np.int64)[i]), int(array.view(np.int64)[j])
        assert found[a] == found[b]


def spread(n, free=32, seed=6):
    """Fingerprints that agree in all but the lowest ``free`` bits, a third of them near another one."""
    pick, top = random.Random(seed), 0x9E3779B9 << 32
    made = {top | pick.getrandbits(free) for _ in range(2 * n // 3)}
    near = sorted(made)
    while len(made) < n:
        made.add(pick.choice(near) ^ sum({1 << pick.randrange(free) for _ in range(pick.randint(1, 4))}))
    return np.array(sorted(made), np.uint64)


def members(spark, fps, **how):
    return simhash.cell_members(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"), **how)


@pytest.mark.parametrize("free, n", [(32, 1500), (12, 800)])
def test_large_cells_are_cut_again(spark, free, n):
    array = spread(n, free)
    df = spark.createDataFrame([(int(x),) for x in array.view(np.int64)], "fp long")
    edges = simhash.links(df, chunk=6)
    found = {r.node: r.root for r in components.components(edges).collect()}
    for k, x in enumerate(array):
        for j in np.flatnonzero(np.bitwise_count(array[k + 1:] ^ x) <= 3) + k + 1:
            assert found[int(array.view(np.int64)[k])] == found[int(array.view(np.int64)[j])]
    for a, b in ((r.a, r.b) for r in edges.collect()):
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3


def test_copies_do_not_grow_with_the_square_of_a_cell(spark):
    copies = [members(spark, spread(n), chunk=6).count() / n for n in (500, 2000)]
    assert copies[1] < 1.5 * copies[0]


def test_bits_other_than_three(spark):
    array = spread(200, 14)
    for bits in (0, 1, 2):
        edges = simhash.links(spark.createDataFrame([(int(x),) for x in array.view(np.int64)], "fp long"), bits=bits, chunk=3)
        found = {r.node: r.root for r in components.components(edges).collect()}
        left, right = np.nonzero(np.triu(np.bitwise_count(array[:, None] ^ array[None, :]) <= bits, 1))
        signed = array.view(np.int64)
        assert all(found[int(signed[i])] == found[int(signed[j])] for i, j in zip(left, right))
        assert len(found) == len(set(left) | set(right))


def test_pivots_never_discard_a_link():
    random_bits = np.random.default_rng(0)
    fps = random_bits.integers(0, 2**64, 400, dtype=np.uint64)
    fps[200:] = fps[:200] ^ np.uint64(0b10110)
    table = simhash.pivot_table(fps, random_bits.integers(0, 2**64, 32, dtype=np.uint64))
    left, right = np.triu_indices(400, 1)
    alive = simhash.survivors(table, left, right, 3)
    linked = np.flatnonzero(np.bitwise_count(fps[left] ^ fps[right]) <= 3)
    assert set(linked) <= set(alive) and len(alive) < len(left) / 50


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)], [(i, 999) for i in range(100)], [(5, 5)],
    [(a, b) for a, b in zip(range(0, 60, 2), range(1, 60, 2))] + [(3, 8), (9, 58)]])
def test_components(spark, edges):
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    of = {n: n for e in edges for n in e}
    for _ in range(len(of)):
        changed = False
        for a, b in edges:
            low = min(of[a], of[b])
            changed |= of[a] != low or of[b] != low
            of[a] = of[b] = low
        if not changed:
            break
    assert found == of


def test_representatives_keep_one_row_per_group_and_all_columns(spark):
    docs, rows = awkward(spark)
    clashing = docs.selectExpr("*", "7 AS _fp", "8 AS root")
    kept = simhash.representatives(clashing).collect()
    groups = {}
    for d, _, c in brute([(r[0], r[1]) for r in rows]):
        groups.setdefault(c, set()).add(d)
    assert {r.doc_id for r in kept} == set(groups)
    assert all(r._fp == 7 and r.root == 8 for r in kept)
