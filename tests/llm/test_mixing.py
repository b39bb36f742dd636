"""Mixing: targets by the stated rule, words taken against the drawn blocks."""

import random
from collections import Counter

import pytest

from tickframe.llm import mixing, registry

from ..conftest import SMALL
from .helpers import awkward, empty, words


def shared(sizes):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        heavy = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / heavy for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def check(docs_rows, got_rows, tolerance):
    sizes, of = Counter(), {}
    for d, t, s in docs_rows:
        sizes[s] += len(words(t))
        of.setdefault(d, []).append((len(words(t)), s))
    wanted = shared(sizes)
    taken = Counter()
    for r in got_rows:
        assert any(r.size == n and r.source_size == sizes[s] and r.target == pytest.approx(wanted[s]) for n, s in of[r.doc_id])
        assert 0 <= r.taken <= 3 * r.size
        s = next(s for n, s in of[r.doc_id] if n == r.size and sizes[s] == r.source_size)
        taken[s] += r.taken
    assert len(got_rows) == len(docs_rows)
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= tolerance * mixing.BLOCK_WORDS


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = registry.op7_source_mixing(spark, SMALL).collect()
    check(rows, got, 2)
    assert sorted(got) == sorted(registry.op7_source_mixing(spark, SMALL).collect())


def test_capped_sources(spark):
    # The first source is small and heavy, so it stops at three times its size.
    rows = [(i, "w " * 300, "a") for i in range(5)] + [(10 + i, "w " * 900, "b" if i % 2 else "c") for i in range(40)]
    rows += [(90, "v " * 40, None), (91, "", "d"), (92, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, mixing.document_shares(docs).collect(), 3)


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = mixing.document_shares(docs.selectExpr("*", "1 AS size", "2 AS offset", "3 AS target"))
    check([(r[0], r[1], r[3]) for r in rows], got.collect(), 3)
    assert mixing.document_shares(empty(spark)).count() == 0
    assert [r.taken for r in mixing.document_shares(spark.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")).collect()] == [0]


def test_slots_spans_and_texts_agree(spark):
    pick = random.Random(3)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(pick.randint(0, 400))), f"s{pick.choice([0, 0, 0, 1, 2])}", i) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    options = {"block": 16, "slots": 64}
    documents, spans, slots = mixing.mix(docs, **options)
    drawn = Counter((r.source, r.block) for r in slots.collect())
    assert max(drawn.values()) <= 3
    # Slots are gapless in their shards, blocks of an epoch are drawn once.
    places = sorted((r.shard, r.slot) for r in slots.collect())
    for shard in {s for s, _ in places}:
        inside = [k for s, k in places if s == shard]
        assert len(set(inside)) == len(inside) <= 64 and max(inside) < 64
    assert len(Counter((r.source, r.epoch, r.block) for r in slots.collect())) == sum(drawn.values())
    stream = {}
    offsets = {r.doc_id: r.offset for r in documents.collect()}
    for i, text, source, _ in sorted(rows, key=lambda r: (r[2], offsets[r[0]])):
        stream.setdefault(source, []).extend(words(text))
    wanted = Counter()
    for (source, block), n in drawn.items():
        for w in stream[source][16 * block:16 * block + 16]:
            wanted[w] += n
    texts = Counter(w for r in mixing.mixed_documents(docs, **options).collect() for w in words(r.text))
    assert texts == wanted
    taken = {r.doc_id: r.taken for r in mixing.document_shares(docs, **options).collect()}
    per_doc = Counter()
    for w, n in wanted.items():
        per_doc[int(w[1:w.index("w")])] += n
    assert all(taken[i] == per_doc[i] for i, *_ in rows)


def test_hot_source(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', 50) AS text", "if(id < 4000, 'hot', concat('s', id % 7)) AS source")
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], mixing.document_shares(docs).collect(), 3)
