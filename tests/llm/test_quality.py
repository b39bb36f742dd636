"""The quality classifier and the quality rules against plain reimplementations, and on held-out labels."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickframe.llm import quality_classifier, quality_rules, registry
from tickframe.llm.words import repeated_words

from ..conftest import SMALL
from .helpers import awkward, empty, words

ROOT = "/root/testdata/sf0.01"
SYMBOLS = "#*$%&|<>"


def base(text):
    text = text or ""
    found = words(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {k + j for k in range(len(found) - 2) if windows[tuple(found[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(found), sum(map(len, found)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


def bins(text):
    text = text or ""
    found = words(text)
    n = len(found)
    shares = [min(1, sum(c in SYMBOLS for c in text) / max(1, n)), base(text)[4] / max(1, n),
              sum(a == b for a, b in zip(found, found[1:])) / max(1, n - 1),
              max(Counter(found).values()) / n if n else 0]
    raw = text.encode()
    capitals, small = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    shares.append(capitals / max(1, capitals + small))
    cuts, step = quality_classifier.CUTS, len(quality_classifier.CUTS) + 2
    kind = sum(n >= c for c in quality_classifier.CLASSES)
    return [sum(n >= c for c in quality_classifier.LENGTHS)] + [1 + sum(s > c for c in cuts) + kind * step for s in shares]


def strength(sites):
    """sites: (good, n, rate above)."""
    seen = sum(n * (g / n - m) ** 2 for g, n, m in sites)
    real = (seen - sum(m * (1 - m) for _, _, m in sites)) / sum(n * m * (1 - m) for _, n, m in sites)
    return min(1e6, max(2.0, 1 / real - 1)) if real > 0 else 1e6


def brute(docs, labels):
    """doc_id -> evidence, host rate, path rate, probability."""
    marked = {d: bins(t) for d, t, _, _ in docs}
    known = [(labels[d], marked[d]) for d, *_ in docs if d in labels]
    n, good = len(known), sum(y for y, _ in known)
    counts = defaultdict(lambda: [0, 0])
    for y, b in known:
        for k, v in enumerate(b):
            counts[k, v][0] += y
            counts[k, v][1] += 1
    ratio = {kv: math.log((g + 4 * m / n) / (good + 4)) - math.log((m - g + 4 * m / n) / (n - good + 4)) for kv, (g, m) in counts.items()}
    rate = (good + 1) / (n + 2)
    evidence = {d: sum(ratio.get((k, v), 0) for k, v in enumerate(marked[d])) for d, *_ in docs}
    soft = {d: labels.get(d, 1 / (1 + math.exp(-(e + math.log(rate / (1 - rate)))))) for d, e in evidence.items()}
    hosts, paths = defaultdict(lambda: [0.0, 0]), defaultdict(lambda: [0.0, 0])
    for d, _, h, p in docs:
        for site in (hosts[h], paths[h, p]):
            site[0] += soft[d]
            site[1] += 1
    everywhere = sum(g for g, _ in hosts.values()) / sum(m for _, m in hosts.values())
    s = strength([(g, m, everywhere) for g, m in hosts.values()])
    host = {h: (g + s * everywhere) / (m + s) for h, (g, m) in hosts.items()}
    s = strength([(g, m, host[h]) for (h, _), (g, m) in paths.items()])
    path = {(h, p): (g + s * host[h]) / (m + s) for (h, p), (g, m) in paths.items()}
    return {d: (evidence[d], host[h], path[h, p], 1 / (1 + math.exp(-(evidence[d] + math.log(path[h, p] / (1 - path[h, p]))))))
            for d, _, h, p in docs}


def test_classifier_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    wanted = brute(docs, labels)
    got = registry.op5_quality_classifier(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.evidence, r.host_rate, r.path_rate, r.probability) == pytest.approx(wanted[r.doc_id], rel=1e-9)
        assert r.kept == (r.probability >= 0.5)


def test_sites_move_documents_of_weak_evidence(spark):
    texts = ["plain words of a text " + " ".join(f"w{i}x{k}" for k in range(60)) for i in range(300)]
    rows = [(i, t, "en", "bad" if i % 2 else "good", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labels).collect()}
    assert all(got[i].kept == (i % 2 == 0) for i in range(300))
    assert got[0].host_rate > 0.8 > 0.2 > got[1].host_rate


@pytest.mark.parametrize("judge", ["classifier", "rules"])
def test_held_out_labels(spark, judge):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    labels = spark.read.parquet(f"{ROOT}/labels.parquet")
    train, held = labels.filter("doc_id % 3 > 0"), {r.doc_id: r.quality for r in labels.filter("doc_id % 3 = 0").collect()}
    if judge == "classifier":
        got = {r.doc_id: r.kept for r in quality_classifier.classify(docs, train).collect()}
    else:
        got = {r.doc_id: r.probability >= 0.5 for r in quality_rules.verdicts(docs, train).collect()}
    good = [got[d] for d, q in held.items() if q]
    bad = [got[d] for d, q in held.items() if not q]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_base_rules_equal_brute_force(spark):
    docs, rows = awkward(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    extra = [(100, "word " * 49 + "end", None, None, 1), (101, " ".join(f"x{k}" for k in range(50)), None, None, 1),
             (102, " ".join(["a b c"] * 9 + [f"y{k}" for k in range(27)]), None, None, 1), (103, "%%% | " * 60, None, None, 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "1 AS n_words", "true AS kept")
    got = quality_rules.judge(docs, quality_rules.train(spark.read.parquet(f"{SMALL}/documents.parquet"), labels)).collect()
    texts = Counter((r[0], r[1]) for r in rows + extra)
    assert Counter((r.doc_id, r.text) for r in got) == texts
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.probability >= 0.5)


def test_rules_over_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = registry.op8_quality_rules(spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {d: base(t) for d, t in texts.items()}


def test_repeats_of_many_different_words():
    numbers = np.array([5, 1 << 22, 7, 5, 1 << 22, 7, 9])
    assert repeated_words(numbers) == 6 == repeated_words(np.array([0, 1, 2, 0, 1, 2, 3]))
    assert repeated_words(np.array([4, 4, 4, 4])) == 4 and repeated_words(np.array([4, 4, 4])) == 0


def test_scores_are_those_of_the_fitted_features():
    random = np.random.default_rng(0)
    texts = [b"one two two three", b"", b"  ", b"abc", "ünï cödé text".encode(), b"x y z w " * 50]
    weights = random.standard_normal((4, 1 << quality_rules.LOG_SIZE))
    grams = quality_rules.Grams(texts, quality_rules.Words())
    by_features = quality_rules.Part(grams.shares()).scores(weights)
    assert grams.scores(weights) == pytest.approx(by_features, abs=1e-5)


def test_runs_are_of_characters():
    def runs(text):
        bucket, lo, hi = list(quality_rules.Grams([text.encode()], quality_rules.Words()).places())[2]
        return list(bucket[lo[0]:hi[0]])
    assert len(runs("äöü")) == 1 and len(runs("日本語🙂")) == 2 and runs("xäöüx")[1:2] == runs("äöü")


def test_fit_is_bounded_by_bytes_and_by_one_text_per_id(spark):
    rows = [(i, ("good plain text here " if i % 2 else "bad awful junk there ") * 20) for i in range(400)]
    docs = spark.createDataFrame(rows + [(1, "zzz another text")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    models = [quality_rules.train(docs.repartition(k), labels) for k in (2, 5)]
    assert (models[0] == models[1]).all()
    assert quality_rules.train(docs, labels, sample_bytes=100) is None
    small = quality_rules.train(docs, labels, sample_bytes=20_000)
    assert small is not None and not (small == models[0]).all()


def test_calibration_is_monotone_and_close():
    random = np.random.default_rng(1)
    z = random.standard_normal(4000) * 3
    y = (random.random(4000) < quality_rules.logistic(0.7 * z + 1)).astype(float)
    assert quality_rules.platt(z, y) == pytest.approx((0.7, 1.0), abs=0.12)
    assert quality_rules.platt(z, np.ones(4000)) == (1.0, 0.0)


def test_without_labels_and_without_rows(spark):
    docs, rows = awkward(spark)
    labels = spark.createDataFrame([(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(r.kept and r.evidence == 0 for r in got)
    assert all(r.kept == (not r.base_failed) for r in quality_rules.verdicts(docs, labels).collect())
    assert quality_classifier.classify(empty(spark), labels).count() == 0 == quality_rules.verdicts(empty(spark), labels).count()


def test_stages_keep_columns_of_any_name(spark):
    docs, _ = awkward(spark)
    clashing = docs.selectExpr("*", "1 AS kept", "2 AS evidence", "3 AS n_words", "4 AS _bins")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for keep in (quality_classifier.kept, quality_rules.kept):
        out = keep(clashing, labels)
        assert out.columns == clashing.columns
        assert all((r.kept, r.evidence, r.n_words, r._bins) == (1, 2, 3, 4) for r in out.collect())
