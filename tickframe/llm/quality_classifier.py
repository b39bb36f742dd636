"""Quality of documents by hierarchical empirical Bayes.

Evidence of a document is a naive Bayes log-likelihood ratio over binned
signals of its whole text; the bins are counted over all labelled rows. Sites
add their own: the rate of good documents of a host is a Beta posterior around
the global rate, that of a path within a host a posterior around its host's
rate. How strongly a level shrinks is estimated from how much its rates spread
(method of moments), so sparse sites fall back on the level above. Rates come
from grouped sums over all documents, of labels where there are any and of the
evidence's own probability elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.common import fresh, restore_names, set_names, slices
from tickframe.llm.words import IS_SYMBOL, Words, repeated_words, sums
from tickframe.session import stage

# Shares from 0 to 1 are cut here; the same cuts serve all signals.
CUTS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)
LENGTHS = (1, 5, 10, 20, 50, 200)
# Shares of short texts jump, so each class of length has its own bins.
CLASSES = (10, 20, 50)
# A bin's counts are joined by so many documents that say nothing, shared by the bin's overall frequency.
NEUTRAL = 4.0
SIGNALS = ("length", "symbols", "repeats", "doubles", "top", "capitals")
THRESHOLD = 0.5
WEAKEST, STRONGEST = 2.0, 1e6


def signal_bins(texts: list[bytes], words: Words) -> np.ndarray:
    """Bins (texts x signals, int32) of the signals of whole texts."""
    numbers, bounds = words.of(texts)
    n = np.diff(bounds)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
    some = np.maximum(n, 1)
    capitals = sums(((raw >= 65) & (raw <= 90)).astype(np.int64), ends)
    small = sums(((raw >= 97) & (raw <= 122)).astype(np.int64), ends)
    equal = np.r_[numbers[1:] == numbers[:-1], False].astype(np.int64)[:len(numbers)]
    # A pair across two texts is not a pair.
    equal[bounds[1:][n > 0] - 1] = 0
    each = [numbers[a:b] for a, b in zip(bounds, bounds[1:])]
    shares = np.stack([
        np.minimum(sums(IS_SYMBOL[raw].astype(np.int64), ends) / some, 1),
        [repeated_words(w) / max(1, len(w)) for w in each],
        sums(equal, bounds) / np.maximum(n - 1, 1),
        [np.unique(w, return_counts=True)[1].max() / len(w) if len(w) else 0 for w in each],
        capitals / np.maximum(capitals + small, 1)])
    bins = np.searchsorted(np.array(CUTS), shares, side="left") + 1
    bins += np.searchsorted(np.array(CLASSES), n, side="right") * (len(CUTS) + 2)
    return np.vstack([np.searchsorted(np.array(LENGTHS), n, side="right"), bins]).T.astype(np.int32)


def with_bins(docs: DataFrame, out: str, carry: bool) -> DataFrame:
    """The columns of ``docs``, text only if ``carry``, and ``out``: array of bins."""
    rest = [c for c in docs.columns if carry or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches, "text", 1 << 20):
            bins = signal_bins([(t or "").encode() for t in batch.column("text").to_pylist()], words)
            made = pa.ListArray.from_arrays(np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1], bins.ravel())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), made], [*rest, out])
    fields = [*docs.select(rest).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]
    return docs.select(*dict.fromkeys([*rest, "text"])).mapInArrow(run, T.StructType(fields))


def _strength(sites: DataFrame, above: Column) -> float:
    """How many documents the level above is worth, from the spread of the sites' rates about it.

    Rates of sites with n documents spread by r(1-r)/n by chance and by
    r(1-r)/(strength+1) for real. One row is gathered.
    """
    spread = above * (1 - above)
    row = sites.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - above, 2)).alias("seen"),
        F.sum(spread).alias("chance"), F.sum(F.col("n") * spread).alias("weight")).first()
    if not row.weight:
        return STRONGEST
    real = (row.seen - row.chance) / row.weight
    return min(STRONGEST, max(WEAKEST, 1 / real - 1)) if real > 0 else STRONGEST


def likelihoods(marked: DataFrame) -> tuple[dict[tuple[int, int], float], float]:
    """Log-likelihood ratio of each (signal, bin), and the global rate of good documents.

    ``marked`` has label (1 or 0, null if unknown) and bins. Gathered are at most
    signals x bins rows. Bins met seldom or never are drawn to a ratio of one,
    whichever class is the larger.
    """
    labelled = marked.filter("label IS NOT NULL")
    counts = labelled.select("label", F.posexplode("bins").alias("signal", "bin")) \
        .groupBy("signal", "bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    good, n = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    ratios = {}
    for r in counts:
        neutral = NEUTRAL * r.n / n
        ratios[r.signal, r.bin] = math.log((r.good + neutral) / (good + NEUTRAL)) \
            - math.log((r.n - r.good + neutral) / (n - good + NEUTRAL))
    return ratios, (good + 1) / (n + 2)


class Model:
    """What the labels and all documents say: ratios of bins, and rates of sites."""

    def __init__(self, marked: DataFrame):
        """``marked`` has host, path, label (1, 0, null if unknown) and bins of every document; it is read several times."""
        self.ratios, rate = likelihoods(marked)
        prior = F.lit(math.log(rate / (1 - rate)))
        soft = F.coalesce(F.col("label").cast("double"), 1 / (1 + F.exp(-(self.evidence("bins") + prior))))
        paths = stage(marked.groupBy("host", "path").agg(F.sum(soft).alias("good"), F.count("*").alias("n")), "paths")
        hosts = paths.groupBy(F.col("host").alias("_h")).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        whole = hosts.agg(F.sum("good"), F.sum("n")).first()
        everywhere = F.lit(float(whole[0] / whole[1]) if whole[1] else rate)
        strength = _strength(hosts, everywhere)
        rated = stage(hosts.select("_h", ((F.col("good") + strength * everywhere) / (F.col("n") + strength)).alias("host_rate")), "hosts")
        sites = paths.join(rated, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
        strength = _strength(sites, F.col("host_rate"))
        path_rate = (F.col("good") + strength * F.col("host_rate")) / (F.col("n") + strength)
        self.sites = stage(sites.select("host", "path", "host_rate", path_rate.alias("path_rate")), "sites")

    def evidence(self, bins: str) -> Column:
        total = F.lit(0.0)
        for k in range(len(SIGNALS)):
            ratio = F.lit(0.0)
            for (signal, value), r in sorted(self.ratios.items()):
                if signal == k:
                    ratio = F.when(F.col(bins)[k] == value, F.lit(r)).otherwise(ratio)
            total = total + ratio
        return total

    def score(self, rows: DataFrame, host: str, path: str, bins: str, threshold: float) -> DataFrame:
        """Adds evidence, host_rate, path_rate, probability and kept to rows that have ``bins``."""
        h, p = fresh(rows, "_host", "_path")
        sites = self.sites.withColumnsRenamed({"host": h, "path": p})
        # Rates of 0 or 1 would drown any evidence.
        safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_rate")))
        return rows.withColumn("evidence", self.evidence(bins)) \
            .join(sites, F.col(host).eqNullSafe(F.col(h)) & F.col(path).eqNullSafe(F.col(p))).drop(h, p) \
            .withColumn("probability", 1 / (1 + F.exp(-(F.col("evidence") + F.log(safe / (1 - safe)))))) \
            .withColumn("kept", F.col("probability") >= threshold)


MADE = ("evidence", "host_rate", "path_rate", "probability", "kept")


def fit(binned: DataFrame, labels: DataFrame, host: str, path: str, bins: str) -> Model:
    """The model of documents with bins (doc_id, host, path and bins are read) and labels.

    Null labels and ids are left out, of several labels of a document the smallest counts.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")) \
        .agg(F.min((F.col("quality") > 0).cast("int")).alias("label"))
    narrow = binned.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), F.col(bins).alias("bins"))
    return Model(stage(narrow.join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id"), "marked"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without text, with evidence, host_rate, path_rate, probability and kept.

    ``labels`` has doc_id and quality (1 good, 0 bad). Null hosts and paths are
    sites of their own; null texts are empty. Without labels the evidence is 0,
    the rates one half, and all documents are kept. Columns of the result's
    names in ``docs`` are replaced.
    """
    plain = docs.drop(*(c for c in docs.columns if c.lower() in MADE))
    bins, = fresh(plain, "_bins")
    binned = stage(with_bins(plain, bins, carry=False), "signals")
    return fit(binned, labels, host, path, bins).score(binned, host, path, bins, threshold).select(*binned.drop(bins).columns, *MADE)


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are read twice, once to fit and once to judge, rather than written aside or moved.
    """
    names = ("doc_id", "text", "source", "lang")
    plain = set_names(docs, *names)
    binned = stage(with_bins(plain.select(*names), "_bins", carry=False), "signals")
    model = fit(binned, labels, "source", "lang", "_bins")
    judged = model.score(with_bins(plain, "_bins", carry=True), "source", "lang", "_bins", threshold)
    return restore_names(judged.filter("kept"), docs, *names)
