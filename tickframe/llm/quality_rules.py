"""Quality rules: fixed limits, and a calibrated logistic regression over hashed n-grams.

Features of a text are the shares of its hashed n-grams: single words, pairs of
words, and runs of three and of four characters. Pairs of equal words share one
feature, whatever the word. A score is then a mean of weights per kind of
n-gram, computed for whole Arrow batches by gathers and running sums.

The model is fitted in one task on labelled rows in the order of a hash of their
ids, at most ``sample`` of them and at most ``sample_bytes`` of text, so that the
task's work does not grow with the table. Three quarters of them fit the weights
and one quarter the calibration (Platt's sigmoid). Every text of the table is
scored whole. Where an id has several texts, the least by code point is fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import restore_names, set_names, slices
from tickframe.llm.words import IS_SPACE, IS_SYMBOL, Words, repeated_lines, repeated_words, sums
from tickframe.session import stage

SAMPLE = 4000
SAMPLE_BYTES = 16 << 20
LOG_SIZE = 15
KINDS = ("word", "pair", "three", "four")
STEPS = 80
LEAST_WORDS = 50
MOST_REPEATED = 50
THRESHOLD = 0.5
SLICE = 1 << 20
# A part of the features that the fit looks at together.
FIT_SLICE = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)
EQUAL_PAIR = 0


class Grams:
    """Hashed n-grams of a slice of texts."""

    def __init__(self, texts: list[bytes], words: Words):
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.byte_bounds = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
        self.words, self.word_bounds = words.of(texts)
        self.hashes = words.hashes

    def places(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per kind: bucket at each place, and where each text's places begin and end."""
        lo, hi = self.word_bounds[:-1], self.word_bounds[1:]
        hashed = self.hashes[self.words]
        yield self._bucket(hashed, 1), lo, hi
        pair = self._bucket(hashed[:-1] * np.uint64(3) + (hashed[1:] >> np.uint64(7)), 2)
        pair[self.words[:-1] == self.words[1:]] = EQUAL_PAIR
        yield pair, lo, np.maximum(lo, hi - 1)
        # Code points have 21 bits, so three of them make one number.
        wide = np.frombuffer(self.raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
        bounds = np.r_[0, np.cumsum(self.raw & 0xC0 != 0x80)][self.byte_bounds]
        lo, hi = bounds[:-1], bounds[1:]
        run = wide[:-2] | wide[1:-1] << np.uint64(21) | wide[2:] << np.uint64(42) if len(wide) > 2 else wide[:0]
        yield self._bucket(run, 3), lo, np.maximum(lo, hi - 2)
        run = run[:-1] * MIX + wide[3:] if len(wide) > 3 else wide[:0]
        yield self._bucket(run, 4), lo, np.maximum(lo, hi - 3)

    @staticmethod
    def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
        mixed = (codes + np.uint64(kind)) * MIX
        mixed = (mixed ^ mixed >> np.uint64(29)) * MIX
        return (mixed >> np.uint64(64 - LOG_SIZE)).astype(np.int32)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum over kinds of the mean weight of a text's n-grams, before the bias."""
        out = np.zeros(len(self.byte_bounds) - 1)
        for k, (bucket, lo, hi) in enumerate(self.places()):
            total = np.r_[0.0, np.cumsum(weights[k][bucket], dtype=np.float64)]
            # A text shorter than its n-gram may begin after the last place.
            lo, hi = np.minimum(lo, len(bucket)), np.minimum(hi, len(bucket))
            out += (total[hi] - total[lo]) / np.maximum(hi - lo, 1)
        return out

    def shares(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per kind, for fitting: different buckets of each text one after the other, their shares, their number per text."""
        out = []
        for bucket, lo, hi in self.places():
            found = [np.unique(bucket[a:b], return_counts=True) for a, b in zip(lo, hi)]
            values = [n / max(1, b - a) for (_, n), a, b in zip(found, lo, hi)]
            out.append((np.concatenate([f.astype(np.uint16) for f, _ in found]), np.concatenate(values).astype(np.float32),
                        np.array([len(f) for f, _ in found])))
        return out


class Part:
    """Features of some texts, with sums over texts and over buckets."""

    def __init__(self, kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.kinds = [(bucket, share, np.r_[0, np.cumsum(sizes)]) for bucket, share, sizes in kinds]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Per text, the sum of shares times weights."""
        out = 0.0
        for (bucket, share, bounds), w in zip(self.kinds, weights):
            total = np.r_[0.0, np.cumsum(share * w[bucket])]
            out = out + total[bounds[1:]] - total[bounds[:-1]]
        return out

    def add_slopes(self, errors: np.ndarray, into: np.ndarray) -> None:
        """Adds each text's error times its shares to the buckets."""
        for k, (bucket, share, bounds) in enumerate(self.kinds):
            into[k] += np.bincount(bucket, share * np.repeat(errors, np.diff(bounds)), into.shape[1])


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(parts: list[Part], labels: np.ndarray, holdout: np.ndarray) -> np.ndarray:
    """Weights of all features, then bias, then slope and offset of the calibration.

    Besides the parts themselves, memory is taken for one part at a time.
    """
    shape = (len(KINDS), 1 << LOG_SIZE)
    weights, bias = np.zeros(shape), 0.0
    ends = np.cumsum([len(p.kinds[0][2]) - 1 for p in parts])

    def scores() -> np.ndarray:
        return np.concatenate([p.scores(weights) for p in parts]) + bias

    first, second = np.zeros(weights.size + 1), np.zeros(weights.size + 1)
    for step in range(1, STEPS + 1):
        error = np.where(holdout, 0.0, logistic(scores()) - labels) / max(1, (~holdout).sum())
        slopes = 1e-6 * weights
        for part, own in zip(parts, np.split(error, ends[:-1])):
            part.add_slopes(own, slopes)
        slope = np.append(slopes, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        move = 0.8 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        weights, bias = weights - move[:-1].reshape(shape), bias - move[-1]
    z = scores()
    a, b = platt(z[holdout], labels[holdout])
    return np.concatenate([weights.ravel(), [bias, a, b]])


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logistic(slope * z + offset) a probability; Platt's smoothed targets."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = logistic(a * z + b)
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * z).sum(), (p - target).sum()])
        hessian = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 1 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> np.ndarray | None:
    """Model of at most ``sample`` labelled rows and ``sample_bytes`` of text; None if there are none of one class or the other.

    Labels are 0 or 1 in column quality; rows with null ids or labels are left
    out, of several labels or texts of a document the smallest counts.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id") \
        .agg(F.min("quality").alias("_quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = stage(known.orderBy(*order).limit(sample).withColumnRenamed("doc_id", "_id"), "labelled")
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
                  .groupBy("doc_id", "_quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "labelled-texts")
    # At most ``sample`` rows of two numbers.
    so_far = F.sum("_size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    within = texts.select("doc_id", F.octet_length("text").alias("_size")).withColumn("_total", so_far) \
        .filter(F.col("_total") <= sample_bytes).select(F.col("doc_id").alias("_id"))
    rows = texts.join(F.broadcast(within), F.col("doc_id") == F.col("_id")) \
        .select("doc_id", "_quality", "text", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3).alias("_holdout"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, y, holdout = [], [], []
        for batch in batches:
            for piece in slices([batch], "text", FIT_SLICE):
                parts.append(Part(Grams([t.encode() for t in piece.column("text").to_pylist()], Words()).shares()))
                y.extend(piece.column("_quality").to_pylist())
                holdout.extend(piece.column("_holdout").to_pylist())
        y, holdout = np.array(y, float) > 0, np.array(holdout, bool)
        if len(set(y[~holdout])) == 2:
            yield pa.RecordBatch.from_arrays([pa.array([fit(parts, y.astype(float), holdout).astype(np.float32).tobytes()])], ["model"])
    found = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(fitted, "model binary").collect()
    return np.frombuffer(found[0].model, np.float32) if found else None


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs), base_failed, probability, kept.

    Null texts have no words. Texts under 50 words, or with more than half of
    their words in repeated windows of three, fail the base rules. Of the others
    those are kept whose calibrated probability of being good reaches the
    threshold. Without a model (no labels) the base rules alone decide.
    """
    clash = {*BASE, "base_failed", "probability", "kept"}
    rest = [c for c in docs.columns if c.lower() not in clash]
    size = len(KINDS) << LOG_SIZE
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        found = shared.value
        for batch in slices(batches, "text", SLICE):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            grams = Grams(texts, words)
            bounds = grams.word_bounds
            n = np.diff(bounds)
            inside = ~IS_SPACE[grams.raw] & (grams.raw & 0xC0 != 0x80)
            chars = sums(inside.astype(np.int64), grams.byte_bounds)
            symbols = sums(IS_SYMBOL[grams.raw].astype(np.int64), grams.byte_bounds)
            lines = np.array([repeated_lines(t) for t in texts], np.int64)
            repeats = np.array([repeated_words(grams.words[a:b]) for a, b in zip(bounds, bounds[1:])], np.int64)
            failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * n)
            if found is None:
                chance = np.ones(len(texts))
            else:
                z = grams.scores(found[:size].reshape(len(KINDS), -1)) + found[size]
                chance = logistic(found[size + 1] * z + found[size + 2])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(x.astype(np.int64)) for x in (n, chars, symbols, lines, repeats)),
                 pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= threshold))],
                [*rest, *BASE, "base_failed", "probability", "kept"])
    schema = docs.select(rest).schema
    for name in BASE:
        schema = schema.add(name, "long")
    return docs.select(*rest).mapInArrow(run, schema.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean"))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document, without its text."""
    return judge(docs.select("doc_id", "text"), train(docs, labels)).drop("text")


def kept(docs: DataFrame, labels: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The documents that pass, with all their columns.

    The model is fitted on the labelled rows of ``known`` (by default ``docs``):
    where ``docs`` have been filtered by quality, too few bad ones are left in them.
    """
    named = set_names(docs, "doc_id", "text")
    model = train(docs if known is None else known, labels)
    return restore_names(judge(named, model).filter("kept"), docs, "doc_id", "text")
