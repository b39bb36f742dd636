"""Toxicity: a linear classifier that is held to equal scores for swapped groups.

Evidence is which different words a text holds: each word without the marks
around it, and the first four and five characters of longer words. Counts per
piece of evidence and label, summed over the training rows by a grouped
aggregation, choose the ``FEATURES`` pieces that tell most (likelihood ratio).

A text that names a group of people should score as it would if it named
another. Of every training row that holds an identity term a counterfactual is
made, in which each term is replaced by the next one of its kind, and the fit
adds ``PENALTY`` times the squared difference of the two scores to the logistic
loss. Terms that merely occur beside abuse then cannot carry weight, as they
would in a plain classifier, and neutral mentions are not called toxic.

The fit takes one task on rows in the order of a hash of their ids, at most
``SAMPLE`` rows and ``SAMPLE_BYTES`` of text. Every whole text is scored, in Arrow
batches; what a word adds is looked up once per different word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import slices
from tickframe.session import stage

SAMPLE = 12_000
SAMPLE_BYTES = 48 << 20
FEATURES = 1024
LEAST_ROWS = 3
PENALTY = 4.0
RIDGE = 1e-4
STEPS = 400
KNOWN_WORDS = 200_000
HELD_OUT_PART = 5
# Counts that a task adds up before it hands them on.
HELD_COUNTS = 500_000
# Terms for groups of people, by kind; each is swapped for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("her", "his"), ("mothers", "fathers"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("africans", "europeans", "americans", "mexicans", "chinese", "indians"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("gays", "heterosexuals", "lesbians"),
    ("immigrants", "citizens", "refugees", "foreigners"), ("immigrant", "citizen", "refugee", "foreigner"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("ausländer", "deutsche", "flüchtlinge"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "extranjeros"),
)


def swaps(kinds: Sequence[Sequence[str]] = IDENTITY_TERMS) -> dict[str, str]:
    """Each term and the one that takes its place."""
    return {term: kind[(i + 1) % len(kind)] for kind in kinds for i, term in enumerate(kind)}


def bare(word: str) -> str:
    """The word in small letters without the marks around it."""
    word = word.lower()
    if word.isalnum():
        return word
    inner = [i for i, c in enumerate(word) if c.isalnum()]
    return word[inner[0]:inner[-1] + 1] if inner else ""


def evidence(word: str) -> list[str]:
    """The pieces of evidence of a bare word."""
    if not word:
        return []
    return [f"w {word}", *(f"{n} {word[:n]}" for n in (4, 5) if len(word) > n)]


def bare_words(text: str | None) -> set[str]:
    return {bare(w) for w in set((text or "").split())}


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, modulo five, is 0. Null ids are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_PART == 0, F.lit(False))


def in_held_out(doc_id: int) -> bool:
    """The same for one id."""
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_PART == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, toxic, text of at most ``sample`` labelled rows that are not held out, and at most ``sample_bytes`` of text.

    Rows with null ids or labels are left out. Of several labels of an id the
    largest counts, of several texts the least by code point; null texts are empty.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = stage(known.orderBy(*order).limit(sample).withColumnRenamed("doc_id", "_id"), "toxic-labels")
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
                  .groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "toxic-texts")
    # At most ``sample`` rows of two numbers.
    so_far = F.sum("_size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    within = texts.select("doc_id", F.octet_length("text").alias("_size")).withColumn("_total", so_far) \
        .filter(F.col("_total") <= sample_bytes).select(F.col("doc_id").alias("_id"))
    return texts.join(F.broadcast(within), F.col("doc_id") == F.col("_id")).select("doc_id", "toxic", "text")


def telling(rows: DataFrame, features: int = FEATURES, kinds: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[str]:
    """The pieces of evidence that tell most about the label, and the identity terms that occur."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            names, toxic = zip(*seen)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(toxic), pa.array(seen.values(), pa.int64())], ["piece", "toxic", "n"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen.update((p, toxic) for p in {p for w in bare_words(text) for p in evidence(w)})
                if len(seen) > HELD_COUNTS:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    per_label = rows.groupBy().agg(F.count_if("toxic").alias("_t"), F.count_if(~F.col("toxic")).alias("_f")).first()
    t, f = per_label
    if not t or not f:
        return []
    found = rows.select("text", "toxic").mapInArrow(counts, "piece string, toxic boolean, n long").groupBy("piece") \
        .agg(F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("b"))

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    n, a, b = t + f, F.col("a"), F.col("b")
    gain = (part(a, (a + b) * t / n) + part(b, (a + b) * f / n)
            + part(t - a, (n - a - b) * t / n) + part(f - b, (n - a - b) * f / n))
    terms = [f"w {term}" for kind in kinds for term in kind]
    best = found.filter(a + b >= LEAST_ROWS).orderBy(F.desc(gain), "piece").limit(features)
    named = found.filter(F.col("piece").isin(terms))
    return sorted({r.piece for r in best.select("piece").unionByName(named.select("piece")).collect()})


def fit(rows: list[np.ndarray], swapped: list[tuple[int, np.ndarray]], toxic: np.ndarray, width: int,
        penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias. ``rows`` hold each row's features, ``swapped`` the place of a row and its features after the swap."""
    def flat(lists):
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(lists)), sizes)

    ids, at = flat(rows)
    other_ids, other_at = flat([x for _, x in swapped])
    origin = np.array([i for i, _ in swapped], np.int64)
    weights, bias = np.zeros(width), 0.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, STEPS + 1):
        z = np.bincount(at, weights[ids], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic) / len(rows)
        gap = (z[origin] - np.bincount(other_at, weights[other_ids], len(swapped)) - bias) * 2 * penalty / max(1, len(swapped))
        pulled = error + np.bincount(origin, gap, len(rows))
        slope = np.bincount(ids, pulled[at], width) - np.bincount(other_ids, gap[other_at], width) + RIDGE * weights
        slope = np.append(slope, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        move = 0.1 * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, features: int = FEATURES,
          penalty: float = PENALTY, kinds: Sequence[Sequence[str]] = IDENTITY_TERMS) -> tuple[dict[str, float], float]:
    """Weights by piece of evidence, and the bias. Without rows of both labels there are no weights, and the bias says the share of toxic rows."""
    rows = stage(training_rows(docs, labels, sample, sample_bytes), "toxic-sample")
    pieces = {p: k for k, p in enumerate(telling(rows, features, kinds))}
    partner = swaps(kinds)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(words: set[str]) -> np.ndarray:
            return np.array(sorted({pieces[p] for w in words for p in evidence(w) if p in pieces}), np.int64)

        found, others, toxic = [], [], []
        for batch in batches:
            for piece in slices([batch], "text"):
                for text, label in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                    words = bare_words(text)
                    if not words.isdisjoint(partner):
                        others.append((len(found), numbers({partner.get(w, w) for w in words})))
                    found.append(numbers(words))
                    toxic.append(label)
        if pieces:
            weights, bias = fit(found, others, np.array(toxic, float), len(pieces), penalty)
        else:
            share = (sum(toxic) + 1) / (len(toxic) + 2)
            weights, bias = np.zeros(0), float(np.log(share / (1 - share)))
        yield pa.RecordBatch.from_arrays([pa.array([np.append(weights, bias).tobytes()], pa.binary())], ["model"])

    made = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(fitted, "model binary").first()
    model = np.frombuffer(made.model) if made else np.zeros(1)
    return dict(zip(pieces, model[:-1].tolist())), float(model[-1])


def score(docs: DataFrame, model: tuple[dict[str, float], float]) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from a score of 0.5 on); columns of these names are replaced.

    Null and empty texts have the score of no evidence.
    """
    rest = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known: dict[str, tuple[str, ...]] = {}
        for batch in slices(batches, "text"):
            chances = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column("text").to_pylist()):
                if len(known) > KNOWN_WORDS:
                    known.clear()
                pieces: set[str] = set()
                for word in set((text or "").split()):
                    own = known.get(word)
                    if own is None:
                        own = known[word] = tuple(p for p in evidence(bare(word)) if p in weights)
                    pieces.update(own)
                chances[i] = bias + sum(weights[p] for p in sorted(pieces))
            chances = 1 / (1 + np.exp(-np.clip(chances, -40, 40)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(chances), pa.array((chances >= 0.5).astype(np.int32))],
                                             [*rest, "score", "predicted"])
    schema = docs.select(rest).schema.add("score", "double").add("predicted", "integer")
    return docs.select(*rest).mapInArrow(run, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    judged = score(docs.select("doc_id", "text"), train(docs, labels))
    return judged.select("doc_id", held_out().alias("held_out"), "score", "predicted")
