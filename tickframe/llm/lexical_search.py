"""Ranked lexical search by buckets of vectors in the order of their length.

A document is a vector of impacts, one coordinate per term of the items: the
term's weight times its saturated frequency, an integer. An item is the set of
its terms, so a document's score is the sum of some of its coordinates.

Documents are dealt by range in the order of their vectors' length, longest
first, and every task cuts its range into buckets. An item leaves out a bucket

* whose longest vector, by Cauchy and Schwarz, cannot reach the item's threshold
  (the tenth score found so far), or
* whose largest coordinates do not add up to it.

Inside a bucket the item's coordinates are taken in the order of their largest
value. A document with none of the leading ones has only coordinates that do not
add up to the threshold, so only documents listed under a leading coordinate are
looked at. Their sum goes on over further coordinates until the largest values
of the rest are a small ``PART`` of the threshold, and those documents are left
whose sum plus the bound of the rest (largest values, or Cauchy and Schwarz over
what is left of the vector) reaches the threshold. Survivors are scored again in
64-bit integers. No bound leaves out a document that ties with the threshold.

Thresholds start from the best scores among about ``SEEDS`` of the longest vectors,
looked at where they lie, and grow within a task. Items are taken in blocks of at most ``BLOCK_TERMS`` terms (one item
of more terms is a block of its own); a block's terms, document counts and
thresholds are all that is sent to the tasks, whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import gather, running_totals, slices
from tickframe.session import stage

TOP = 10
BLOCK_TERMS = 1 << 18
BUCKET_ROWS = 2048
PART = 0.1
SEEDS = 8192
# Bounds are worked out in doubles; this is far more than their rounding errors.
SLACK = 1 + 1e-9
# Terms are runs of letters and digits of ASCII and of all characters beyond it; only A-Z are lower-cased.
FOLDED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLDED).split(b" ") if text else []


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the different terms of each item; repeated ids are one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                own = sorted(set(terms_of(text)) - {b""})
                ids += [item] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])
    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, term binary").distinct()


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), ids and tfs (terms of the vocabulary and how often each occurs) of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        width = len(known)
        for batch in slices(batches, "text"):
            n, hits = np.zeros(batch.num_rows, np.int64), []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = [w for w in terms_of(text) if w]
                n[i] = len(words)
                hits.append(np.array([known[w] for w in words if w in known], np.int64) + i * width)
            found, tfs = np.unique(np.concatenate(hits) if hits else np.zeros(0, np.int64), return_counts=True)
            bounds = np.searchsorted(found, np.arange(batch.num_rows + 1) * width).astype(np.int32)
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(bounds, pa.array((found % max(1, width)).astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array(tfs.astype(np.int64)))], ["doc_id", "n", "ids", "tfs"])
            yield rows.filter(pa.array(n > 0))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


def impacts(counts: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """doc_id, length, ids, xs: the vectors with a coordinate above 0, and their Euclidean length."""
    shared = counts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            ids, bounds = _flat(batch.column("ids"))
            tfs, _ = _flat(batch.column("tfs"))
            m = 10 + 90 * batch.column("n").to_numpy() * n_docs // n_terms
            x = w[ids] * (1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, np.diff(bounds))))
            squares = np.r_[0.0, np.cumsum(x.astype(np.float64) ** 2)]
            # Differences of running sums lose digits, so a vector's own squares are added.
            lengths = np.sqrt(np.array([(x[a:b].astype(np.float64) ** 2).sum() for a, b in zip(bounds, bounds[1:])]))
            keep = squares[bounds[1:]] > squares[bounds[:-1]]
            offsets = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.float64()), pa.ListArray.from_arrays(offsets, pa.array(ids)),
                 pa.ListArray.from_arrays(offsets, pa.array(x))], ["doc_id", "length", "ids", "xs"]).filter(pa.array(keep & (lengths > 0)))
    some = counts.filter(F.size("ids") > 0).select("doc_id", "n", "ids", "tfs")
    return some.mapInArrow(run, "doc_id long, length double, ids array<int>, xs array<long>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values one after the other, and the bounds of its rows."""
    return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]


class Bucket:
    """Vectors of about one length, also as lists per coordinate."""

    def __init__(self, docs: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray, xs: np.ndarray, bounds: np.ndarray, width: int):
        self.docs, self.known, self.lengths, self.ids, self.xs, self.bounds = docs, known, lengths, ids, xs, bounds
        order = np.argsort(ids, kind="stable")
        self.rows = np.repeat(np.arange(len(docs)), np.diff(bounds))[order]
        self.values = xs[order].astype(np.float64)
        self.lists = np.searchsorted(ids[order], np.arange(width + 1))
        self.largest = np.zeros(width)
        held = np.flatnonzero(np.diff(self.lists))
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.values, self.lists[held])
        self.longest = lengths.max(initial=0.0)

    def survivors(self, terms: np.ndarray, threshold: float) -> np.ndarray:
        """Rows that may score ``threshold`` or more with an item of ``terms``."""
        terms = terms[np.argsort(-self.largest[terms], kind="stable")]
        largest = self.largest[terms]
        # What is left after the first k coordinates.
        rest = np.r_[np.cumsum(largest[::-1])[::-1], 0.0]
        held = int((largest > 0).sum())

        def until(left: float) -> int:
            """How many coordinates to take for the rest to be under ``left``."""
            return min(held, int(np.searchsorted(-rest * SLACK, -left, side="right")))

        leading = until(threshold) if threshold > 0 else held
        if not leading:
            return np.zeros(0, np.int64)
        further = max(leading, until(threshold * PART)) if threshold > 0 else held
        listed = np.zeros(len(self.docs), bool)
        listed[gather(self.rows, self.lists, terms[:leading])] = True
        rows, values = gather(self.rows, self.lists, terms[:further]), gather(self.values, self.lists, terms[:further])
        partial = np.bincount(rows, values, len(self.docs))
        seen = np.flatnonzero(listed & ((partial + rest[further]) * SLACK >= threshold))
        # The same by what is left of the vector's length.
        left = self.lengths[seen] ** 2 - np.bincount(rows, values ** 2, len(self.docs))[seen]
        others = np.sqrt(np.maximum(left, 0) + 1e-9 * self.lengths[seen] ** 2) * math.sqrt(max(0, len(terms) - further))
        return seen[(partial[seen] + others) * SLACK >= threshold]

    def scores(self, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        sizes = np.diff(self.bounds)[rows]
        counted_in = np.isin(gather(self.ids, self.bounds, rows), terms)
        total = np.r_[np.int64(0), np.cumsum(np.where(counted_in, gather(self.xs, self.bounds, rows), 0))]
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]


class Best:
    """The ``top`` best of an item so far: highest score, then null ids, then least id."""

    def __init__(self, threshold: int, top: int):
        self.threshold, self.top = threshold, top
        self.scores, self.docs, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        good = (scores >= max(1, self.threshold))
        scores, docs, known = (np.concatenate(p) for p in ((self.scores, scores[good]), (self.docs, docs[good]), (self.known, known[good])))
        order = np.lexsort((docs, known, -scores))[:self.top]
        self.scores, self.docs, self.known = scores[order], docs[order], known[order]
        if len(order) == self.top:
            self.threshold = max(self.threshold, int(self.scores[-1]))


def _buckets(batches: Iterator[pa.RecordBatch], width: int, rows: int) -> Iterator[Bucket]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ids, bounds = _flat(part.column("ids"))
            xs, _ = _flat(part.column("xs"))
            docs = part.column("doc_id")
            yield Bucket(docs.fill_null(0).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False), part.column("length").to_numpy(),
                         ids, xs, bounds, width)


def best_of(vectors: DataFrame, items: list[tuple], thresholds: list[int], width: int, top: int = TOP,
            bucket_rows: int = BUCKET_ROWS, figures: bool = False) -> DataFrame:
    """item, doc_id, score: per task (rows in the order of length) each item's best that reach its threshold.

    ``items`` are (id, array of terms). With ``figures`` also buckets met and left out, and rows listed and rescored.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((items, thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, least = shared.value
        found = [Best(t, top) for t in least]
        flat = np.concatenate([t for _, t in wanted])
        starts = np.r_[0, np.cumsum([len(t) for _, t in wanted])[:-1]]
        roots = np.sqrt([len(t) for _, t in wanted])
        met = out = rescored = 0
        for bucket in _buckets(batches, width, bucket_rows):
            needed = np.array([max(1, b.threshold) for b in found], float)
            reach = np.minimum(roots * bucket.longest, np.add.reduceat(bucket.largest[flat], starts))
            met += len(wanted)
            open_items = np.flatnonzero(reach * SLACK >= needed)
            out += len(wanted) - len(open_items)
            for q in open_items:
                rows = bucket.survivors(wanted[q][1], found[q].threshold)
                rescored += len(rows)
                if len(rows):
                    found[q].add(bucket.scores(rows, wanted[q][1]), bucket.docs[rows], bucket.known[rows])
        sizes = [len(b.scores) for b in found]
        if figures:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (met, out, rescored)], ["met", "left_out", "rescored"])
        elif sum(sizes):
            known = np.concatenate([b.known for b in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(found)), sizes)), pa.array(np.concatenate([b.docs for b in found]), mask=~known),
                 pa.array(np.concatenate([b.scores for b in found]))], ["item", "doc_id", "score"])
    return vectors.mapInArrow(run, "met long, left_out long, rescored long" if figures else "item long, doc_id long, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _block(docs: DataFrame, pairs: list, top: int, seeds: int, bucket_rows: int, figures: bool = False) -> DataFrame | None:
    """Result of one block of items; None if no document holds a term."""
    spark = docs.sparkSession
    vocabulary = {t: k for k, t in enumerate(sorted({bytes(r.term) for r in pairs}))}
    by_item: dict = {}
    for r in pairs:
        by_item.setdefault(r.item_id, []).append(vocabulary[bytes(r.term)])
    items = [(item, np.array(sorted(t))) for item, t in by_item.items()]
    counts = stage(counted(docs, vocabulary), "term-counts")
    totals = counts.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    if not totals.n:
        return None
    # A row per term of the block.
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        weights[r.id] = math.floor(1000 * math.log((2 * totals.n + 2) / (2 * r["count"] + 1)))
    vectors = stage(impacts(counts, weights, totals.n, totals.terms), "impacts")
    # An approximate bound will do: any documents' scores make valid thresholds.
    cut = vectors.agg(F.percentile_approx("length", max(0.0, 1 - seeds / totals.n)).alias("cut")).first().cut
    longest = vectors.filter(F.col("length") >= F.lit(cut))
    first = ranked(best_of(longest, items, [0] * len(items), len(vocabulary), top, bucket_rows), top)
    thresholds = [0] * len(items)
    for r in first.filter(F.col("rank") == top).collect():
        thresholds[r.item] = r.score
    dealt = vectors.repartitionByRange(F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length"))
    found = best_of(dealt, items, thresholds, len(vocabulary), top, bucket_rows, figures)
    if figures:
        return found
    names = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(items)], "item long, item_id long")
    return ranked(found, top).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, *, block_terms: int = BLOCK_TERMS, seeds: int = SEEDS,
           bucket_rows: int = BUCKET_ROWS, figures: bool = False) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not
    looked at. Null and empty texts have no terms; rows of one item_id (null is one
    too) are one item with the terms of all of them. Every row of ``docs`` is a
    document, so a repeated row takes several ranks. Ties go to the least doc_id,
    nulls first. Items without a document get no row.
    """
    pairs = stage(_item_terms(items), "item-terms")
    sizes = pairs.groupBy("item_id").agg(F.count("*").alias("_n"))
    blocks = stage(running_totals(sizes, [], ["item_id"], {"_before": F.col("_n")}).select(
        "item_id", F.floor((F.col("_before") + F.col("_n")) / block_terms).cast("int").alias("_block")), "blocks")
    numbers = sorted(r[0] for r in blocks.select("_block").distinct().collect())
    found = []
    for number in numbers:
        own = blocks.filter(F.col("_block") == number).select(F.col("item_id").alias("_item"))
        terms = pairs.join(own, F.col("item_id").eqNullSafe(F.col("_item"))).select("item_id", "term").collect()
        block = _block(docs, terms, top, seeds, bucket_rows, figures)
        if block is not None:
            found.append(block)
    if found:
        return reduce(DataFrame.unionByName, found)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tfs AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term), totals GROUP BY item_id, r, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
