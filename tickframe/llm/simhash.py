"""SimHash near-duplicates, with pivot distance tables.

Fingerprints of 64 bits link at a few differing bits. For a set of reference
fingerprints (pivots) the distances of each fingerprint are tabulated; by the
triangle inequality the coordinates of a linked pair differ by no more than the
allowed bits, so a pair with a larger difference in any coordinate is
discarded, and the survivors are verified.

Tables alone only discard pairs, they do not find them. Pairs come from cells
of fingerprints that agree in half of their bits: the 64 bits are cut into
twice as many blocks as bits may differ, so a linked pair agrees in at least
half of the blocks, whichever they are. A cell of chance agreements is tiny at
any size of corpus. A cell of more fingerprints than ``CHUNK`` times the choices
of blocks is cut again in the same way by the bits it leaves free, where all that
differs in a linked pair must lie; so after three cuts of three bits a cell has
nine free bits, and no more than 512 different fingerprints. Other cells are dealt
into chunks whose pairs are separate work, and only a spanning forest of the links
of each is kept. Copies of a fingerprint are thus bounded whatever a cell's size,
and no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.common import restore_names, set_names, slices
from tickframe.llm.components import components
from tickframe.session import stage

SHINGLE = 3
BITS = 3
SEED = 42
PIVOTS = 32
CHUNK = 256
SMALL = 12


def fingerprint_batch(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned fingerprints: each bit set in over half the hashes of the text's shingles."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    hash_of = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        # For bytes, lower() changes A-Z only and split() cuts at 20, 09-0D.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        n = max(len(words) - shingle + 1, 1 if words else 0)
        if not n:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][:n].tolist()
        stops = ends[-n:].tolist()
        hashes += [hash_of(joined[a:b], SEED) for a, b in zip(starts, stops)]
        counts[k] = n
    out = np.zeros(len(texts), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sizes = counts[filled]
        set_ = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
        out[filled] = np.packbits(2 * set_ > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = fingerprint_batch(batch.column("text").to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], [*batch.schema.names, out])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())]))


# ---- links

def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def survivors(table: np.ndarray, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs (left[i], right[i]) have no coordinate further apart than ``bits``; pivot by pivot."""
    alive = np.arange(len(left))
    for k in range(table.shape[1]):
        column = table[:, k]
        alive = alive[np.abs(column[left[alive]] - column[right[alive]]) <= bits]
    return alive


def forest(fps: np.ndarray, chunk: np.ndarray, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in a group; where it holds two chunks, of links between them."""
    n = len(fps)
    near = np.ones((n, n), bool)
    if chunk.min() != chunk.max():
        near = chunk[:, None] != chunk[None, :]
    # The first pivots discard most pairs densely, the others go over the pairs that are left.
    for k in range(min(6, table.shape[1])):
        near &= np.abs(table[:, k, None] - table[None, :, k]) <= bits
    left, right = np.nonzero(np.triu(near, 1))
    alive = survivors(table, left, right, bits)
    left, right = left[alive], right[alive]
    linked = np.bitwise_count(fps[left] ^ fps[right]) <= bits
    near[:] = False
    near[left[linked], right[linked]] = near[right[linked], left[linked]] = True
    a, b, seen = [], [], ~near.any(axis=0)
    while not seen.all():
        front = np.array([np.argmin(seen)])
        seen[front] = True
        while len(front):
            reached = np.flatnonzero(near[front].any(axis=0) & ~seen)
            a.append(front[near[np.ix_(front, reached)].argmax(axis=0)])
            b.append(reached)
            seen[reached] = True
            front = reached
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _cut(rows: DataFrame, width: int, bits: int) -> tuple[DataFrame, int, int]:
    """Cells of (fp, combo, key, rest) by one more cut of the ``width`` bits of ``rest``, the bits then free, and the choices of blocks.

    The chosen blocks join the key, the others are the next rest; where these are
    of different widths, leading zeros make up for it, in which all agree.
    """
    count = max(2 * bits, 2)
    edges = [width * k // count for k in range(count + 1)]
    blocks = [F.shiftrightunsigned("rest", lo).bitwiseAND(F.lit((1 << hi - lo) - 1 if hi - lo < 64 else -1).cast("long"))
              for lo, hi in zip(edges, edges[1:])]

    def packed(chosen: Iterable[int]) -> tuple[Column, int]:
        value, size = F.lit(0).cast("long"), 0
        for c in chosen:
            value = value.bitwiseOR(F.shiftleft(blocks[c], size))
            size += edges[c + 1] - edges[c]
        return value, size

    choices = list(combinations(range(count), count - bits))
    made = [(packed(chosen), packed(c for c in range(count) if c not in chosen)) for chosen in choices]
    held, free = (max(pair[side][1] for pair in made) for side in (0, 1))
    places = [F.struct(((F.col("combo") + 1) * len(choices) + k).alias("combo"), F.shiftleft("key", held).bitwiseOR(key).alias("key"), rest.alias("rest"))
              for k, ((key, _), (rest, _)) in enumerate(made)]
    cells = rows.select("fp", F.explode(F.array(*places)).alias("_p")).select("fp", "_p.combo", "_p.key", "_p.rest")
    return cells, free, len(choices)


def cell_members(fps: DataFrame, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """The members (fp) of each pair of chunks (one, two) of each cell (combo, key), with their own chunk.

    Every linked pair of fingerprints meets in at least one of them.
    """
    rows = fps.select("fp", F.lit(0).alias("combo"), F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    width, parts = 64, []
    while True:
        cells, width, choices = _cut(rows, width, bits)
        shared = cells.groupBy("combo", "key").agg(F.count("*").alias("_n")).filter("_n > 1") \
            .select(F.col("combo").alias("_c"), F.col("key").alias("_k"), "_n")
        same = (F.col("combo") == F.col("_c")) & (F.col("key") == F.col("_k"))
        # The last cut is reached where a cell of all there can be is small enough.
        last = 2 ** width <= choices * chunk
        if not last:
            shared = stage(shared, "cells")
        held = shared if last else shared.filter(F.col("_n") <= choices * chunk)
        chunks = held.select("_c", "_k", F.ceil(F.col("_n") / chunk).cast("int").alias("_chunks"))
        parts.append(cells.join(chunks.hint("merge"), same)
                     .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("_chunks")).cast("int"))
                     .withColumn("_other", F.explode(F.expr("sequence(0, _chunks - 1)")))
                     .select("combo", "key", F.least("chunk", "_other").alias("one"), F.greatest("chunk", "_other").alias("two"), "chunk", "fp"))
        if last:
            break
        large = shared.filter(F.col("_n") > choices * chunk).select("_c", "_k")
        if large.isEmpty():
            break
        rows = stage(cells.join(large, same, "left_semi"), "large-cells")
    return reduce(DataFrame.unionByName, parts)


def links(fps: DataFrame, bits: int = BITS, chunk: int = CHUNK, pivots: int = PIVOTS) -> DataFrame:
    """Pairs (a, b) that connect what links connect, among distinct fingerprints (column fp, signed long)."""
    # A cell's chunk pairs go to different tasks, which the join's own exchange would not do.
    pairs = cell_members(fps, bits, chunk).repartition("combo", "key", "one", "two").groupBy("combo", "key", "one", "two") \
        .agg(F.collect_list("fp").alias("fps"), F.collect_list("chunk").alias("chunks")).filter("size(fps) > 1")
    references = np.array([xxhash.xxh64_intdigest(str(k), SEED) for k in range(pivots)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, chunks = batch.column("fps"), batch.column("chunks")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            dealt = chunks.flatten().to_numpy(zero_copy_only=False)
            bounds = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
            table = pivot_table(flat, references)
            left, right, a, b = [], [], [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if hi - lo <= SMALL:
                    for i, j in combinations(range(lo, hi), 2):
                        left.append(i)
                        right.append(j)
                else:
                    i, j = forest(flat[lo:hi], dealt[lo:hi], table[lo:hi], bits)
                    a.append(flat[lo + i])
                    b.append(flat[lo + j])
            if left:
                i, j = np.array(left), np.array(right)
                alive = survivors(table, i, j, bits)
                i, j = i[alive], j[alive]
                linked = np.bitwise_count(flat[i] ^ flat[j]) <= bits
                a.append(flat[i[linked]])
                b.append(flat[j[linked]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])
    return pairs.select("fps", "chunks").mapInArrow(run, "a long, b long")


def fingerprint_groups(marked: DataFrame, fp: str = "fp", bits: int = BITS) -> DataFrame:
    """fp, root and component_id for each distinct fingerprint of ``marked`` (doc_id, fp)."""
    fps = stage(marked.groupBy(F.col(fp).alias("fp")).agg(F.min("doc_id").alias("_first")), "fingerprints")
    found = components(links(fps, bits))
    rooted = stage(fps.join(found, F.col("fp") == F.col("node"), "left")
                   .select("fp", "_first", F.coalesce("root", "fp").alias("root")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    return rooted.select("fp", "root").join(groups, "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document.

    Null and empty texts have fingerprint zero and link like any other; texts of
    fewer words than a shingle are one shingle. Repeated rows share a component.
    Null ids count as no id when the smallest is taken. Extra columns are ignored.
    """
    marked = stage(with_fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "marked")
    groups = fingerprint_groups(marked, bits=bits)
    return marked.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The document with the smallest id of each group, with the columns of ``docs``; one row each.

    Of rows of that id in a group one stays. A group without ids keeps one row.
    Texts are fingerprinted twice, and moved once, to their keys.
    """
    marked = stage(with_fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "marked")
    # A key that is never null joins and removes repeats with one exchange.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id")
    keepers = marked.join(fingerprint_groups(marked, bits=bits), "fp") \
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("root", key).agg(F.min("fp").alias("fp")).select("_id", "fp").distinct()
    again = with_fingerprints(set_names(docs, "doc_id", "text"), shingle).withColumn("_id", key)
    kept = again.join(keepers, ["_id", "fp"], "left_semi").dropDuplicates(["_id", "fp"])
    return restore_names(kept, docs, "doc_id", "text")
