"""Token ids of a corpus as binary blocks, and reading them back.

Ids are replaced by their rank in the corpus's own frequency order, so that
frequent ids are small numbers, and stored in one, two, three or four whole
bytes. The lengths stand apart: a control byte holds the lengths of four
numbers, two bits each. A block (one row of the Parquet files) holds whole
documents in ascending order of id:

* shard, block: place in the order of the whole corpus
* start: how many numbers the shard's earlier blocks hold
* doc_ids, counts: documents of the block and how many numbers each has
* control, data: control bytes, then data bytes of all numbers of the block

``ranks.parquet`` beside ``blocks.parquet`` holds the id of each rank. Reading
needs no loop over numbers: a table of 256 rows gives the four lengths of each
control byte, their running sum the offsets, and four masked gathers the numbers.

Parquet is only the container: it brings Spark's commit protocol, so that lost
executors and repeated tasks leave no half-written block, in any file store.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.llm.common import gather, per_process, slices, space_words
from tickframe.session import new_path

END_ID = 2
BLOCK_IDS = 1 << 19
SLICE = 32 << 20
JOINED_WORDS = 1 << 15
KNOWN_WORDS = 400_000
# Texts are cut into words here only if they hold nothing but these characters, whose classes are the same
# in every version of Unicode, and no two white-space characters of which the second is a space.
UNSURE = r"[^\t\n\r\x20-\x7e\x{a1}-\x{ac}\x{ae}-\x{24f}]|[\t\n\r ] "

LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)
OFFSETS = (np.cumsum(LENGTHS, axis=1) - LENGTHS).astype(np.int32)
TOTALS = LENGTHS.sum(axis=1, dtype=np.int32)


# ---- the coding

def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned numbers below 2^32."""
    n = len(numbers)
    padded = np.zeros(-(-n // 4) * 4, np.uint32)
    padded[:n] = numbers
    most = max(1, -(-int(padded.max(initial=0)).bit_length() // 8))
    more = np.zeros(len(padded), np.uint8)
    for k in range(1, most):
        more += padded >= 1 << 8 * k
    quads = more.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    wide = padded.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :most]
    data = wide[np.arange(most, dtype=np.uint8) <= more[:, None]]
    # The padding took one byte each at the end.
    return control.tobytes(), data[:len(data) - (len(padded) - n)].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``pack``, by table lookup."""
    codes = np.frombuffer(control, np.uint8)
    sizes = TOTALS[codes]
    starts = np.cumsum(sizes, dtype=np.int64 if len(data) >= 1 << 30 else np.int32) - sizes
    at = (starts[:, None] + OFFSETS[codes]).reshape(-1)[:n]
    lengths = LENGTHS[codes].reshape(-1)[:n]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        if len(more):
            out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# ---- tokens

class Tokens:
    """Ids of texts by the tokenizers library; byte-level vocabularies get equal words once.

    The pattern of such a vocabulary never lets a token hold a space after
    another character, so plain texts are cut before spaces and the different
    words go to the library, joined into one text that it cuts again at the
    same places. Texts with other characters or with a special token go to it
    whole, and so do all texts where the vocabulary is of another kind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        described = str(self.tokenizer.pre_tokenizer)
        self.by_words = described.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in described \
            and self.tokenizer.normalizer is None
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}
        self.flat, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # Tokens of such a vocabulary are spelled with one character per byte.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the bounds of each."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        return flat, np.r_[0, np.cumsum(sizes)]

    def spaced(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words, each after a space, and the bounds of each.

        A letter or digit never shares a token with ASCII punctuation after it,
        so the marks that a word ends with are encoded apart: fewer texts differ.
        """
        heads = pc.utf8_rtrim(words, characters=string.punctuation)
        marks = pc.subtract(pc.binary_length(words), pc.binary_length(heads)).to_numpy()
        cut = (marks > 0) & pc.match_substring_regex(heads, r"[\p{L}\p{N}]$").to_numpy(zero_copy_only=False)
        heads = pc.if_else(pa.array(cut), heads, words).dictionary_encode()
        rests, which = [""], np.zeros(len(words), np.int64)
        for n in np.unique(marks[cut]).tolist():
            at = np.flatnonzero(cut & (marks == n))
            ends = pc.utf8_slice_codeunits(words.take(pa.array(at)), -n).dictionary_encode()
            which[at] = len(rests) + ends.indices.to_numpy()
            rests += ends.dictionary.to_pylist()
        flat, bounds = self.remembered(heads.dictionary)
        own, own_bounds = self.whole(rests)
        at = np.stack([heads.indices.to_numpy().astype(np.int64), len(heads.dictionary) + which], axis=1)
        flat, bounds = np.concatenate([flat, own]), np.r_[bounds, own_bounds[1:] + len(flat)]
        sizes = (bounds[at + 1] - bounds[at]).sum(axis=1)
        return gather(flat, bounds, at.ravel()), np.r_[0, np.cumsum(sizes)]

    def remembered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Like ``joined``, which gets only words not seen by an earlier slice of the process.

        The first so many words are kept, frequent ones among them; the others
        are encoded again when they come again.
        """
        texts = words.to_pylist()
        at = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(at < 0)
        flat, bounds = self.joined(words.take(pa.array(new)))
        held = len(self.known)
        at[new] = held + np.arange(len(new))
        bounds = np.r_[self.bounds, len(self.flat) + bounds[1:]]
        flat = np.concatenate([self.flat, flat])
        keep = new[:max(0, KNOWN_WORDS - held)]
        if len(keep):
            self.known.update(zip([texts[k] for k in keep], range(held, held + len(keep))))
            self.bounds = bounds[:held + len(keep) + 1].copy()
            self.flat = flat[:self.bounds[-1]].copy()
        return gather(flat, bounds, at), np.r_[0, np.cumsum(bounds[at + 1] - bounds[at])]

    def joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Like ``spaced``, as a few long texts: words are told apart by the bytes of the tokens."""
        if len(words) > JOINED_WORDS:
            parts = [self.joined(words.slice(k, JOINED_WORDS)) for k in range(0, len(words), JOINED_WORDS)]
            shift = np.cumsum([0, *(len(f) for f, _ in parts)])
            return np.concatenate([f for f, _ in parts]), np.r_[0, np.concatenate([b[1:] + k for (_, b), k in zip(parts, shift)])]
        # Empty words and words that end in white space would run into the next word's space.
        odd = np.flatnonzero(pc.match_substring_regex(words, r"^$|[\t\n\r]$").to_numpy(zero_copy_only=False))
        sizes = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        text = words.to_pylist()
        alone = [" " + text[k] for k in odd]
        for k in odd:
            text[k], sizes[k] = "-", 2
        flat, _ = self.whole([" " + " ".join(text)])
        token_ends, ends = np.cumsum(self.sizes[flat]), np.cumsum(sizes)
        bounds = np.r_[0, np.searchsorted(token_ends, ends) + 1]
        if not np.array_equal(token_ends[bounds[1:] - 1], ends):
            return self.whole([" " + w for w in words.to_pylist()])
        if not len(odd):
            return flat, bounds
        own, own_bounds = self.whole(alone)
        place = np.arange(len(words))
        place[odd] = len(words) + np.arange(len(odd))
        every = np.r_[bounds, own_bounds[1:] + len(flat)]
        return gather(np.concatenate([flat, own]), every, place), np.r_[0, np.cumsum(every[place + 1] - every[place])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        unsure = pc.match_substring_regex(texts, UNSURE)
        for special in self.specials:
            unsure = pc.or_(unsure, pc.match_substring(texts, special))
        unsure = unsure.to_numpy(zero_copy_only=False) | (not self.by_words)
        out: list[np.ndarray] = [None] * len(texts)
        plain, rest = np.flatnonzero(~unsure), np.flatnonzero(unsure)
        if len(rest):
            flat, bounds = self.whole(texts.take(pa.array(rest)).to_pylist())
            for k, ids in zip(rest, np.split(flat, bounds[1:-1])):
                out[k] = ids
        if len(plain):
            codes, offsets, words = space_words(texts.take(pa.array(plain)))
            flat, bounds = self.spaced(words)
            # The first word of a text has no space before it.
            first, place = np.unique(codes[offsets[:-1]], return_inverse=True)
            own, own_bounds = self.whole(words.take(pa.array(first)).to_pylist())
            codes = codes.astype(np.int64)
            codes[offsets[:-1]] = len(words) + place
            flat, bounds = np.concatenate([flat, own]), np.r_[bounds, own_bounds[1:] + len(flat)]
            ends = np.r_[0, np.cumsum(bounds[codes + 1] - bounds[codes])][offsets]
            for k, ids in zip(plain, np.split(gather(flat, bounds, codes), ends[1:-1])):
                out[k] = ids
        return out


def width_of(path: str, end_id: int | None = END_ID) -> str:
    """Numpy type that holds all ids of the vocabulary."""
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id or 0) < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, path: str, end_id: int | None = END_ID, width: str = "<u4") -> DataFrame:
    """doc_id and ids (binary, of numpy type ``width``) of every whole text; null texts are empty."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_process(f"tokens {path}", lambda: Tokens(path))
        for batch in slices(batches, "text", SLICE):
            ids = tokens.encode(batch.column("text"))
            raw = [np.concatenate([x, tail]).astype(width).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("ids", "binary"))


# ---- writing and reading

def frequencies(tokens: DataFrame, width: str = "<u4") -> DataFrame:
    """id and count over all rows of column ``ids``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches, "ids", SLICE):
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").drop_null().to_pylist()), width), minlength=len(total))
            found[:len(total)] += total
            total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "count"])
    return tokens.select("ids").mapInArrow(count, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def write(tokens: DataFrame, path: str, block_ids: int = BLOCK_IDS, width: str = "<u4") -> None:
    """Writes (doc_id, ids; binary of numpy type ``width``) in ascending order of doc_id under ``path``.

    The ids of the whole vocabulary, most frequent first, are the only thing
    gathered (its size bounds them). Documents are dealt by range, so shards
    follow each other; a document never spans blocks. Documents of equal id
    are ordered by their ids; a null id comes first.
    """
    spark = tokens.sparkSession
    found = frequencies(tokens, width).withColumn("rank", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), "id")) - 1)
    found.select("rank", "id", "count").coalesce(1).write.parquet(f"{path}/ranks.parquet")
    ids = [r.id for r in spark.read.parquet(f"{path}/ranks.parquet").orderBy("rank").select("id").collect()]
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)

    each = np.dtype(width).itemsize

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        kept, size = [], 0

        def flush() -> pa.RecordBatch:
            numbers = ranks.value[np.concatenate([np.frombuffer(raw, width) for _, raw in kept])] if size else np.zeros(0, np.uint32)
            control, data = pack(numbers)
            row = {"shard": [shard], "block": [block], "start": [start], "doc_ids": [[d for d, _ in kept]],
                   "counts": [[len(raw) // each for _, raw in kept]], "control": [control], "data": [data]}
            return pa.RecordBatch.from_pydict(row, schema)
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                kept.append((doc_id, raw or b""))
                size += len(raw or b"") // each
                if size >= block_ids:
                    yield flush()
                    kept, size, block, start = [], 0, block + 1, start + size
        if kept:
            yield flush()
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
    dealt = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").withColumn("_tie", F.xxhash64("ids"))
    ordered = dealt.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "ids")
    kind = "shard int, block int, start long, doc_ids array<long>, counts array<long>, control binary, data binary"
    ordered.mapInArrow(code, kind).write.option("compression", "zstd").parquet(f"{path}/blocks.parquet")


def read(spark: SparkSession, path: str, checksums: bool = False) -> DataFrame:
    """doc_id, start (numbers of all documents before it) and ids (binary) of every document.

    With ``checksums``, n_tokens and ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) stand in the place of the ids.
    """
    blocks = spark.read.parquet(f"{path}/blocks.parquet")
    # One number per shard is gathered, as many as the write had tasks; blocks are read where they lie.
    held = F.col("start") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = sorted((r.shard, r.n) for r in blocks.groupBy("shard").agg(F.max(held).alias("n")).collect())
    before = dict(zip([s for s, _ in totals], np.cumsum([0, *(n for _, n in totals)]).tolist()))
    ids = [r.id for r in spark.read.parquet(f"{path}/ranks.parquet").orderBy("rank").select("id").collect()]
    known = spark.sparkContext.broadcast((np.array(ids, np.uint32), before))

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of, base = known.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                counts = np.array(one["counts"], np.int64)
                numbers = id_of[unpack(one["control"], one["data"], int(counts.sum()))].astype("<u4")
                ends = np.cumsum(counts)
                raw = [numbers[e - c:e].tobytes() for c, e in zip(counts.tolist(), ends.tolist())]
                starts = base[one["shard"]] + one["start"] + ends - counts
                if checksums:
                    made = {"n_tokens": pa.array(counts), "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64())}
                else:
                    made = {"ids": pa.array(raw, pa.binary())}
                yield pa.RecordBatch.from_arrays([pa.array(one["doc_ids"], pa.int64()), pa.array(starts), *made.values()],
                                                 ["doc_id", "start", *made])
    kind = "n_tokens long, ids_crc32 long" if checksums else "ids binary"
    return blocks.mapInArrow(open_, f"doc_id long, start long, {kind}")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encodes ``docs``, writes the blocks, reads them back: doc_id, start, n_tokens, ids_crc32.

    Null texts hold the end id only. Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "token-blocks")
    width = width_of(path)
    tokens = new_path(spark, "tokens")
    tokenize(docs, path, width=width).write.option("compression", "zstd").parquet(tokens)
    write(spark.read.parquet(tokens), folder, width=width)
    return read(spark, folder, checksums=True)
