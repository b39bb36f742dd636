"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes one string with word marks in the place of spaces. It is cut
where no piece of the vocabulary reaches across: merges never cross a cut, so
each part ("word") may be merged by itself, and equal words once. The words
not seen before are laid out as one flat numpy array of symbols. A round finds
the best pair rank of each word (a segmented minimum), merges all its leftmost
occurrences at once, compacts the arrays, and goes on until no word has a pair.

Merging all occurrences at once equals merging one by one unless the merged
piece may join on into a piece that ranks as high or higher; for such pieces
(known from the vocabulary) only the leftmost occurrence of a word is merged
in a round.

Vocabularies of kind BPE with identity normalisation, a dummy prefix and byte
fallback are read from the model file; others are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickframe.llm.common import Numbered, gather, per_process, slices, space_words

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
NO_RANK = np.int32(2**31 - 1)
SLICE = 4 << 20
LONG_PART = 1024


class Vocabulary:
    """Tables made from a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.add_dummy_prefix or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix \
                or not norm.escape_whitespaces or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with identity normalisation, dummy prefix and byte fallback")
        self.pieces = [p.piece for p in model.pieces]
        scores = np.array([p.score for p in model.pieces])
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes_at = np.zeros(256, np.int32)
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes_at[value] = i
                self.surface.append(bytes([value]))
            elif p.type == UNKNOWN:
                self.surface.append(trainer.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        self.marked = [p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces]
        self.control = [p.type == CONTROL for p in model.pieces]
        self.controls = [i for i, c in enumerate(self.control) if c]
        # Single characters, by code point; other characters get numbers past the vocabulary.
        self.single = {p: i for p, i in normal.items() if len(p) == 1}
        chars = sorted((ord(p), i) for p, i in self.single.items())
        self.char_codes, self.char_ids = (np.array(x, np.int64) for x in zip(*chars))
        # Ranks of merged pieces: 0 is best, equal scores share a rank.
        order = np.unique(-scores[sorted(normal.values())])
        self.rank = np.full(len(scores), NO_RANK, np.int32)
        ids = np.array(sorted(normal.values()))
        self.rank[ids] = np.searchsorted(order, -scores[ids]).astype(np.int32)
        pairs, self.greedy = {}, np.zeros(len(scores), bool)
        adjacent = set()
        for piece, i in normal.items():
            adjacent.update(zip(piece, piece[1:]))
            for k in range(1, len(piece)):
                left, right = normal.get(piece[:k]), normal.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
                # A part that ranks no better than the whole may have to join on at once.
                for part in (left, right):
                    if part is not None and self.rank[part] >= self.rank[i]:
                        self.greedy[part] = True
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.adjacent = np.array(sorted(ord(a) << 32 | ord(b) for a, b in adjacent), np.int64)
        # Open-addressed table of the pairs: one probe finds nearly all.
        self.mask = (1 << 20) - 1
        self.slots = np.full(self.mask + 1, -1, np.int64)
        where = self._slot(self.pair_keys)
        for at, k in sorted(zip(where.tolist(), range(len(where)))):
            while self.slots[at] >= 0:
                at = at + 1 & self.mask
            self.slots[at] = k
        self.pair_keys_pad = np.append(self.pair_keys, -1)
        self.crossing = any(MARK in p.lstrip(MARK) for p in normal)
        self.word = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if not self.crossing else re.compile(".+", re.S)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.int64) & self.mask

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair of symbols makes, -1 if none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.slots[at]
            hit = self.pair_keys_pad[found] == keys[open_]
            out[open_[hit]] = self.pair_ids[found[hit]]
            on = (found >= 0) & ~hit
            open_, at = open_[on], at[on] + 1 & self.mask
        return out

    def words(self, text: str) -> list[str]:
        return self.word.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words, and where each begins (one more bound than words)."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        symbol = np.where(self.char_codes[at] == codes, self.char_ids[at], len(self.pieces) + codes)
        # Parts: cut between words, and between characters that no piece holds side by side.
        cut = np.ones(len(codes), bool)
        if len(codes) > 1:
            side = codes[:-1] << 32 | codes[1:]
            k = np.minimum(np.searchsorted(self.adjacent, side), len(self.adjacent) - 1)
            cut[1:] = (self.adjacent[k] != side) | (owner[1:] != owner[:-1])
        part = np.cumsum(cut) - 1
        starts = np.flatnonzero(cut)
        first_owner = owner[starts]
        sizes = np.diff(np.r_[starts, len(cut)])
        long = sizes > LONG_PART
        if long.any():
            apart = np.repeat(long, sizes)
            made = [self._merge(symbol[~apart], part[~apart])]
            made += [self._merge_long(symbol[starts[k]:starts[k] + sizes[k]], k) for k in np.flatnonzero(long)]
            symbol, part = (np.concatenate(x) for x in zip(*made))
            order = np.argsort(part, kind="stable")
            symbol, part = symbol[order], part[order]
        else:
            symbol, part = self._merge(symbol, part)
        owner = first_owner[part]
        # Characters out of the vocabulary become their bytes.
        if (symbol >= len(self.pieces)).any():
            symbol, owner = self._fall_back(symbol, owner)
        bounds = np.searchsorted(owner, np.arange(len(words) + 1))
        return symbol.astype(np.int32), bounds

    def _fall_back(self, symbol: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.flatnonzero(symbol >= len(self.pieces))
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in (symbol[out] - len(self.pieces)).tolist()]
        counts = np.ones(len(symbol), np.int64)
        counts[out] = [len(b) for b in raw]
        starts = np.cumsum(counts) - counts
        wide = np.repeat(symbol, counts)
        places = np.repeat(starts[out], counts[out]) + np.concatenate([np.arange(len(b)) for b in raw])
        wide[places] = self.bytes_at[np.frombuffer(b"".join(raw), np.uint8)]
        return wide, np.repeat(owner, counts)

    def _merge(self, symbol: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = np.arange(len(symbol))
        piece = self._pairs(symbol, part, np.arange(len(symbol)))
        while len(symbol):
            rank = np.where(piece >= 0, self.rank[piece], NO_RANK)
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            sizes = np.diff(np.r_[starts, len(part)])
            best = np.minimum.reduceat(rank, starts)
            # Parts without a pair are finished and leave.
            alive = best < NO_RANK
            if not alive.all():
                keep = np.repeat(alive, sizes)
                done.append((place[~keep], symbol[~keep], part[~keep]))
                symbol, part, place, piece, rank = (a[keep] for a in (symbol, part, place, piece, rank))
                best, sizes = best[alive], sizes[alive]
                if not len(symbol):
                    break
                starts = np.cumsum(sizes) - sizes
            hit = rank == np.repeat(best, sizes)
            spots = np.flatnonzero(hit)
            greedy = self.greedy[piece[spots]]
            if greedy.any():
                spots = self._leftmost_only(spots, greedy, part)
            # Of touching occurrences (x x x) take every other one from the left.
            first = np.r_[True, np.diff(spots) != 1]
            run = np.maximum.accumulate(np.where(first, np.arange(len(spots)), 0))
            spots = spots[(np.arange(len(spots)) - run) % 2 == 0]
            symbol[spots] = piece[spots]
            keep = np.ones(len(symbol), bool)
            keep[spots + 1] = False
            moved = np.cumsum(keep) - 1
            symbol, part, place, piece = symbol[keep], part[keep], place[keep], piece[keep]
            changed = moved[spots]
            touched = np.zeros(len(symbol), bool)
            touched[changed] = touched[np.maximum(changed - 1, 0)] = True
            near = np.flatnonzero(touched)
            piece[near] = self._pairs(symbol, part, near)
        if not done:
            return symbol, part
        place, symbol, part = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        return symbol[order], part[order]

    def _merge_long(self, symbol: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """One long part without cuts (a long run of spaces): rounds would be many, so a heap of pairs."""
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = symbol.tolist()
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] < n]
            made = self.merged(np.array([now[i] for i in lefts], np.int64), np.array([now[after[i]] for i in lefts], np.int64))
            for i, m in zip(lefts, made.tolist()):
                if m >= 0:
                    heapq.heappush(heap, (int(self.rank[m]), i, m, now[i], now[after[i]]))
        offer(list(range(n)))
        while heap:
            _, i, m, left, right = heapq.heappop(heap)
            j = after[i]
            if now[i] != left or j >= n or now[j] != right:
                continue
            now[i], now[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer([before[i], i])
        out = np.array([x for x in now if x >= 0], np.int64)
        return out, np.full(len(out), part)

    def _leftmost_only(self, spots: np.ndarray, greedy: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Drops all but the first spot of parts that have a greedy one."""
        of = part[spots]
        first = np.r_[True, of[1:] != of[:-1]]
        group = np.cumsum(first) - 1
        wary = np.logical_or.reduceat(greedy, np.flatnonzero(first))[group]
        return spots[first | ~wary]

    def _pairs(self, symbol: np.ndarray, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Merged piece of each symbol at ``at`` and the next one, -1 if none or the part ends."""
        out = np.full(len(at), -1, np.int32)
        inner = at + 1 < len(symbol)
        inner[inner] = part[at[inner]] == part[at[inner] + 1]
        i = at[inner]
        out[inner] = self.merged(symbol[i], symbol[i + 1])
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``: the dummy prefix goes, bad byte runs become replacement marks."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        lead = next((i for i in ids if not self.control[i]), None)
        if lead is not None and self.marked[lead]:
            raw = raw[1:]
        strip = lead is not None and self.marked[lead]
        # Bytes on the two sides of a control piece never make one character.
        if any(c in ids for c in self.controls):
            return self._decode_runs(ids, strip)
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_runs(ids, strip)

    def _decode_runs(self, ids: list[int], strip: bool) -> str:
        out, run = [], bytearray()

        def flush():
            while run:
                for n in range(1, 5):
                    try:
                        out.append(bytes(run[:n]).decode("utf-8"))
                        del run[:n]
                        break
                    except UnicodeDecodeError:
                        if n >= min(4, len(run)):
                            out.append("�")
                            del run[:1]
                            break
        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                flush()
                out.append(self.surface[i].decode())
        flush()
        return "".join(out)[strip:]


class Encoder:
    """Encodes texts of a slice together; equal words are merged once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        # Between single spaces a word is what stands after its mark; runs of marks are cut with care.
        runs = pc.match_substring_regex(texts, f"^ |  |{MARK}").to_numpy(zero_copy_only=False) | self.vocabulary.crossing
        filled = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
        plain, rest = np.flatnonzero(filled & ~runs), np.flatnonzero(filled & runs)
        if len(plain):
            codes, offsets, words = space_words(texts.take(pa.array(plain)))
            self._fill(out, plain, codes, offsets, [MARK + w for w in words.to_pylist()])
        if len(rest):
            known = Numbered()
            split = [self.vocabulary.words(t) for t in texts.take(pa.array(rest)).to_pylist()]
            codes = np.concatenate([np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in split])
            self._fill(out, rest, codes, np.r_[0, np.cumsum([len(w) for w in split])], known.new)
        return out

    def _fill(self, out: list, places: np.ndarray, codes: np.ndarray, offsets: np.ndarray, words: list[str]) -> None:
        flat, bounds = self.vocabulary.encode_words(words)
        ends = np.r_[0, np.cumsum(bounds[codes + 1] - bounds[codes])][offsets]
        for k, ids in zip(places, np.split(gather(flat, bounds, codes), ends[1:-1])):
            out[k] = ids


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids (array of ints) of column ``text`` in column ``out``; nulls are empty texts."""
    kept = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(f"encoder {path}", lambda: Encoder(path))
        for batch in slices(batches, text, SLICE):
            ids = encoder.encode(batch.column(text))
            bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            made = pa.ListArray.from_arrays(bounds, np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), made], [*kept, out])
    schema = docs.select(kept).schema.add(out, T.ArrayType(T.IntegerType()))
    return docs.select(*kept).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of the ids in column ``ids``; null ids give an empty text."""
    kept = [c for c in rows.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = per_process(f"encoder {path}", lambda: Encoder(path)).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, out])
    return rows.mapInArrow(run, rows.select(kept).schema.add(out, "string"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document; no ids leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(f"encoder {path}", lambda: Encoder(path))
        names = [str(i) for i in range(len(encoder.vocabulary.pieces))]
        for batch in slices(batches, "text", SLICE):
            counts, hashes, decoded = [], [], []
            for ids in encoder.encode(batch.column("text")):
                listed = ids.tolist()
                counts.append(len(listed))
                hashes.append(hashlib.sha256(",".join(map(names.__getitem__, listed)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.vocabulary.decode(listed).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()),
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
