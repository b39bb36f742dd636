"""Words and characters of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash

from tickframe.llm.common import Numbered

KNOWN_WORDS = 200_000
PACKED = 1 << 21
SYMBOLS = b"#*$%&|<>"
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


class Words:
    """Numbers words ([^\\x20\\x09-\\x0D]+, as bytes) and keeps a 64-bit hash of each."""

    def __init__(self):
        self.known, self.hashes = Numbered(), np.zeros(0, np.uint64)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, and the bounds of each text."""
        if len(self.known) > KNOWN_WORDS:
            self.__init__()
        number = self.known.__getitem__
        lists = []
        for text in texts:
            words = text.split()  # for bytes, exactly at 20, 09-0D
            lists.append(np.fromiter(map(number, words), np.int64, len(words)))
        new = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.known.new), np.uint64, len(self.known.new))
        self.known.new = []
        self.hashes = np.concatenate([self.hashes, new])
        bounds = np.r_[0, np.cumsum([len(x) for x in lists], dtype=np.int64)]
        return np.concatenate(lists) if lists else np.zeros(0, np.int64), bounds


def repeated_words(words: np.ndarray) -> int:
    """Words of one text that lie in a window of three that occurs twice or more."""
    if len(words) < 4:
        return 0
    if words.max() < PACKED:
        codes = words[:-2] << 42 | words[1:-1] << 21 | words[2:]
        order = np.argsort(codes, kind="stable")
        same = codes[order[1:]] == codes[order[:-1]]
        twice = np.zeros(len(codes), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
    else:
        listed = words.tolist()
        windows = list(zip(listed, listed[1:], listed[2:]))
        counts = Counter(windows)
        twice = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    r"""Lines (cut at \n) that hold a word and equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between each two bounds."""
    total = np.r_[values.dtype.type(0), np.cumsum(values)]
    return total[bounds[1:]] - total[bounds[:-1]]
