"""Words and rolling hashes of many texts at once, with numpy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from turnloom.llm.common import CLEARED_AFTER_TASKS, mixed

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    size = (1 << bits) + 1
    up, down = np.full(size, BASE), np.full(size, BASE_INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


CLEARED_AFTER_TASKS.append(_powers.cache_clear)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i from 0 to size at least."""
    return _powers(max(20, int(size).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences give the hash of any byte range, see range_hash."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes first .. end - 1: equal bytes give equal hashes."""
    _, down = powers(len(sums))
    length = (end - first).astype(np.uint64)
    return mixed((sums[end] - sums[first]) * down[first] + length * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """The words of some texts, in order; positions count the bytes of all texts joined."""

    data: np.ndarray  # bytes of all texts, each followed by a line feed
    first: np.ndarray
    end: np.ndarray
    text: np.ndarray  # number of the text of each word
    offset: np.ndarray  # where each text starts in data, and one more for the end

    def hashes(self) -> np.ndarray:
        return range_hash(prefix_hash(self.data), self.first, self.end)

    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.offset) - 1)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a line feed, and the offset of each text."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return data, np.concatenate([[0], np.cumsum(sizes)])


def split_words(texts: list[bytes], lower: bool = True) -> Words:
    """Words are the longest runs without ASCII white space; only A-Z are lower-cased."""
    data, offset = join_texts(texts)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~SPACE[data]
    edge = np.diff(inside)
    first = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(first, offset)))
    return Words(data, first, end, text, offset)
