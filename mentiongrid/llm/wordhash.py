"""Word hashes, hashes of word runs, and packed lists of hashes, shared by the operators on words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_CACHE = 400_000
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20


class WordHashes(dict):
    """64-bit hashes by word; forgets all when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class WordNumbers(dict):
    """Words numbered in the order of their first use; `words` has them by number."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


def pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about a megabyte, cut at blanks only, so that few words are objects at a time."""
    start = 0
    while len(data) - start > _PIECE:
        end = start + _PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def numbered(data: bytes, known: dict[bytes, int], kind=np.int64) -> np.ndarray:
    """The hashes or numbers of all words of a text."""
    parts = []
    for piece in pieces(data):
        words = piece.split()
        parts.append(np.fromiter(map(known.__getitem__, words), kind, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(29))


class Runs:
    """Hashes of any runs of a sequence of word hashes, from sums of powers modulo 2^64."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        power, self._undo = (np.full(n + 1, x, np.uint64) for x in (_BASE, _UNDO))
        power[0] = self._undo[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(self._undo, out=self._undo)
        self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:n], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, length) -> np.ndarray:
        value = (self._sum[start + length] - self._sum[start]) * self._undo[start]
        return mixed(value + np.asarray(length).astype(np.uint64))


def stretches(ascending: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The distinct values of an ascending array, and where each starts and ends."""
    values, first = np.unique(ascending, return_index=True)
    return values, list(zip(first.tolist(), [*first[1:].tolist(), len(ascending)][: len(first)], strict=True))


def packed(ascending: np.ndarray, width: int) -> bytes:
    """Ascending numbers as differences of `width` bytes, low bytes first: the high bytes are nearly all zero."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)
