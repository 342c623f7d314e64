"""Arrays of hashes and ids packed into one cell, and word hashes; for operators that send many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from jobmetrics.llm.common import WORD

_NARROW = (np.uint8, np.uint16, np.uint32)
# Words whose hashes a task keeps; at this size they are forgotten, which changes no result.
KNOWN_WORDS = 300_000


def packed(values: np.ndarray) -> bytes:
    """Integers in as few bytes each as the largest needs; the first byte says how many."""
    if values.dtype != np.uint64:
        low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
        for kind in _NARROW:
            if low >= 0 and high <= np.iinfo(kind).max:
                return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()
        return bytes([9]) + values.astype(np.int64).tobytes()
    return bytes([8]) + values.tobytes()


def unpacked(cell: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64, 9: np.int64}[cell[0]]
    values = np.frombuffer(cell, dtype=kind, offset=1)
    return values if kind is np.uint64 else values.astype(np.int64)


def joined(column: pa.ChunkedArray) -> np.ndarray:
    """The arrays of all cells of a column, one after the other."""
    parts = [unpacked(c) for c in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


_shared: WordHashes | None = None


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    @classmethod
    def shared(cls) -> WordHashes:
        """The one of this Python worker, which serves several tasks."""
        global _shared
        if _shared is None:
            _shared = cls()
        return _shared

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def of_text(self, text: str) -> np.ndarray:
        return self.of(WORD.findall(text))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(words: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of the `length` words from each position on, built from windows of doubled length."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    total, have, block, size = None, 0, words, 1
    bits = length
    while True:
        if bits & 1:
            count = len(words) - have - size + 1
            shifted = block[have : have + count]
            factor = np.uint64(pow(base, size, 1 << 64))
            total = shifted if total is None else total[:count] * factor + shifted
            have += size
        bits >>= 1
        if not bits:
            return mixed(total[: len(words) - length + 1])
        block = block[: len(block) - size] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
        size *= 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the `width` values from each position on."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
