"""Vectorised word, line and n-gram primitives over Arrow string batches.

Everything works on the UTF-8 bytes of a whole batch at once: a word is a maximal run of bytes
outside ``\\x20\\x09-\\x0D`` (all ASCII, so byte boundaries are code point boundaries), and hashes of
arbitrary byte or word ranges come from one prefix sum of a polynomial modulo 2**64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Punctuation that may be cut off a word.
PUNCT = np.zeros(256, bool)
PUNCT[[ord(c) for c in ".,;:!?\"'()[]{}-*#%&$|<>_~`"]] = True
#: First byte of a code point: everything but UTF-8 continuation bytes.
LEAD = (np.arange(256) & 0xC0) != 0x80
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUE = np.random.default_rng(20240611).integers(1, 2**64 - 1, 256, dtype=U64)


_held: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of each; one table is held."""
    if not _held or len(_held[0]) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        _held.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, U64)
            p[0] = 1
            _held.append(np.cumprod(p, dtype=U64))
    return _held[0], _held[1]


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads a 64-bit value over all its bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Ranges:
    """Hashes of ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        pw, self.inv = powers(len(values))
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * pw[: len(values)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inv[start]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U64))


def bytes_hash(data: np.ndarray) -> Ranges:
    """Hashes of byte ranges."""
    return Ranges(_BYTE_VALUE[data])


class Words:
    """Words of a batch of texts.

    data: bytes of all texts; at: byte offset of each text (n + 1); start, end: byte range of each
    word; first: index of each text's first word (n + 1).
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.at = text_bytes(texts)
        if lower:
            self.data = LOWER[self.data]
        n, at = len(self.data), self.at
        word = WORD_BYTE[self.data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = word[:-1]
            after[-1] = False
            after[:-1] = word[1:]
            before[at[:-1][at[:-1] < n]] = False
            after[at[1:][at[1:] > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, at)
        self.word_mask = word

    def __len__(self) -> int:
        return len(self.start)

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.per_text)

    def bytes_hash(self) -> Ranges:
        return bytes_hash(self.data)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return self.bytes_hash().hash(self.start, self.end)

    def trimmed(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word without the bytes of cut at either end; of a word of nothing else, both are its end."""
        if not len(self.start):
            return self.start, self.end
        stays = ~cut[self.data]
        at = np.flatnonzero(stays)
        if not len(at):
            return self.end, self.end
        after = np.searchsorted(at, self.start)
        before = np.searchsorted(at, self.end) - 1
        start = np.where(after < len(at), at[np.minimum(after, len(at) - 1)], self.end)
        empty = start >= self.end
        return np.where(empty, self.end, start), np.where(empty, self.end, at[np.maximum(before, 0)] + 1)

    def windows(self, k: int) -> np.ndarray:
        """Index of the first word of each k-word window that lies within one text."""
        if len(self) < k:
            return np.zeros(0, np.int64)
        of = self.text_of()
        return np.flatnonzero(of[: len(of) - k + 1] == of[k - 1 :])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offset of each (n + 1). A null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: the worker process lives on, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def freed(run):
    """run, a function of a task's batches, with memory given back before it (what the worker kept of an earlier stage) and
    after it, when nothing refers to its last batch any more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return task


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a k-word window that begins at one of starts."""
    step = np.zeros(n + 1, np.int32)
    step[starts] += 1
    np.subtract.at(step, starts + k, 1)
    return np.cumsum(step[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = np.unique(twice)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive ranges first[i]:first[i + 1]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
