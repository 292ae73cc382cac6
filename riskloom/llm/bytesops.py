"""Whole-batch work on UTF-8 bytes inside Spark tasks: words, hashes, n-grams.

A block is a bounded run of documents joined into one byte array with a zero byte after each, so numpy handles all
of them at once.  Hashes are fixed functions of the bytes, equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)

_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GEAR = _rng.integers(0, 2**32, 256, dtype=np.uint32)

SPACE = np.zeros(256, bool)
SPACE[[0, 9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column; None stays None."""
    return column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist()


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) for runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    at, size, run = 0, 0, []
    values = batch.column(column)
    for lo in range(0, len(values), 256):
        for row, text in enumerate(texts_of(values.slice(lo, 256)), lo):
            if run and size + len(text or b"") > limit:
                yield at, run
                at, size, run = row, 0, []
            run.append(text)
            size += len(text or b"") + 1
    if run:
        yield at, run


def joined(texts: list[bytes | None], table: bytes | None = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each text and the end of all); each text is followed by a zero byte."""
    data = b"\0".join([t or b"" for t in texts]) + b"\0"
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(data.translate(table) if table else data, np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: equal in, equal out; near in, far out."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class _Powers:
    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << int(n).bit_length()
            inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
            for name, base in (("up", ODD), ("down", inverse)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down


_powers = _Powers()


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; it depends on the bytes alone, not on their place."""
    up, down = _powers.get(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of bytes that are not ASCII white space."""
    space = SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]  # the last byte of a block is a separator


def ngram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n consecutive 64-bit values."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = values[:m].copy()
    for j in range(1, n):
        out = out * ODD + values[j : j + m]
    return mix(out)


def word_shingles(texts: list[bytes | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the n-word shingles of text i are hashes[bounds[i]:bounds[i + 1]], in order of place.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    data, offsets = joined(texts)
    starts, ends = words_of(data)
    hashes = segment_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    grams = ngram_hashes(hashes, n)
    sizes = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(first[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
    out = grams[np.minimum(source, max(len(grams) - 1, 0))] if len(grams) else np.zeros(bounds[-1], np.uint64)
    for i in np.flatnonzero((count > 0) & (count < n)):
        out[bounds[i]] = mix(np.array([hash_words(hashes[first[i] : first[i + 1]])], np.uint64))[0]
    return out, bounds


def hash_words(values: np.ndarray) -> int:
    h = 0
    for v in values.tolist():
        h = (h * int(ODD) + v + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def byte_ngrams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each place of data the hash of the n bytes from there, in ``bits`` bits; n - 1 fewer than bytes."""
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.int32)
    values = BYTE_VALUES.astype(np.uint32)
    x = values[data]
    out = x[:m].copy()
    for j in range(1, n):
        out *= np.uint32(0x01000193)
        out += x[j : j + m]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D + 2 * n)
    out ^= out >> np.uint32(13)
    return (out >> np.uint32(32 - bits)).astype(np.int32)


def text_ngrams(texts: list[bytes | None], sizes: tuple[int, ...], bits: int) -> Iterator[list[np.ndarray]]:
    """For each text the hashed byte n-grams of each size, lower-cased in ASCII, with white space at both ends."""
    padded = [b" " + t + b" " if t else t for t in texts]
    data, offsets = joined(padded)
    grams = [byte_ngrams(data, n, bits) for n in sizes]
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield [g[lo : max(lo, hi - n)] for g, n in zip(grams, sizes)]
