"""Words, word hashes and k-gram hashes of a batch of texts, as numpy work on Arrow's own buffers.

A batch of rows is handled in blocks of about ``BLOCK_BYTES`` of text, so
the arrays of one block stay small whatever the batch holds; one row longer
than that is a block of its own (whole texts, never prefixes).  NULL texts
count as empty.

A word's 64-bit hash is a polynomial over random byte values, read off prefix
sums of the block and then mixed with the word's length; equal words
have equal hashes in every task.  Different words share a hash with a
chance of about 2^-63 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

_byte = np.arange(256)
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
_BYTE_LOWER = _BYTE[_LOWER]
#: Bytes of a word: all but white space …
NOT_SPACE = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))
#: … or a-z (after lower-casing), 0-9 and every byte of a character beyond ASCII.
WORD_CHARS = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)


class _Powers:
    """Powers of the multiplier and of its inverse, as long as the longest block so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            m = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * _U(pow(_P, m, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * _U(pow(_P_INV, m, 1 << 64))])
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


@dataclass
class Block:
    """The words of some rows: row ``i`` owns ``hash[offsets[i]:offsets[i + 1]]``."""

    first_row: int
    n_rows: int
    hash: np.ndarray
    offsets: np.ndarray
    start: np.ndarray  # byte position of each word within its row
    end: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), self.counts)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(byte offsets of the rows, all bytes)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, whole


def row_blocks(offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts make about a block; at least one row each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_blocks(texts: pa.Array, word_bytes: np.ndarray, lower: bool = True,
                block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    offsets, data = text_buffers(texts)
    values = _BYTE_LOWER if lower else _BYTE
    for lo, hi in row_blocks(offsets, block_bytes):
        at = offsets[lo:hi + 1] - offsets[lo]
        buf = data[offsets[lo]:offsets[hi]]
        n = len(buf)
        if n == 0:
            empty = np.zeros(0, np.int64)
            yield Block(lo, hi - lo, empty.astype(np.uint64), np.zeros(hi - lo + 1, np.int64), empty, empty)
            continue
        inside = word_bytes[buf]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[at[:-1][at[:-1] < n]] = False
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[at[1:][at[1:] > 0] - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        up, down = _Powers.of(n)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[buf] * up[:n], out=sums[1:])
        h = (sums[end] - sums[start]) * down[start]
        h = mix(h + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
        words = np.searchsorted(start, at)
        base = np.repeat(at[:-1], np.diff(words))
        yield Block(lo, hi - lo, h, words, start - base, end - base)


def kgrams(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word's index in the block) of every k consecutive words of one row, in order."""
    n = len(block.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    left = np.repeat(block.offsets[1:], block.counts) - np.arange(n)  # words up to the row's end
    at = np.flatnonzero(left >= k)
    return combine([block.hash[at + t] for t in range(k)]), at


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of a sequence of word hashes."""
    h = np.zeros_like(parts[0])
    for x in parts:
        h = h * _U(0xC2B2AE3D27D4EB4F | 1) + x
    return mix(h + _U(len(parts)))


def hash_text(text: str, word_bytes: np.ndarray) -> np.ndarray:
    """Word hashes of one text (templates, tests)."""
    parts = [b.hash for b in word_blocks(pa.array([text]), word_bytes)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
