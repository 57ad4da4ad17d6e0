"""Words of UTF-8 texts as numpy arrays, without a Python object for each word.

A word is a run of bytes other than space and \\x09-\\x0D; A-Z are lower-cased. Word identities are 64-bit
polynomial hashes with a random value for each byte, mixed at the end; two of n words share an identity with
probability of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at once; bounds the arrays of eight bytes for each byte of text.
CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    inverse = pow(BASE, -1, 2**64)
    out = []
    for b in (BASE, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending spans, in chunks of about CHUNK bytes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        n = 1 << max(12, (hi - lo).bit_length())
        power, inverse = powers(n)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(VALUE[data[lo:hi]] * power[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each starts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    a = texts.cast(pa.large_binary())
    if a.null_count:
        a = a.fill_null(b"")
    _, at, raw = a.buffers()
    offsets = np.frombuffer(at, np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, first word of each text and the number of words at last)."""
    data, offsets = flat(texts)
    data = LOWER[data]
    inside = ~SPACE[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    before[:-1] = inside[1:]
    before[-1:] = False
    before[edge - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return data, starts, ends, np.searchsorted(starts, offsets)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about that many bytes of text each; one text is never cut."""
    a = batch.column(column).cast(pa.large_binary())
    if not len(a):
        return
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
