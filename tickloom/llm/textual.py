"""Words, lines and hashes of batches of texts, as numpy arrays.

A batch of texts is one byte buffer with offsets. Words are `[^\\x20\\x09-\\x0D]+`;
no UTF-8 continuation byte falls in that class, so bytes can be scanned as they are.
Hashes have 64 bits and depend on content only, so they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ODD = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the output (a bijection on 64 bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * ODD)


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of ODD and of its inverse, modulo 2**64."""
    up, down = np.full(n, ODD), np.full(n, np.uint64(pow(int(ODD), -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def slices(batches: Iterator[pa.RecordBatch], text_at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a slice holds at most `limit` bytes of text, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the offsets of each text's words."""
    gap = SPACE[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.concatenate(([True], gap))[: len(data)] | fresh[:-1]
    after = np.concatenate((gap[1:], [True]))[: len(data)] | fresh[1:]
    starts = np.flatnonzero(~gap & before)
    return starts, np.flatnonzero(~gap & after) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of `k` words, by doubling; runs across texts included."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out, width, part, size = None, 0, words, 1
    while True:
        if k & size:
            n = len(words) - width - size + 1
            out = part[:n] if out is None else mix(out[:n] * ODD + part[width : width + n] + np.uint64(size))
            width += size
        size *= 2
        if size > k:
            return out
        half = size // 2
        part = mix(part[:-half] * ODD + part[half:] + np.uint64(half))


def inside(word_offsets: np.ndarray, k: int) -> np.ndarray:
    """Of all runs of `k` words, those that lie within one text."""
    n = int(word_offsets[-1])
    if n < k:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.arange(n) + k <= np.repeat(word_offsets[1:], np.diff(word_offsets)))


def fresh_name(taken: list[str], name: str) -> str:
    """`name`, lengthened until no column of that name is there."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name
