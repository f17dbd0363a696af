"""Numpy views of Arrow text columns, and hashes over them.

A task never holds more than one Arrow batch; the helpers cut a batch into slices of about a
megabyte of text, so scratch arrays stay small whatever the length of single texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text; a longer text has a range of its own."""
    _, offsets = utf8(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield begin, end
        begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finisher of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below n at least; the base is odd."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = out[0], out[1]
        if size <= 1 << 22:
            _POWERS[base] = have
    return have


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit polynomial hash of ``values[start:end]`` for each range, equal wherever it stands."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: The bytes that separate words, ``[\x20\x09-\x0D]``.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE_B))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of every word, and where each text's words begin (n + 1 values)."""
    ink = np.zeros(len(data) + 2, bool)
    ink[1:-1] = ~BLANK[data]
    start = ink[1:-1] & ~ink[:-2]
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[inner] |= ink[inner + 1]
    end = ink[1:-1] & ~ink[2:]
    last = inner[1:] - 1
    end[last] |= ink[last + 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = (ends - starts).astype(U64)
    return mix(range_hashes(_BYTE_VALUES[data], starts, ends, BASE_A) + lengths * U64(BASE_B))


def gram_hashes(values: np.ndarray, n: int, base: int = BASE_B) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values (len - n + 1 of them)."""
    if len(values) < n:
        return np.zeros(0, U64)
    at = np.arange(len(values) - n + 1)
    return mix(range_hashes(values, at, at + n, base))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]``; each depends on its own segment alone."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = offsets[:-1] < offsets[1:]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out


def map_rows(make: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None]) -> Callable:
    """For ``mapInArrow``: apply ``make`` to each batch, skipping empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from make(batch)

    return run
