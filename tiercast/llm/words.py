"""Words and hashes of Arrow text columns, as whole-array numpy work inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.ones(256, np.uint8)
_WORD[[9, 10, 11, 12, 13, 32]] = 0

BLOCK_BYTES = 2 << 20


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Regroup record batches into tables of about ``size`` bytes of text (one longer text stays whole)."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)).astype(np.int64)
        ends = np.cumsum(lengths)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, done + size - weight, side="right")), first + (not held))
            if last > first:
                held.append(batch.slice(first, last - first))
                weight += int(ends[last - 1] - done)
                first = last
            if first < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, weight = [], 0
    if held:
        yield pa.Table.from_batches(held)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and the n + 1 offsets; a null is an empty text."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_powers = [np.ones(1, U64), np.ones(1, U64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


_STRETCH = 1 << 18


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range (starts ascending), from running polynomial sums over stretches of bytes."""
    value = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        left = int(starts[at])
        to = int(np.searchsorted(starts, left + _STRETCH))
        right = int(ends[at:to].max())
        n = right - left
        power, inverse = _grown(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum((raw[left:right].astype(U64) + U64(1)) * power[:n], out=sums[1:])
        begin = starts[at:to] - left
        value[at:to] = (sums[ends[at:to] - left] - sums[begin]) * inverse[begin]
        at = to
    return mix(value ^ ((ends - starts).astype(U64) << U64(56)))


def class_runs(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes of one class (class 0 left out) and the text each lies in."""
    kind = classes[raw]
    begins = np.ones(len(raw), bool)
    begins[1:] = kind[1:] != kind[:-1]
    edges = offsets[1:-1]
    begins[edges[edges < len(raw)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(raw)) if len(starts) else starts
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_ranges(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) and the text each lies in."""
    return class_runs(raw, offsets, _WORD)


def segments(owner: np.ndarray, n: int) -> np.ndarray:
    """The n + 1 bounds of each owner's run in a sorted array of owners."""
    return np.searchsorted(owner, np.arange(n + 1))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def shingle_hashes(hashes: np.ndarray, owner: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each run of ``size`` words; a shorter text is one shingle, an empty one has none."""
    bounds = segments(owner, n)
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = spread(bounds[:-1], made)
    out = np.zeros(len(first), U64)
    whose = np.repeat(np.arange(n), made)
    last = bounds[1:][whose]
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    for k in range(size):
        part = padded[first + k]
        part = np.where(first + k < last, part, U64(0))
        out = (out ^ part) * U64(0xC2B2AE3D27D4EB4F)
        out ^= out >> U64(29)
    return mix(out), whose


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one compressed value, byte plane by byte plane."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unsqueeze(data: bytes, *kinds: type) -> list[np.ndarray]:
    """The arrays that ``squeeze`` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(raw) // sum(sizes)
    out, at = [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out
