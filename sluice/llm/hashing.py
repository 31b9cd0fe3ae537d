"""Hashes of words and of runs of words, a whole text at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows handed to Spark at a time.
ROWS_PER_BATCH = 65_536
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MULTIPLIER
    return h ^ (h >> np.uint64(29))


def range_hashes(values: np.ndarray, starts, ends) -> np.ndarray:
    """Polynomial hashes of values[start:end], whatever the start: differences of prefix sums modulo 2 ** 64."""
    n = len(values)
    power = np.full(n, BASE)
    power[:1] = 1
    power = np.multiply.accumulate(power)
    back = np.full(n, _INVERSE)
    back[:1] = 1
    back = np.multiply.accumulate(back)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power, out=upto[1:])
    return mixed((upto[ends] - upto[starts]) * back[starts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of UTF-8 bytes, split at the six ASCII white-space characters."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_hashes(_BYTES[data], begin, end)


def batches_of(names: list[str], rows: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Column arrays of many documents as batches of at least ``ROWS_PER_BATCH`` rows (the last one: fewer)."""
    held, n = [], 0
    for columns in rows:
        held.append(columns)
        n += len(columns[0])
        if n >= ROWS_PER_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)
