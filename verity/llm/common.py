"""Helpers shared by the training-data operators: reading, vectorised hashing of words and shingles.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  Hashing works on whole Arrow
string columns with numpy (one pass over the bytes, no Python loop per word), in slices of
bounded size, so memory does not grow with the batch or with one long text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def few_tasks(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df``, a checkpoint or a table, in no more tasks than its rows fill at ``rows`` a task.

    Each shuffle writes files for every task of its input, so small results in many partitions
    cost more disk and time than their rows.  More rows, more tasks: nothing large is put together.
    """
    return df.coalesce(df.count() // rows + 1)


def _return_memory() -> None:
    """Give what Arrow and the C library hold free back to the system, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over Arrow batches, returning free memory after each batch: workers live on between
    tasks, and what they keep counts towards their executor."""

    def each(batches):
        for batch in batches:
            yield batch
            del batch
            _return_memory()

    def wrapped(batches):
        yield from run(each(batches))
        _return_memory()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants), on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the n + 1 offsets into them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWER = powers(2 * SLICE_BYTES, _BASE)
_POWER_INVERSE = powers(2 * SLICE_BYTES, _BASE_INVERSE)


def _tails(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The last three bytes of each word, as one number."""
    third = data[np.maximum(end - 3, begin)].astype(np.uint32)
    return third << np.uint32(16) | data[np.maximum(end - 2, begin)].astype(np.uint32) << np.uint32(8) | data[end - 1]


def _hash_slice(data: np.ndarray, starts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of ``data``; ``starts``: positions where a new text begins."""
    n = len(data)
    gap = _SPACE[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    first[1:] = gap[:-1]
    first[starts[starts < n]] = True
    begin = np.flatnonzero(first & ~gap)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, begin
    last = np.empty(n, dtype=bool)
    last[-1] = True
    last[:-1] = gap[1:]
    inner = starts[(starts > 0) & (starts < n)] - 1
    last[inner] = True
    end = np.flatnonzero(last & ~gap)
    up, down = (_POWER, _POWER_INVERSE) if n <= len(_POWER) else (powers(n, _BASE), powers(n, _BASE_INVERSE))
    total = np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[:n], dtype=np.uint64)
    value = total[end]
    value[begin > 0] -= total[begin[begin > 0] - 1]
    value *= down[begin]
    return mix(value + (end - begin + 1).astype(np.uint64) * _BASE), begin, end + 1


def word_slices(column: pa.Array, lower: bool, tails: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Yield (first row, end row, word hashes, words per row, tails) for slices of whole rows.

    A slice holds about ``SLICE_BYTES`` of text or one longer text; a longer text is hashed in
    pieces cut at white space.
    """
    data, at = string_parts(column)
    rows, lo = len(at) - 1, 0
    while lo < rows:
        hi = int(np.searchsorted(at, at[lo] + SLICE_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        a, b = int(at[lo]), int(at[hi])
        if a == b:
            yield lo, hi, np.zeros(0, np.uint64), np.zeros(hi - lo, np.int64), np.zeros(0, np.uint32) if tails else None
        elif b - a <= SLICE_BYTES or hi - lo > 1:
            value, begin, end = _hash_slice(data[a:b], at[lo:hi] - a, lower)
            edges = np.searchsorted(begin, at[lo : hi + 1] - a)
            yield lo, hi, value, np.diff(edges), _tails(data[a:b], begin, end) if tails else None
        else:
            parts, ends, x = [], [], a
            while x < b:
                y = min(x + SLICE_BYTES, b)
                while y < b and not _SPACE[data[y]]:
                    step = np.flatnonzero(_SPACE[data[y : y + SLICE_BYTES]])
                    y = y + int(step[0]) if len(step) else min(y + SLICE_BYTES, b)
                value, begin, end = _hash_slice(data[x:y], np.zeros(1, np.int64), lower)
                parts.append(value)
                if tails:
                    ends.append(_tails(data[x:y], begin, end))
                x = y
            value = np.concatenate(parts)
            yield lo, hi, value, np.array([len(value)]), np.concatenate(ends) if tails else None
        lo = hi


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Yield (row, ascending distinct hashes) of the ``width``-word shingles of lower-cased texts.

    A text with fewer words has its whole word sequence as its one shingle; without words, none.
    """
    weight = np.random.default_rng(width).integers(1, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for lo, _, value, counts, _ in word_slices(column, lower=True):
        if len(value) >= width:
            rolled = np.zeros(len(value) - width + 1, np.uint64)
            for k in range(width):
                rolled += value[k : len(value) - width + 1 + k] * weight[k]
            rolled = mix(rolled + np.uint64(width))
        x = 0
        for i, n in enumerate(counts.tolist()):
            if n >= width:
                own = np.sort(rolled[x : x + n - width + 1])
                if len(own) > 1:
                    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
                yield lo + i, own
            elif n:
                yield lo + i, mix((value[x : x + n] * weight[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
            else:
                yield lo + i, np.zeros(0, np.uint64)
            x += n
