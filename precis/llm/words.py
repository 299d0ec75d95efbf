"""Words of whole Arrow batches as numpy arrays, with 64-bit hashes of words and of word ranges.

A word is a run of bytes other than space and ``\\x09`` to ``\\x0D``; hashes fold
A-Z. Rows are handled in slices of about a megabyte (a longer text makes a slice
of its own), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from precis.session import ship_package

SLICE_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    return values


_VALUE = _byte_values()
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, *range(9, 14)]] = False
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, dtype=_U)
            x[0] = 1
            both.append(np.cumprod(x))
        _powers = (both[0], both[1])
    return _powers[0][:n], _powers[1][:n]


class Range:
    """Hashes of ranges of a sequence of values, each in constant time."""

    def __init__(self, values: np.ndarray):
        up, self._down = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * up[:-1], out=self._sums[1:])

    def hash(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[first]) * self._down[first])


class Slice(NamedTuple):
    """Some consecutive rows of a batch."""

    row: int  # the first row
    data: np.ndarray  # the bytes of all texts
    bounds: np.ndarray  # where each text begins in data, and the end
    starts: np.ndarray  # where each word begins in data
    ends: np.ndarray
    hashes: np.ndarray  # of the words
    first: np.ndarray  # the first word of each text, and the end


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string array; a null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if large else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), bounds


def spans(data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray = _IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word, a run of ``word_bytes``; no word crosses a bound."""
    inside = word_bytes[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[inner] = inside[inner]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[inner - 1] = inside[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def slices(texts: pa.Array) -> Iterator[Slice]:
    """The rows of a string array, a slice at a time."""
    data, bounds = buffers(texts)
    row = 0
    while row < len(bounds) - 1:
        end = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(bounds) - 1)
        own = bounds[row : end + 1] - bounds[row]
        part = data[bounds[row] : bounds[end]]
        starts, ends = spans(part, own)
        hashes = Range(_VALUE[part]).hash(starts, ends)
        yield Slice(row, part, own, starts, ends, hashes, np.searchsorted(starts, own))
        row = end


def mapped(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function on single batches, with this package at hand on the workers."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most so many rows in the jobs run inside, for workers that hold much besides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def counted(df: DataFrame, text: str, out: str) -> DataFrame:
    """All columns of ``df`` and the number of words of ``text`` (null: 0) as ``out``."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    place = df.columns.index(text)

    def count(batch):
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        data, bounds = buffers(batch.column(place))
        row = 0
        while row < len(bounds) - 1:
            end = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1
            end = min(max(end, row + 1), len(bounds) - 1)
            own = bounds[row : end + 1] - bounds[row]
            starts, _ = spans(data[bounds[row] : bounds[end]], own)
            sizes[row:end] = np.diff(np.searchsorted(starts, own))
            row = end
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes)], names=[*batch.schema.names, out])

    return mapped(df, count, schema)
