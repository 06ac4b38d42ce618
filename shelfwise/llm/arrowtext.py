"""Vectorised text helpers for Arrow batches inside tasks.

A string column is taken as one byte buffer with row offsets; words are found
and hashed with numpy over blocks of a few MB, so that memory is bounded by
the block, or by the longest single word.  A null text counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)           # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)                     # \x20 and \x09-\x0D
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)          # A-Z to a-z
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def release() -> None:
    """Gives freed memory back to the system: a worker that keeps what a large step has freed adds it to the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):            # not glibc
        pass


def byte_table(seed: int, fold: np.ndarray | None = None) -> np.ndarray:
    """A random 64-bit value for each byte; ``fold`` maps bytes to the byte they count as."""
    t = mix(np.arange(1, 257, dtype=np.uint64) * _BASE + np.uint64(seed))
    return t if fold is None else t[fold]


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            m = max(n, 1 << 16)
            cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, _BASE)]), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, _INVERSE)]), dtype=np.uint64)
        return cls.up, cls.down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash base, and of its inverse."""
    return _Powers.get(n)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; offsets start at 0 and have one entry more than rows."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, off, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, np.int64)[col.offset: col.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0]: off[-1]]
    return data, off - off[0]


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` with at most ``limit`` bytes of text (or one row), and their buffers."""
    data, off = buffers(batch.column(text))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo), data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def spans(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of bytes outside ``gap`` within each row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~gap[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = off[(off > 0) & (off < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """64-bit polynomial hashes of ``data[start:end]``, spans in ascending order without overlap."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + block, "right")))
        part = data[base: ends[j - 1]]
        up, down = _Powers.get(len(part) + 1)
        s = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * up[: len(part)], out=s[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (s[b] - s[a]) * down[a] + (b - a).astype(np.uint64) * _BASE
        i = j
    return mix(out)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Lets an Arrow batch hold ``rows`` rows at most: its bytes aren't bounded otherwise, and texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores until it is none of ``taken``."""
    while name in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list[pa.Array]],
             fields: list[StructField], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df``'s ``keep`` columns (default all) and new ones, which ``fn`` makes for blocks of rows."""
    small_batches(df.sparkSession)
    kept = df.columns if keep is None else keep
    schema = StructType([df.schema[c] for c in kept] + fields)
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for rows, data, off in blocks(batch, text):
                yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + fn(rows, data, off), names=names)

    return df.mapInArrow(run, schema)

