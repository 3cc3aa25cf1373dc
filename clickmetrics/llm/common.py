"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickmetrics.session import work_folder

# Entries a worker keeps in a cache of words before it starts afresh.
CACHE_WORDS = 600_000
# Longer words are worked out each time, so that a cache stays small.
CACHE_CHARS = 64


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# What a worker keeps between tasks, by the key of the one that made it.
_kept: dict = {}


def forget() -> None:
    """Drops what earlier stages left in this worker, which goes from stage to stage."""
    if _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()


def kept(key: tuple, make: Callable):
    """What ``make`` gives, kept by the worker for later tasks until one asks for another key."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def slabs(column: pa.Array, size: int) -> Iterator[tuple[int, pa.Array]]:
    """A string column in runs of rows of about ``size`` bytes, each with its first row's number."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, column.slice(row, last - row)
        row = last


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], list], schema: str) -> DataFrame:
    """``work`` turns a batch into columns for ``schema`` (a DDL string); batches stay independent."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in work(batch)], names=names
            )

    return df.mapInArrow(run, schema)


def keep_files(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once into the folder that executors share and reads it back, which cuts its lineage."""
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def squeezed(raw: bytes) -> bytes:
    """Bytes compressed, behind their length."""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unsqueezed(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, codec="zstd", asbytes=True) if size else b""


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads near values (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without a gap, and where each text starts (one more entry than rows)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's multiplier and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        step = np.full(size, _MULTIPLIER, np.uint64)
        back = np.full(size, pow(_MULTIPLIER, -1, 2**64), np.uint64)
        step[0] = back[0] = 1
        _powers, _inverses = np.cumprod(step, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def words_of(raw: np.ndarray, classes: np.ndarray, offsets: np.ndarray, slab: int = 1 << 21):
    """Words of texts laid end to end: (start, end, hash of the bytes, row).

    ``classes`` maps a byte to 0 (between words) or to the value hashed for it. Words never cross
    rows. Rows are taken ``slab`` bytes at a time, so the arrays in work stay small.
    """
    out = []
    row = 0
    rows = len(offsets) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + slab, side="right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[last])
        if hi > lo:
            value = classes[raw[lo:hi]]
            inside = value > 0
            change = np.empty(hi - lo + 1, bool)
            change[0], change[-1] = inside[0], False
            np.logical_and(inside[1:], ~inside[:-1], out=change[1:-1])
            cuts = offsets[row + 1 : last] - lo
            cuts = cuts[(cuts > 0) & (cuts < hi - lo)]
            change[cuts] |= inside[cuts]
            starts = np.flatnonzero(change)
            change[:-1] = False
            np.logical_and(~inside[1:], inside[:-1], out=change[1:-1])
            change[cuts] |= inside[cuts - 1]
            change[-1] = inside[-1]
            ends = np.flatnonzero(change)
            powers, inverses = power_tables(hi - lo + 1)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(value.astype(np.uint64) * powers[:-1], out=total[1:])
            hashes = mix64((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
            of_row = row + np.searchsorted(offsets[row + 1 : last + 1] - lo, starts, side="right")
            out.append((starts + lo, ends + lo, hashes, of_row))
        row = last
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty
    return tuple(np.concatenate(parts) for parts in zip(*out))


def chain_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` neighbouring words, order included."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        total = mix64(total * np.uint64(_MULTIPLIER) + hashes[i : len(hashes) - n + 1 + i])
    return total


def quiet_tokenizers() -> None:
    """One thread for each task; Spark spreads the work."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
