"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that one Arrow batch carries to a Python worker; whole texts can be long.
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``max_bytes`` of text; a longer text stays whole, alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The work of a task, which at its end gives what it freed back to the system: workers stay for later stages."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


class RowIds:
    """Numbers the rows of a task; the same rows get the same numbers when a task runs again on its split."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 36

    def take(self, n: int) -> np.ndarray:
        out = np.arange(self.next, self.next + n, dtype=np.int64)
        self.next += n
        return out


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_strings(values: list) -> pa.Array:
    """A string column from str or UTF-8 bytes."""
    if values and isinstance(values[0], bytes):
        return pa.array(values, pa.binary()).cast(pa.string())
    return pa.array(values, pa.string())


def slices_for(rows: int, per_slice: int = 1 << 20, least: int = 8, most: int = 1 << 16) -> int:
    """A power of two of key slices, so that a slice holds about ``per_slice`` rows at any input size."""
    n = least
    while n < most and n * per_slice < rows:
        n *= 2
    return n


def cut(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slice of each key by its top bits."""
    return (keys >> np.uint64(64 - (slices.bit_length() - 1))).astype(np.int64) if slices > 1 else np.zeros(len(keys), np.int64)


def sliced(keys: np.ndarray, slices: int, *values: np.ndarray) -> Iterator[tuple]:
    """Sorted keys and their values as one blob row per slice."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], [v[order] for v in values]
    at = np.searchsorted(cut(keys, slices), np.arange(slices + 1))
    for s in np.flatnonzero(np.diff(at)):
        a, b = at[s], at[s + 1]
        yield (int(s), keys[a:b].tobytes(), *(v[a:b].tobytes() for v in values))


def with_unique_names(df: DataFrame, **columns: str) -> DataFrame:
    """Select the named columns under fixed names, so that other columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
