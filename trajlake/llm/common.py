"""Stage tables, filters of fixed size and small helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import posixpath
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.storage import fresh_folder as fresh_folder
from trajlake.storage import materialize

U64 = np.uint64

#: Writes a table to the shared folder and reads it back: cuts the lineage so that a lost executor costs no earlier stage.
stage = materialize

#: Words of 64 bits of a filter: what is broadcast is never more than so many rows of 16 bytes.
FILTER_WORDS = 1 << 18


def key_filter(keys: DataFrame, column: str) -> DataFrame:
    """A Bloom filter of 64-bit hashes as a table (filter_word, filter_bits) of at most ``FILTER_WORDS`` rows, whatever the number of keys."""
    word, bit = _place(F.col(column))
    return stage(keys.groupBy(word.alias("__filter_word")).agg(F.bit_or(bit).alias("__filter_bits")), "filter")


def split_by(rows: DataFrame, column: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash may be among a filter's keys, and those whose hash is none of them for certain. Only the first need a shuffle."""
    word, bit = _place(F.col(column))
    own = rows.withColumn("__filter_word", word).join(F.broadcast(words), "__filter_word", "left")
    some = F.coalesce(F.col("__filter_bits").bitwiseAND(bit) != 0, F.lit(False))
    return own.where(some).drop("__filter_word", "__filter_bits"), own.where(~some).drop("__filter_word", "__filter_bits")


def _place(h: Column) -> tuple[Column, Column]:
    """The word of a hash in the filter, and its bit there."""
    return F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS)), F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))


def fan_out(spark: SparkSession) -> int:
    """Partitions for a few large work items that each take a while."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI and the path in it, for code on executors; a plain path is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def publish(uri: str, name: str, data: bytes) -> str:
    """Writes a file whole under a name of its own, so a repeated or lost attempt never leaves half a file under a name in use."""
    store, base = folder(uri)
    store.create_dir(base, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(posixpath.join(base, name)) as out:
        out.write(data)
    return f"{uri}/{name}"


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 21) -> Iterator[None]:
    """What is written meanwhile reads texts by 512 rows and hands them to Python in batches of about ``size`` bytes, not of 10,000 rows: an executor holds several copies of each."""
    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": str(size), "spark.sql.parquet.columnarReaderBatchSize": "512"}
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def lean(f: Callable) -> Callable:
    """A function for mapInArrow that gives its memory back when a task ends. Workers are used again by later stages, and what allocators
    keep for themselves would add up over a pipeline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Returns what allocators keep for themselves to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def rows_of(batch: pa.RecordBatch, names: list[str], step: int = 256) -> Iterator[tuple]:
    """The rows of a batch as Python tuples, a few at a time."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(U64, copy=True)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x
