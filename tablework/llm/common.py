"""Shared pieces of the training-data operators: word rules, digests, row and batch helpers."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators import order

#: A word is a maximal run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
A_TO_Z = bytes.maketrans(_UPPER, _LOWER)
_SLICE = 512
#: Rows of the Arrow batches that texts travel in, unless the session has its own number.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean_batches(spark: SparkSession) -> None:
    """Let texts travel in small Arrow batches from now on: a batch of Spark's usual 10,000 rows is some 30 MB of text, which
    the executor and its Python worker hold several times over. A session with its own number keeps it."""
    if spark.conf.get(_BATCH, None) in (None, "10000"):
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, with small Arrow batches on the way."""
    conf = df.sparkSession.conf
    before = conf.get(_BATCH, None)
    lean_batches(df.sparkSession)
    try:
        return order.materialize(df, name)
    finally:
        conf.unset(_BATCH) if before is None else conf.set(_BATCH, before)


def lean(function):
    """A ``mapInArrow`` function that gives memory back when its task ends, as idle workers keep what they held."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def settle(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for a large step: the driver then forgets the step's plan, so that Spark removes its
    shuffle files from the executors' disks now and not at the next half-hourly collection."""
    out = materialize(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def word_count(text: str | Column) -> Column:
    """Number of words as long; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; splitting bytes cuts at exactly the six ASCII blanks of ``WORD``."""
    return raw.split() if raw else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that sums of hashes spread over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words, in order; empty if there are fewer words.

    A polynomial modulo 2**64, taken from running totals, so the cost does not depend on ``k``.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    falling = np.full(len(hashes), _INVERSE, np.uint64)
    falling[0] = 1
    rising = np.full(n, _ODD, np.uint64)
    rising[0] = 1
    total = np.r_[np.uint64(0), np.cumsum(mix(hashes) * np.cumprod(falling))]
    return mix((total[k:] - total[:-k]) * np.cumprod(rising))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def raw_texts(array: pa.Array):
    """Yield every text of a string column as UTF-8 bytes or None, a few hundred rows at a time."""
    for at in range(0, len(array), _SLICE):
        yield from array.slice(at, _SLICE).cast(pa.large_binary()).to_pylist()


def texts(array: pa.Array):
    for at in range(0, len(array), _SLICE):
        yield from array.slice(at, _SLICE).to_pylist()


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def fresh(prefix: str, taken) -> str:
    """A column name that no column of the input has, whatever its case."""
    low = {c.lower() for c in taken}
    name, i = prefix, 0
    while name.lower() in low:
        i += 1
        name = f"{prefix}{i}"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same_regex(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)
