"""Shared helpers: shared-folder tables, Arrow batching, vectorised hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Java's and Python's escapes agree here: everything but space and tab..carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = (9, 10, 11, 12, 13, 32)
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_bytes(docs: DataFrame, text: str) -> int:
    """About the bytes of the input: of its files as Catalyst knows them, else of its texts."""
    known = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if known < 1 << 56:  # frames that are no files have no size of their own but a very large one
        return known
    return int(docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0) // 2


def n_words(text: str | Column) -> Column:
    """Number of words of a text, 0 for null, with built-in functions only."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is named, a temporary one, but only for
    a local master: on a cluster each machine would write to its own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="tallyforge-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame, name: str, tidy: bool = True) -> DataFrame:
    """Write df to the shared folder and read it back, so that no later step recomputes it. tidy:
    after a great step, let the driver drop what nothing refers to, and so its shuffle files go."""
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    del df
    if tidy:
        gc.collect()
        spark._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out._cut_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables made by cut() that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._cut_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def pieces(column: pa.Array, most: int = 4 << 20):
    """(start, stop) row ranges of a text column that hold about `most` bytes each."""
    start, held = 0, 0
    size = pa.compute.binary_length(column.cast(pa.large_binary())).fill_null(0).to_pylist()
    for i, n in enumerate(size):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(size):
        yield start, len(size)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def freed(run, forget=None):
    """run, a function of batches, with memory given back at the end of a task, and forget() called."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            give_back()

    return whole


def freed_group(run):
    """run, a function of a group's table, with memory given back after it."""

    def whole(part):
        try:
            return run(part)
        finally:
            give_back()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (the public splitmix64 constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_table(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
