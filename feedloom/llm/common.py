"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
from collections import defaultdict
from itertools import chain

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch_path

#: Text handled at a time inside a task, in bytes (one longer document is handled alone, whole).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch on its way to a Python worker (one longer row is a batch of its own).
BATCH_BYTES = 4 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(col: str = "text"):
    """Text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def held_out(id_col, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; a NULL id counts as held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def slices(texts: list, limit: int = SLICE_BYTES):
    """Index ranges of consecutive texts of about ``limit`` bytes together."""
    i = size = 0
    for j, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def encode_words(words: list[list]) -> tuple[np.ndarray, np.ndarray, list]:
    """Flat type numbers of all words, words per text, and the types by number."""
    number = defaultdict()
    number.default_factory = number.__len__
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(lens.sum()))
    return flat, lens, list(number)


def bounds(lens: np.ndarray) -> np.ndarray:
    """0 and the running totals."""
    return np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over [ends[i], ends[i+1]); empty segments give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[ends[1:]] - total[ends[:-1]]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) on an unsigned array."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process (only for values that any task
    would compute alike)."""
    mod = sys.modules.setdefault("_feedloom_worker_cache", types.ModuleType("_feedloom_worker_cache"))
    return mod.__dict__.setdefault(name, {})


def release() -> None:
    """Give memory that is free but held by the allocators back to the system (idle workers stay alive)."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def tidy(run):
    """``run`` over a task's batches, the memory it leaves released at the end of the task."""
    def tidied(batches):
        yield from run(batches)
        release()
    return tidied


def share(spark: SparkSession, model):
    """Broadcast an object of this package's classes by value, so executors need no install."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shared_value(shared):
    return pickle.loads(shared.value)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python workers by bytes, whatever the length of a row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
