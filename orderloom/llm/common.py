"""What the text operators share: session settings, code shipping, word hashing, model hand-over."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.session import shared_folder

# Long texts make large rows, so Arrow batches are bounded by rows and by bytes.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
_SHIPPED = "_orderloom_shipped"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings and code that tasks of the text operators rely on."""
    for name, value in ARROW_CONF.items():
        spark.conf.set(name, value)
    context = spark.sparkContext
    if not getattr(context, _SHIPPED, False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        if os.path.isdir(root):
            folder = tempfile.mkdtemp(prefix="orderloom-code-")
            context.addPyFile(shutil.make_archive(f"{folder}/orderloom", "zip", root, "orderloom"))
        setattr(context, _SHIPPED, True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """``crc32(key as text) mod folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


# What the operators remember in a Python worker, which may serve one after the other.
_FORGET: dict[str, Callable[[], None]] = {}
_serving: str | None = None
# Longer words are not remembered, so that a number of words bounds the bytes they take.
LONG_WORD = 64


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """An operator that keeps something between batches says how to empty it."""
    _FORGET[operator] = forget


def serve(operator: str) -> None:
    """Called by the tasks of an operator: a worker that served another one forgets what that one kept."""
    global _serving
    if _serving == operator:
        return
    for other, forget in _FORGET.items():
        if other != operator:
            forget()
    if _serving is not None:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library has it
            pass
    _serving = operator


class WordHashes(dict):
    """Word to a 32-bit hash, remembered between batches; forgets all when it grows too large."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        if len(word) <= LONG_WORD:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int
) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` labelled documents outside the held-out fold.

    The choice is by a hash of the id, so it is the same on every run. Only ids and labels of that
    bounded choice are broadcast. Null ids and null labels never train; of several labels of one
    document the largest counts, of several texts the smallest.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
