"""Concatenate and cut: documents end to end, in fixed windows of ``WINDOW`` tokens.

Pass 1 gives every document its ids and an end id, and its offset among the documents of its task; the
rows are written once to the shared folder, since both passes need them. The totals of the tasks, one row
each, are summed from the left to global offsets. Pass 2 cuts every document at the window borders: a
boundary record (piece) is a run of one document's ids in one sequence. Sequences are full, but for the
last one, so padding is less than one window in all. Nothing is sorted or shuffled but the totals.

The order of documents is that of the input's partitions. A null or empty text is the end id alone, a
repeated row is packed again, a null id is kept. An empty table gives no piece. A document of any length
is cut into as many pieces as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import prepare
from orderloom.llm.vocab import LEAN_PARTS, LEAN_ROWS, ROWS, joined, vocabulary
from orderloom.session import scratch_path

WINDOW = 4096
END_ID = 2
TOKENS = "part int, doc_id bigint, at bigint, n bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def tokens(
    docs: DataFrame, path: str, end_id: int, drops_space: bool, plain_names: bool = True, lean: bool = False
) -> DataFrame:
    """Per document its task's number, its offset there, its token count and its ids (16 bit)."""
    most_parts, most_rows = (LEAN_PARTS, LEAN_ROWS) if lean else (None, ROWS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        vocab, end = vocabulary(path, drops_space, plain_names, most_parts), np.array([end_id], "<u2").tobytes()
        for batch in joined(batches, most_rows):
            ids = [got + end for got in vocab.encode(batch.column("text"))]
            n = np.array([len(x) // 2 for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), batch.column("doc_id"), pa.array(starts), pa.array(n),
                 pa.array(ids, pa.binary())],
                schema=_schema(TOKENS),
            )

    return docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(encode, TOKENS)


def bases(rows: DataFrame) -> DataFrame:
    """``part, base``: the tokens of all parts before. One row per task of pass 1."""
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(
    docs: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    drops_space: bool = True,
    plain_names: bool = True,
    lean: bool = False,
) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32 bit).

    ``lean`` trades CPU seconds for bytes in the Python workers; the ids are the same.
    """
    spark = prepare(docs.sparkSession)
    path = path or public_tokenizers.path("word_bpe_49k.json")
    stored = scratch_path(spark, "tokens")
    tokens(docs, path, end_id, drops_space, plain_names, lean).write.parquet(stored)
    rows = spark.read.parquet(stored)
    placed = rows.join(F.broadcast(bases(rows)), "part").withColumn("at", F.col("base") + F.col("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, at, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start, ids = 0, np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                while start < n:
                    offset = (at + start) % window
                    length = min(window - offset, n - start)
                    out.append((doc, start, length, n, (at + start) // window, offset, ids[4 * start : 4 * (start + length)]))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind.type) for values, kind in zip(zip(*out, strict=True), _schema(PIECES), strict=True)]
                if out
                else [pa.array([], kind.type) for kind in _schema(PIECES)],
                schema=_schema(PIECES),
            )

    return placed.select("doc_id", "at", "n", "ids").mapInArrow(cut, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum over their ids instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
