"""Token ids in files, coded by a static range asymmetric numeral system (rANS).

A file holds the ids of some documents, in order. Its frequency table, scaled to 2^20, is shared by all
blocks of the file. A block is ``BLOCK`` ids dealt over ``LANES`` interleaved coder states of 64 bits, which
pass on 32 bits at a time; it starts from states of its own, so any block decodes without the others. The
index has a checkpoint per block: where it lies, its first id, and a checksum over its ids, which is tested
on decoding. Documents may cross blocks, files end with a document.

    "LOOMRANS" | u32 size of head | head (JSON: counts and sizes) | table | documents | index | blocks
    table: symbols u16[], frequencies u32[]; documents: ids i64[], null flags u8[], id counts i64[]
    index: byte u64[], first id u64[], ids u32[], checksum u32[]; table, documents and index by zlib
    block: states u64[LANES], words u32[] in the order in which the decoder takes them

Writing: documents are range-partitioned by id and sorted, each task writes files of about ``FILE_IDS`` ids
to the shared folder (through ``pyarrow.fs``: shared mounts, hdfs, object stores) under a temporary name that
is then moved, and returns their names. Only files named by finished tasks are read, so a lost executor costs
a task that writes the same files again. Reading: files are dealt over tasks; each is decoded block by block.
Offsets are sums of the tasks' totals (one row per task) and of file positions in the task.

A null or empty text has the end id alone. Rows with equal ids are ordered by text, null ids come first.
An empty table gives no file and no row.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orderloom.llm.common import prepare
from orderloom.llm.vocab import joined, vocabulary
from orderloom.session import scratch_path

MAGIC = b"LOOMRANS"
BITS = 20
LANES = 4096
BLOCK = 1 << 20
FILE_IDS = 1 << 22
LOW = np.uint64(1 << 31)
END_ID = 0
MANIFEST = "part int, file string, at bigint, n_ids bigint, n_docs bigint, n_bytes bigint"
DECODED = "part int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def table_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that occur and their frequencies, scaled to sum to 2^BITS with none below 1."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    size = 1 << BITS
    freqs = np.maximum(1, counts[symbols] * size // max(1, len(ids)))
    over = int(freqs.sum()) - size
    if over < 0:
        freqs[np.argmax(freqs)] -= over
    for k in np.argsort(-freqs, kind="stable"):
        if over <= 0:
            break
        less = min(over, int(freqs[k]) // 2)
        freqs[k] -= less
        over -= less
    return symbols.astype("<u2"), freqs.astype("<u4")


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    """One block, given the frequency and the start of every symbol."""
    state = np.full(LANES, LOW, np.uint64)
    words = []
    f_all, c_all = freq[ids], start[ids]
    for row in reversed(range(0, len(ids), LANES)):
        f, c = f_all[row : row + LANES], c_all[row : row + LANES]
        x = state[: len(f)]
        full = x >= f << np.uint64(63 - BITS)
        words.append(x[full].astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(f)] = (q << np.uint64(BITS)) + (x - q * f) + c
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, n: int, freq: np.ndarray, start: np.ndarray, symbol_at: np.ndarray) -> np.ndarray:
    """The ids of one block of ``n``."""
    state = np.frombuffer(data, "<u8", LANES).copy()
    words = np.frombuffer(data, "<u4", offset=8 * LANES).astype(np.uint64)
    out, at, mask = np.empty(n, np.uint16), 0, np.uint64((1 << BITS) - 1)
    for row in range(0, n, LANES):
        x = state[: min(LANES, n - row)]
        slot = x & mask
        got = symbol_at[slot]
        out[row : row + len(x)] = got
        x = freq[got] * (x >> np.uint64(BITS)) + slot - start[got]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << np.uint64(32)) | words[at : at + len(low)]
        at += len(low)
        state[: len(x)] = x
    if at != len(words) or (state != LOW).any():
        raise ValueError("block does not end where it began")
    return out


def _lookups(symbols: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    freq, start = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)
    freq[symbols] = freqs
    start[symbols] = np.cumsum(freqs, dtype=np.uint64) - freqs
    return freq, start


def file_bytes(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """A whole file of documents with their ids (16 bit)."""
    flat = np.frombuffer(b"".join(ids), "<u2")
    symbols, freqs = table_of(flat)
    freq, start = _lookups(symbols, freqs)
    blocks, firsts = [], range(0, len(flat), BLOCK)
    for first in firsts:
        blocks.append(encode_block(flat[first : first + BLOCK], freq, start))
    sizes = np.array([len(b) for b in blocks], np.int64)
    index = (
        (np.cumsum(sizes) - sizes).astype("<u8").tobytes()
        + np.array(firsts, "<u8").tobytes()
        + np.array([len(flat[f : f + BLOCK]) for f in firsts], "<u4").tobytes()
        + np.array([zlib.crc32(flat[f : f + BLOCK].tobytes()) for f in firsts], "<u4").tobytes()
    )
    docs = (
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
        + np.array([d is None for d in doc_ids], "u1").tobytes()
        + np.array([len(x) // 2 for x in ids], "<i8").tobytes()
    )
    parts = [zlib.compress(p, 6) for p in (symbols.tobytes() + freqs.tobytes(), docs, index)]
    head = json.dumps(
        {"symbols": len(symbols), "docs": len(doc_ids), "blocks": len(blocks), "sizes": [len(p) for p in parts],
         "lanes": LANES, "bits": BITS}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts, *blocks])


class Reader:
    """A file opened for decoding: its documents, and its blocks one at a time."""

    def __init__(self, source):
        self.source = source
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of this format")
        head = json.loads(source.read(struct.unpack("<I", source.read(4))[0]))
        if (head["lanes"], head["bits"]) != (LANES, BITS):
            raise ValueError("other lanes or bits than this reader has")
        table, docs, index = (zlib.decompress(source.read(size)) for size in head["sizes"])
        s, d, b = head["symbols"], head["docs"], head["blocks"]
        symbols, freqs = np.frombuffer(table, "<u2", s), np.frombuffer(table, "<u4", s, 2 * s)
        self.freq, self.start = _lookups(symbols, freqs)
        self.symbol_at = np.repeat(symbols, freqs)
        self.doc_ids = np.frombuffer(docs, "<i8", d)
        self.no_id = np.frombuffer(docs, "u1", d, 8 * d).astype(bool)
        self.counts = np.frombuffer(docs, "<i8", d, 9 * d)
        self.byte, self.first = np.frombuffer(index, "<u8", b), np.frombuffer(index, "<u8", b, 8 * b)
        self.size, self.check = np.frombuffer(index, "<u4", b, 16 * b), np.frombuffer(index, "<u4", b, 20 * b)
        self.data = source.tell()

    def block(self, k: int) -> np.ndarray:
        """The ids of block ``k``, whatever was read before."""
        self.source.seek(self.data + int(self.byte[k]))
        last = k + 1 == len(self.byte)
        data = self.source.read() if last else self.source.read(int(self.byte[k + 1] - self.byte[k]))
        ids = decode_block(data, int(self.size[k]), self.freq, self.start, self.symbol_at)
        if zlib.crc32(ids.astype("<u2").tobytes()) != self.check[k]:
            raise ValueError(f"block {k} fails its checksum")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """Id, token count and checksum over 32-bit ids of every document."""
        block, left = -1, np.empty(0, np.uint16)
        for doc, none, count in zip(self.doc_ids.tolist(), self.no_id.tolist(), self.counts.tolist(), strict=True):
            crc, need = 0, count
            while need:
                if not len(left):
                    block += 1
                    left = self.block(block)
                crc = zlib.crc32(left[:need].astype("<u4").tobytes(), crc)
                need, left = need - min(need, len(left)), left[need:]
            yield None if none else doc, count, crc


def write(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    plain_names: bool = True,
) -> DataFrame:
    """Encode all documents into files below ``folder``; returns their manifest, which is stored there too."""
    spark = prepare(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, k = TaskContext.get().partitionId(), 0, 0
        vocab, end = vocabulary(path, False, plain_names), np.array([end_id], "<u2").tobytes()
        files, base = fs.FileSystem.from_uri(folder)
        doc_ids: list[int | None] = []
        ids: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal at, k
            data, n, name = file_bytes(doc_ids, ids), sum(map(len, ids)) // 2, f"part-{part:05d}-{k:05d}.rans"
            hidden = f"{base}/.{name}.{uuid.uuid4().hex}"
            files.create_dir(base, recursive=True)
            with files.open_output_stream(hidden) as out:
                out.write(data)
            files.move(hidden, f"{base}/{name}")
            row = (part, name, at, n, len(doc_ids), len(data))
            at, k = at + n, k + 1
            doc_ids.clear()
            ids.clear()
            return pa.RecordBatch.from_pylist([dict(zip(_schema(MANIFEST).names, row, strict=True))], _schema(MANIFEST))

        held = 0
        for batch in joined(batches):
            got = vocab.encode(batch.column("text"))
            for doc, own in zip(batch.column("doc_id").to_pylist(), got, strict=True):
                doc_ids.append(doc)
                ids.append(own + end)
                held += len(ids[-1]) // 2
                if held >= file_ids:
                    held = 0
                    yield close()
        if doc_ids:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(encode, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files of a folder.

    ``start`` counts the ids of all documents before.
    """
    prepare(spark)
    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{base}/{row['file']}") as source:
                    at, out = row["at"], []
                    for doc, count, crc in Reader(source).documents():
                        out.append((row["part"], doc, at, count, crc))
                        at += count
                columns = zip(zip(*out, strict=True), _schema(DECODED), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, kind.type) for v, kind in columns], schema=_schema(DECODED))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        manifest.groupBy("part")
        .agg(F.sum("n_ids").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    found = manifest.select("part", "file", "at").repartition(parts, "file").mapInArrow(decode, DECODED)
    return found.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def roundtrip(docs: DataFrame, path: str | None = None, plain_names: bool = True) -> DataFrame:
    """Write all documents to a fresh folder of the shared one and read them back."""
    folder = scratch_path(docs.sparkSession, "rans")
    write(docs, folder, path, plain_names=plain_names)
    return read(docs.sparkSession, folder)
