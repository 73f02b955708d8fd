"""Byte-level BPE by a rank file: chunks encoded side by side, stitched where their pieces agree.

The pattern of the vocabulary cuts a text into pieces, and each piece's bytes are merged by rank. A text of
more than ``CHUNK`` characters is dealt out as rows of their own, chunks that reach ``OVERLAP`` characters into
the next one, and every chunk is cut into pieces and encoded by itself. Matching goes from left to right, looks
back at nothing and ahead at no more than ``AHEAD`` characters, so two chunks agree from the first place in
their overlap where both begin a piece: there the ids of the one end and those of the other go on. Where an
overlap has no such place (a run of letters longer than it), the two chunks are cut again as one. The chunks of
a long text come by row, in order, to a task that holds two of them at a time and hashes ids and bytes as they
pass; texts of one chunk are encoded where they are read, without a shuffle.

Pieces are remembered with their ids between texts, up to a bound. Decoding puts the bytes of all ids end to
end. A null or empty text has no ids; repeated rows, with or without an id, give repeated results; of two pairs of equal rank
the left one is joined first; all 256 single bytes need ranks, so that any text can be encoded. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import prepare, remembers, serve

CHUNK = 1 << 14
OVERLAP = 1 << 9
# Chunks handed on at once.
SLICES = 64
MOST_PIECES = 500_000
LONG_PIECE = 200
SHORT = 64
AHEAD = 4
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the pair of neighbours with the lowest rank is joined, leftmost first, until none has one."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > SHORT:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` with the pairs in a heap, so that a long piece costs n log n."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    gone, heap = bytearray(n), []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = n if gone[i] else after[i]
        if j >= n or end[j] != stop:
            continue
        gone[j], end[i], after[i] = 1, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if not gone[i]]


class Encoder(dict):
    """Piece to its ids (little-endian unsigned 16 or 32 bit), remembered between texts."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.kind = "<u2" if len(self.bytes_of) <= 1 << 16 else "<u4"
        self.words = [str(i) for i in range(len(self.bytes_of))]

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode("utf-8", "replace"), self.ranks), self.kind).tobytes()
        if len(piece) < LONG_PIECE:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, self.kind).tolist()))

    def written(self, ids: bytes) -> bytes:
        """Decimal ids joined by commas."""
        return ",".join(map(self.words.__getitem__, np.frombuffer(ids, self.kind).tolist())).encode()

    def digest(self, ids: bytes) -> tuple[int, str, str]:
        size = np.dtype(self.kind).itemsize
        return (
            len(ids) // size,
            hashlib.sha256(self.written(ids)).hexdigest(),
            hashlib.sha256(self.decode(ids)).hexdigest(),
        )


_OPEN: dict[tuple[str, str], Encoder] = {}
remembers("bpe", _OPEN.clear)


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, opened once per Python worker that serves no other operator in between."""
    serve("bpe")
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = Encoder(path, pattern)
    return _OPEN[path, pattern]


class Chunk:
    """A chunk's pieces: where each begins in the chunk, and its ids' place among the chunk's ids (in bytes)."""

    def __init__(self, begin: int, last: bool, lengths: np.ndarray, sizes: np.ndarray, ids: bytes):
        self.begin, self.last, self.lengths, self.sizes, self.ids = begin, last, lengths, sizes, ids
        edges, self.at = (np.concatenate([[0], np.cumsum(part, dtype=np.int64)]) for part in (lengths, sizes))
        self.starts = edges[:-1]
        # A piece near the end of a chunk that goes on may go on as well.
        self.sure = int(np.sum(edges[1:] <= edges[-1] - (0 if last else AHEAD)))

    @classmethod
    def cut(cls, coder: Encoder, text: str, begin: int, last: bool) -> Chunk:
        pieces = coder.pattern.findall(text)
        ids = list(map(coder.__getitem__, pieces))
        return cls(begin, last, np.array([len(p) for p in pieces], np.int64), np.array([len(x) for x in ids], np.int64), b"".join(ids))

    def text(self, coder: Encoder) -> str:
        """What the chunk was cut from: its ids say it."""
        return coder.decode(self.ids).decode("utf-8", "replace")

    def between(self, first: int, stop: int) -> bytes:
        """The ids of the pieces from ``first`` up to ``stop``."""
        return self.ids[int(self.at[first]) : int(self.at[stop])]


def stitched(coder: Encoder, chunks: Iterator[Chunk]) -> Iterator[bytes]:
    """The ids of a document from its chunks in order, two of which are held at a time."""
    now, first = next(chunks), 0
    for after in chunks:
        own, others = now.begin + now.starts[first : now.sure], after.begin + after.starts[: after.sure]
        common = np.intersect1d(own[own >= after.begin], others, assume_unique=True)
        if len(common):
            yield now.between(first, int(np.searchsorted(now.begin + now.starts, common[0])))
            now, first = after, int(np.searchsorted(others, common[0]))
            continue
        # No agreement: what is not certain, and the chunk after it, are cut again as one.
        certain = max(first, now.sure - 1)
        yield now.between(first, certain)
        start = int(now.starts[certain])
        text = now.text(coder)[start : after.begin - now.begin] + after.text(coder)
        now, first = Chunk.cut(coder, text, now.begin + start, after.last), 0
    yield now.between(first, len(now.starts))


class Digest:
    """Token count and hashes of the ids and of the decoded bytes, taken as ids pass."""

    def __init__(self, coder: Encoder):
        self.coder, self.size = coder, 0
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: bytes) -> None:
        if ids:
            self.ids.update(b"," * (self.size > 0) + self.coder.written(ids))
            self.decoded.update(self.coder.decode(ids))
            self.size += len(ids) // np.dtype(self.coder.kind).itemsize

    def row(self) -> tuple[int, str, str]:
        return self.size, self.ids.hexdigest(), self.decoded.hexdigest()


def _digests(ids: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    kinds = (pa.int64(), pa.string(), pa.string())
    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], [c.split()[0] for c in DIGEST.split(", ")])


_CHUNKS = "row_no bigint, doc_id bigint, chunk_no int, chunk string, is_last boolean"
_CUT = "row_no bigint, doc_id bigint, chunk_no int, is_last boolean, n_pieces int, lengths binary, sizes binary, ids binary"


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest takes."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _read_small(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}") if n else np.empty(0, np.uint8)


def digests(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document."""
    spark = prepare(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield _digests(batch.column("doc_id").to_pylist(), [coder.digest(coder.encode(text or "")) for text in texts])

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
        names = [part.split()[0] for part in _CHUNKS.split(", ")]
        for batch in batches:
            for row_no, doc, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                count = -(-(len(text) - overlap) // chunk)
                for first in range(0, count, SLICES):
                    numbers = range(first, min(first + SLICES, count))
                    texts = [text[k * chunk : (k + 1) * chunk + overlap] for k in numbers]
                    columns = [[row_no] * len(texts), [doc] * len(texts), list(numbers), texts, [k + 1 == count for k in numbers]]
                    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            made = [Chunk.cut(coder, r["chunk"], r["chunk_no"] * chunk, r["is_last"]) for r in batch.to_pylist()]
            # Neither the text, which the ids say, nor places, which lengths add up to, go with a chunk.
            columns = [[len(c.lengths) for c in made], [_small(c.lengths) for c in made], [_small(c.sizes) for c in made], [c.ids for c in made]]
            arrays = [pa.array(v, kind) for v, kind in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)]
            given = [batch.column(name) for name in ("row_no", "doc_id", "chunk_no", "is_last")]
            yield pa.RecordBatch.from_arrays([*given, *arrays], [part.split()[0] for part in _CUT.split(", ")])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per text; chunks come sorted by row and number."""
        coder = encoder(path, pattern)

        def chunks() -> Iterator[tuple[tuple, Chunk]]:
            for batch in batches:
                for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    row_no, doc, number, last, n, lengths, sizes, ids = row
                    yield (row_no, doc), Chunk(number * chunk, last, _read_small(lengths, n), _read_small(sizes, n), ids)

        for (_, doc), own in groupby(chunks(), key=lambda found: found[0]):
            digest = Digest(coder)
            for ids in stitched(coder, (found for _, found in own)):
                digest.add(ids)
            yield _digests([doc], [digest.row()])

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    n = F.length("text")
    short = rows.where(F.coalesce(n <= chunk + overlap, F.lit(True))).mapInArrow(whole, DIGEST)
    long = rows.where(n > chunk + overlap).select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")
    dealt = long.mapInArrow(sliced, _CHUNKS).repartition("row_no", "chunk_no")
    met = dealt.mapInArrow(cut, _CUT).repartition("row_no").sortWithinPartitions("row_no", "chunk_no")
    return short.unionByName(met.mapInArrow(joined, DIGEST))
