"""Removal of word passages that occur in an earlier document, by prefix-partitioned suffix trees.

Words are runs of anything but space and the control characters 9 to 13, taken unchanged; a window is
``WINDOW`` consecutive words of one document. A word goes if a window that covers it has the word sequence of a
window of a document with a smaller id. All windows are judged on the input.

1. Documents with one word sequence form a class; its smallest id stands for it, and all words of the others
   go. Only these first documents are looked at further.
2. The suffixes that matter start a window. The prefix by which a suffix is dealt out ends with its anchor: the
   rightmost smallest of the ``GRAM``-word hashes of its window, so its length varies from ``GRAM`` to ``WINDOW`` words,
   and equal windows have equal prefixes. Anchors that occur in one document only are dropped, after counting
   all of them; neighbouring suffixes with one anchor travel as one segment of words.
3. A group is one anchor. One that would hold more than ``MOST`` segments is dealt out over as many parts as it
   takes, so every group fits in memory.
4. A task builds the tree of the suffixes of its groups, cut at depth ``WINDOW``: ranks of 1, 2, 4 .. 32 words by
   doubling, then the sorted order of the suffixes. Its nodes of full depth with leaves in several documents
   are the repeats; every leaf but those of the smallest document is a repeated window.
5. Parts of one group decide all but the leaves of the smallest document of each node; these few meet by a
   128-bit hash of the window, which has no hot key any more.

Words are compared by 64-bit hashes, all ``WINDOW`` of them. Defined results: a null text has no words; a null
id is not smaller or larger than any, so such a row loses nothing and takes nothing; rows that repeat, and rows of one
id, never remove each other's words; empty tables give empty results; other columns are not read. A very long text is
cut into words in pieces and takes about 100 bytes of memory a word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from orderloom.llm.common import mix, prepare
from orderloom.session import scratch_path

WINDOW = 50
GRAM = 8
# Segments of one group, on average at most; a segment has at most 2 * WINDOW words.
MOST = 2048
# Words whose tree is built at once: whole groups, up to one group more than this.
AT_ONCE = 1 << 18
PIECE = 1 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]")
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_NOTHING = hashlib.sha256(b"").hexdigest()


def word_lists(text: str | None) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded length."""
    at, end = 0, len(text or "")
    while at < end:
        cut = SPACE.search(text, at + PIECE) if at + PIECE < end else None
        stop = cut.start() if cut else end
        yield WORD.findall(text, at, stop)
        at = stop


def hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def word_hashes(text: str | None) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *map(hashed, word_lists(text))])


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram hash at every word, and for every window the place of the rightmost smallest of its grams."""
    n = len(words) - GRAM + 1
    grams = np.full(n, GRAM, np.uint64)
    for step in range(GRAM):
        grams = mix(grams * _ROLL + words[step : step + n])
    least, place, width, span = grams, np.arange(n), 1, WINDOW - GRAM + 1
    while width < span:
        step = min(width, span - width)
        right = least[step:] <= least[:-step]
        least = np.where(right, least[step:], least[:-step])
        place = np.where(right, place[step:], place[:-step])
        width += step
    return grams, place


def _segments(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of every run with one anchor."""
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.diff(np.append(first, len(place)))


_READ = "doc_id bigint, text_key bigint, seq binary, n_words bigint, grams array<bigint>, counts array<int>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word sequence digest, number of words, and the anchors of every text with their number."""
    for batch in batches:
        digests, sizes, grams, counts = [], [], [], []
        for text in batch.column("text").to_pylist():
            digest, own, n = hashlib.sha256(), [], 0
            for words in word_lists(text):
                if words:
                    digest.update((" " * (n > 0) + " ".join(words)).encode())
                    own.append(hashed(words))
                    n += len(words)
            digests.append(digest.digest())
            sizes.append(n)
            if n < WINDOW:
                grams.append(None)
                counts.append(None)
                continue
            hashes, place = anchors(np.concatenate(own))
            value, times = np.unique(hashes[place[_segments(place)[0]]].view(np.int64), return_counts=True)
            grams.append(value)
            counts.append(times.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(grams, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
            ["doc_id", "text_key", "seq", "n_words", "grams", "counts"],
        )


_CUT = "gram bigint, part int, parts int, doc_id bigint, text_key bigint, start int, n_windows int, words binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of texts whose anchors are among the repeated ones."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [part.split()[0] for part in _CUT.split(", ")]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        rows = [batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "hits")]
        for doc, key, text, hits in zip(*rows, strict=True):
            words = word_hashes(text)
            grams, place = anchors(words)
            first, size = _segments(place)
            wanted = np.array([h["gram"] for h in hits], np.int64)
            parts = np.array([h["parts"] for h in hits], np.int64)
            order = np.argsort(wanted)
            own = grams[place[first]].view(np.int64)
            at = np.minimum(np.searchsorted(wanted[order], own), len(wanted) - 1)
            keep = np.flatnonzero(wanted[order][at] == own)
            first, size, own, many = first[keep], size[keep], own[keep], parts[order][at[keep]]
            salt = np.uint64(doc * int(_ROLL) & 0xFFFFFFFFFFFFFFFF)
            dealt = mix(first.astype(np.uint64) + salt) % many.astype(np.uint64)
            n = len(keep)
            values = (own, dealt.astype(np.int64), many, [doc] * n, [key] * n, first, size)
            for column, more in zip(columns, values, strict=False):
                column.extend(more.tolist() if isinstance(more, np.ndarray) else more)
            columns[-1] += [words[a : a + k + WINDOW - 1].tobytes() for a, k in zip(first.tolist(), size.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)


def _doubled(ranks: np.ndarray, step: int) -> np.ndarray:
    """Ranks of twice as many words: of each place, with the place ``step`` further on."""
    most = np.int64(ranks.max()) + 1
    further = np.zeros_like(ranks)
    further[:-step] = ranks[step:]
    return np.unique(ranks * most + further, return_inverse=True)[1]


def deep_nodes(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` in lexicographic order, and where in it the nodes of depth ``WINDOW`` begin.

    Ranks of runs of words double in length as in a suffix array; leaves of one node stand side by side.
    """
    ranks, width = np.unique(words, return_inverse=True)[1], 1
    while 2 * width <= WINDOW and len(words) > width:
        ranks, width = _doubled(ranks, width), 2 * width
    most = np.int64(ranks.max()) + 1
    depth = ranks[starts] * most + ranks[starts + WINDOW - width]
    order = np.argsort(depth, kind="stable")
    depth = depth[order]
    return order, np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1]]))


def _window_hashes(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of every window."""
    out = []
    for seed in (1, 2):
        value = np.full(len(starts), seed, np.uint64)
        for step in range(WINDOW):
            value = mix(value * _ROLL + words[starts + step] * np.uint64(2 * seed + 1))
        out.append(value.view(np.int64))
    return out


_FOUND = "doc_id bigint, text_key bigint, start int, stop int, high bigint, low bigint"


def _leaves(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Repeated runs of the groups in ``rows``, and the open windows of groups in several parts (with a hash)."""
    number = {c: rows.column(c).to_numpy() for c in ("parts", "doc_id", "text_key", "start", "n_windows")}
    column = rows.column("words")
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    words = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]].view(np.uint64)
    n = number["n_windows"]
    segment = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    starts = ((edges[:-1] - edges[0]) // 8)[segment] + inside
    docs = number["doc_id"][segment]
    order, nodes = deep_nodes(words, starts)
    first = np.empty(len(order), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(docs[order], nodes), np.diff(np.append(nodes, len(order))))
    again = docs > first
    begins = again & ~np.concatenate([[False], again[:-1] & (segment[1:] == segment[:-1])])
    ends = again & ~np.concatenate([again[1:] & (segment[1:] == segment[:-1]), [False]])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    open_ = np.flatnonzero(~again & (number["parts"][segment] > 1))
    at = np.concatenate([a, open_])
    where = number["start"][segment] + inside
    stops = np.concatenate([where[b], where[open_]]) + WINDOW
    none = pa.nulls(len(a), pa.int64())
    hashes = [pa.concat_arrays([none, pa.array(h)]) for h in _window_hashes(words, starts[open_])]
    out = [docs[at], number["text_key"][segment[at]], where[at].astype(np.int32), stops.astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, out), *hashes], [part.split()[0] for part in _FOUND.split(", ")])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; whole groups are put together until they are worth a tree."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += batch.column("words").nbytes // 8
        if total < AT_ONCE:
            continue
        rows = pa.concat_batches(held)
        gram, part = rows.column("gram").to_numpy(), rows.column("part").to_numpy()
        other = np.flatnonzero((gram != gram[-1]) | (part != part[-1]))
        whole = int(other[-1]) + 1 if len(other) else 0
        if whole:
            yield _leaves(rows.slice(0, whole))
        held = [rows.slice(whole)]
        total = held[0].column("words").nbytes // 8
    if held:
        yield _leaves(pa.concat_batches(held))


def _spared(words: np.ndarray | int, spans: list[dict]) -> np.ndarray:
    """For each of so many words whether no span covers it."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["stop"] for s in spans], -1)
    return np.cumsum(edge[:-1]) == 0


def _kept_words(text: str, spans: list[dict]) -> tuple[int, str]:
    """How many words go, and the rest."""
    words = [word for part in word_lists(text) for word in part]
    stays = _spared(len(words), spans)
    return int(len(words) - stays.sum()), " ".join([words[k] for k in np.flatnonzero(stays).tolist()])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_kept_words(*row) for row in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
        kept = [hashlib.sha256(text.encode()).hexdigest() for _, text in out]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([n for n, _ in out], pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "text_key", "n_removed", "kept_sha256"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
        kept = [_kept_words(text or "", spans or [])[1] for text, spans in rows]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.string())], ["doc_id", "text"])


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _once(docs: DataFrame) -> DataFrame:
    """Texts that can hold a window, one row for each id and text; rows that repeat meet before they are shuffled."""
    able = F.col("doc_id").isNotNull() & (F.length("text") >= 2 * WINDOW - 1)
    return _keyed(docs).where(able).groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))


@dataclass(frozen=True)
class Repeats:
    """What was found: ``read`` has one row per document, ``firsts`` one per word sequence, ``spans`` the words that go.

    ``spans`` (doc_id, text_key, start, stop, in words) is about first documents; they may overlap.
    """

    docs: DataFrame
    read: DataFrame
    firsts: DataFrame
    spans: DataFrame

    def _by_text(self) -> DataFrame:
        spans = F.collect_list(F.struct("start", "stop")).alias("spans")
        return self.spans.groupBy("doc_id", "text_key").agg(spans)

    def digest(self) -> DataFrame:
        """``doc_id, n_words, n_removed, kept_sha256`` of every row of the documents."""
        cut = _once(self.docs).join(self._by_text(), ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "spans")
        cut = cut.mapInArrow(_digest, "doc_id bigint, text_key bigint, n_removed bigint, kept_sha256 string")
        firsts = self.firsts.select("doc_id", "text_key", "seq").join(cut, ["doc_id", "text_key"], "left")
        firsts = firsts.select("seq", F.col("doc_id").alias("first_id"), "n_removed", "kept_sha256")
        copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
        changed = F.col("doc_id").isNotNull() & F.col("n_removed").isNotNull()

        def pick(of_copy: Column, of_changed: Column, otherwise: Column) -> Column:
            return F.when(copy, of_copy).when(changed, of_changed).otherwise(otherwise)

        return self.read.select("doc_id", "n_words", "seq").join(firsts, "seq", "left").select(
            "doc_id",
            "n_words",
            pick(F.col("n_words"), F.col("n_removed"), F.lit(0).cast("bigint")).alias("n_removed"),
            pick(F.lit(_NOTHING), F.col("kept_sha256"), F.lower(F.hex("seq"))).alias("kept_sha256"),
        )

    def texts(self) -> DataFrame:
        """``doc_id, text`` of every row of the documents: the kept words, with one space between them."""
        firsts = self.firsts.select("doc_id", "text_key", "seq").join(self._by_text(), ["doc_id", "text_key"], "left")
        firsts = firsts.select("seq", F.col("doc_id").alias("first_id"), "spans")
        every = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
        found = F.when(F.col("doc_id") > F.col("first_id"), every).when(F.col("doc_id").isNotNull(), F.col("spans"))
        spans = (
            self.read.select("doc_id", "text_key", "n_words", "seq").distinct().join(firsts, "seq")
            .select("doc_id", "text_key", found.alias("spans"))
        )
        return (
            _keyed(self.docs).join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
            .mapInArrow(_texts, "doc_id bigint, text string")
        )


def repeats(docs: DataFrame) -> Repeats:
    """Find the passages of ``docs`` (``doc_id, text``) that occur in a document with a smaller id."""
    prepare(docs.sparkSession)
    read = _written(_keyed(docs).mapInArrow(_read, _READ), "read")
    firsts = _written(
        read.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW))
        .groupBy("seq")
        .agg(F.min_by(F.struct("doc_id", "text_key", "grams", "counts"), F.struct("doc_id", "text_key")).alias("own"))
        .select("seq", "own.*"),
        "firsts",
    )
    own = firsts.select("doc_id", "text_key", F.explode(F.arrays_zip("grams", "counts")).alias("anchor"))
    own = own.select("doc_id", "text_key", F.col("anchor.grams").alias("gram"), F.col("anchor.counts").alias("n"))
    repeated = (
        own.groupBy("gram")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.sum("n").alias("n"))
        .where("least < most")
        .select("gram", F.ceil(F.col("n") / MOST).cast("int").alias("parts"))
    )
    hits = own.select("doc_id", "text_key", "gram").join(repeated, "gram")
    hits = hits.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "parts")).alias("hits"))
    segments = _once(docs).join(hits, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "hits").mapInArrow(_cut, _CUT)
    dealt = segments.repartition("gram", "part").sortWithinPartitions("gram", "part")
    found = _written(dealt.mapInArrow(_trees, _FOUND), "leaves")
    met = found.where("high is not null").groupBy("high", "low").agg(F.min("doc_id").alias("first_id"))
    late = found.where("high is not null").join(met, ["high", "low"]).where("doc_id > first_id")
    names = ["doc_id", "text_key", "start", "stop"]
    spans = found.where("high is null").select(names).unionByName(late.select(names))
    return Repeats(docs, read, firsts, spans)
