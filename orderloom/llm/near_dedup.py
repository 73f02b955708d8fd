"""Near-duplicate groups by b-bit MinHash, every link confirmed on whole shingle sets.

1. Every text is lower-cased (A-Z), cut into words, and its set of 5-word shingles hashed to 64 bits (fewer
   words: all of them as one shingle). Texts with equal sets form one class, named by a 128-bit digest of
   the set; only classes go on.
2. A class has ``PERMUTATIONS`` minima. Bands of ``ROWS`` minima give its buckets; the low ``LOW_BITS`` bits of
   all minima, packed, are its signature. A pair with similarity 0.75 shares no bucket with probability
   (1 - 0.75^4)^32 = 5e-6.
3. Stars: the members of a bucket are paired with the bucket's smallest class. Linked pairs are united
   (connected components), which settles nearly all of a large group at a cost linear in its size.
4. The rest, exactly: a bucket that still holds several components is dealt out as pairs of blocks of about
   ``BLOCK`` members, over as many lanes as the root of its blocks. One task compares the signatures of two blocks, leaving out pairs that share an earlier
   bucket. Members with a partner in another component whose estimated similarity, corrected for chance
   agreement of low bits, reaches ``SLACK`` below the threshold are looked at again: their whole sets meet by
   bucket, in pairs of blocks of about ``SET_BLOCK``, and a task counts all intersections of two blocks at once.
   It returns links that join components, at most one less than it has members. (The estimate has a
   standard error of 0.04 at 0.75, so the slack is five of them.) Then the components of all links are taken.

Nothing is capped and no pairs are written out: a pair that shares a bucket is either in one component already
or compared. A link counts if 100 * intersection >= 75 * union of the full sets. Classes, links and components
are tables in the shared folder. Rows with an equal id are taken as they are; a null id forms groups like any
other but is never a group's name unless it is alone. Texts without words are linked with nothing. Rows that repeat
are one class; a very long text is one set in the memory of a task; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import LONG_WORD, mix, prepare, remembers, serve
from orderloom.session import scratch_path

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
PERMUTATIONS = BANDS * ROWS
LOW_BITS = 8
SLACK = 0.22
BLOCK = 1024
SET_BLOCK = 64
COLUMNS = 1 << 16
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_RANDOM = np.random.default_rng(20_011)
_TIMES = (_RANDOM.integers(0, 1 << 32, PERMUTATIONS, np.uint32) | np.uint32(1))[:, None]
_PLUS = _RANDOM.integers(0, 1 << 32, PERMUTATIONS, np.uint32)[:, None]
_ROLL = np.uint64(0x9E3779B97F4A7C15)


class Codes(dict):
    """Word to a 64-bit code, remembered between batches; forgets all when it grows too large."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        raw = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        value = int.from_bytes(raw, "little")
        if len(word) <= LONG_WORD:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value


_CODES = Codes()
remembers("near_dedup", _CODES.clear)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = WORD.findall(text.translate(LOWER)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    n, k = max(1, len(words) - SHINGLE + 1), min(SHINGLE, len(words))
    out = np.full(n, k, np.uint64)
    for step in range(k):
        out = mix(out * _ROLL + codes[step : step + n])
    return np.unique(out)


def minima(own: np.ndarray) -> np.ndarray:
    """The smallest value of a set under every permutation (32 bit)."""
    low = (own >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        x = low[None, at : at + 2048] * _TIMES + _PLUS
        x ^= x >> np.uint32(15)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def bands(smallest: np.ndarray) -> np.ndarray:
    """One bucket number per band."""
    rows = smallest.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = mix(out * _ROLL + rows[:, k])
    return out.view(np.int64)


def packed(smallest: np.ndarray) -> bytes:
    """The low bits of all minima."""
    return (smallest & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint8).tobytes()


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of each of the signatures ``a`` with each of ``b``, corrected for chance agreement."""
    if len(a) * len(b) <= 1024:
        same = (a[:, None, :] == b[None, :, :]).sum(2)
    else:
        same = np.zeros((len(a), len(b)), np.int16)
        for x, y in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T), strict=True):
            same += x[:, None] == y[None, :]
    chance = 2.0**-LOW_BITS
    return (same / PERMUTATIONS - chance) / (1 - chance)


_SIGNED = "doc_id bigint, n_shingles bigint, set_key binary, buckets array<bigint>, signature binary, text_hash bigint"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serve("near_dedup")
    for batch in batches:
        sizes, keys, buckets, signatures = [], [], [], []
        for text in batch.column("text").to_pylist():
            own = shingles(text)
            sizes.append(len(own))
            if not len(own):
                keys.append(None)
                buckets.append(None)
                signatures.append(None)
                continue
            smallest = minima(own)
            keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            buckets.append(bands(smallest))
            signatures.append(packed(smallest))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.binary()), *batch.columns[2:]],
            ["doc_id", "n_shingles", "set_key", "buckets", "signature", *batch.schema.names[2:]],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serve("near_dedup")
    for batch in batches:
        own = [shingles(text).tobytes() for text in batch.column("text").to_pylist()]
        keys = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in own]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(own, pa.binary())], ["set_key", "own"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b")], ["a", "b"]
        ).filter(pa.array(keep, pa.bool_()))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of two blocks that may be linked with one of another component."""
    serve("near_dedup")
    least = PERCENT / 100 - SLACK
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            sides, bucket = (row["few"], row["all"]), row["bucket"]
            codes: dict[bytes, int] = {}
            own = [np.array([codes.setdefault(m["component"], len(codes)) for m in side]) for side in sides]
            signs = [np.frombuffer(b"".join(m["signature"] for m in side), np.uint8).reshape(len(side), -1) for side in sides]
            good = own[0][:, None] != own[1][None, :]
            placed = [np.array([m["buckets"] for m in side], np.int64) for side in sides]
            for band in range(int(np.flatnonzero(placed[0][0] == bucket)[0])):
                good &= placed[0][:, band][:, None] != placed[1][:, band][None, :]
            if good.any():
                good &= estimates(*signs) >= least
            for side, some in zip(sides, (good.any(1), good.any(0)), strict=True):
                found += [(bucket, side[k]["set_key"], side[k]["component"]) for k in np.flatnonzero(some)]
        columns = zip(*found, strict=True) if found else ([], [], [])
        arrays = [pa.array(v, kind) for v, kind in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "set_key", "component"])


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all sets of two lists."""
    flat = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(shared), COLUMNS):
        columns = shared[first : first + COLUMNS]
        has = []
        for side in (left, right):
            matrix = np.zeros((len(side), len(columns)), np.float32)
            for k, own in enumerate(side):
                at = np.searchsorted(columns, own)
                at[at == len(columns)] = 0
                matrix[k, at[columns[at] == own]] = 1
            has.append(matrix)
        out += has[0] @ has[1].T
    return out.astype(np.int64)


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between members of two blocks that join components."""
    serve("near_dedup")
    for batch in batches:
        found_a, found_b = [], []
        for row in batch.to_pylist():
            sides = (row["left"], row["right"])
            sets = [[np.frombuffer(m["own"], np.uint64) for m in side] for side in sides]
            sizes = [np.array([len(own) for own in side]) for side in sets]
            both = intersections(*sets)
            linked = 100 * both >= PERCENT * (sizes[0][:, None] + sizes[1][None, :] - both)
            name = {m["component"]: m["component"] for side in sides for m in side}

            def root(x: bytes, name: dict[bytes, bytes] = name) -> bytes:
                while name[x] != x:
                    name[x] = name[name[x]]
                    x = name[x]
                return x

            for i, j in zip(*np.nonzero(linked), strict=True):
                a, b = sides[0][i], sides[1][j]
                x, y = root(a["component"]), root(b["component"])
                if x != y:
                    name[x] = y
                    found_a.append(a["set_key"])
                    found_b.append(b["set_key"])
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], ["a", "b"])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, component`` for every end of a link (``a, b``); a component is named by its smallest node.

    Rounds of large and small stars: every node hands its smallest neighbour first to its larger
    neighbours, then to its smaller ones, until nothing changes. The number of rounds grows with the
    logarithm of the longest chain, the number of links does not grow. After a fixed number of ``rounds``
    nodes of one name are connected, but connected nodes may still have several names.
    """
    pairs = _kept(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    state, done = None, 0
    while rounds is None or done < rounds:
        if rounds is None:
            now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
            if now == state:
                break
            state = now
        both = pairs.union(pairs.select("b", "a"))
        # Read from tables, so that each join is one of two plain shuffles, which Spark splits where a centre is in most links.
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        low = _kept(low.select("node", F.least("node", "least").alias("least")), "least")
        large = both.where("b > a").join(low, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = _kept(large, "large")
        low = _kept(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
        small = large.join(low, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        pairs, done = _kept(small.where("a <> b").union(low).distinct(), "links"), done + 1
    named = pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(pairs.select("b", "b"))
    return named.groupBy("node").agg(F.min("component").alias("component"))


def _confirmed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of classes that are linked, decided on their whole sets."""
    a = sets.select(F.col("set_key").alias("a"), F.col("own").alias("own_a"))
    b = sets.select(F.col("set_key").alias("b"), F.col("own").alias("own_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_linked, "a binary, b binary")


def _lanes(size: int) -> Column:
    """Lanes of a bucket of ``n`` members in blocks of ``size``: the square root of the number of blocks."""
    return F.ceil(F.sqrt(F.ceil(F.col("n") / size))).cast("bigint")


def _dealt(blocks: DataFrame, members: str, size: int) -> DataFrame:
    """The blocks of a bucket, dealt out over its lanes."""
    return blocks.select("bucket", "block", (F.col("block") % _lanes(size)).alias("lane"), members)


def _copied(blocks: DataFrame, members: str, size: int) -> DataFrame:
    """The blocks of a bucket, once for each of its lanes."""
    lanes = F.sequence(F.lit(0).cast("bigint"), _lanes(size) - 1)
    return blocks.select("bucket", "block", F.explode(lanes).alias("lane"), members)


def class_components(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """``node, component`` of all classes with a link; both are set digests."""
    classes = _kept(
        signed.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"),
            F.first("buckets").alias("buckets"), F.first("signature").alias("signature"),
        ),
        "classes",
    )
    placed = classes.select("set_key", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = _kept(placed.join(shared, "bucket"), "members")

    # Whole sets of the classes that meet another one, made again from one text of each class.
    # Rows without an id are named by their text, one for each, so that they do not meet under one key.
    meeting = members.select("set_key").distinct().join(classes, "set_key")
    meeting = meeting.select(F.coalesce("one.doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("one.none").alias("none"), F.col("one.text_hash").alias("hash")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("hash"), "text")
    nameless = texts.where("id IS NULL").groupBy("hash").agg(F.first("text").alias("text"))
    zero, no, yes = F.lit(0).cast("bigint").alias("id"), F.lit(False).alias("none"), F.lit(True).alias("none")
    texts = texts.where("id IS NOT NULL").select("id", no, "hash", "text").union(nameless.select(zero, yes, "hash", "text"))
    sets = texts.join(meeting, ["id", "none", "hash"]).select("text").mapInArrow(_sets, "set_key binary, own binary")
    sets = _kept(sets.join(members.select("set_key").distinct(), "set_key").dropDuplicates(["set_key"]), "sets")

    centers = members.groupBy("bucket").agg(F.min("set_key").alias("center"))
    stars = members.join(centers, "bucket").where("set_key <> center")
    stars = stars.select(F.col("center").alias("a"), F.col("set_key").alias("b")).distinct()
    # Two rounds unite most of a group; what they leave apart is compared below.
    found = _kept(components(_confirmed(sets, stars), rounds=2), "components")

    named = members.join(found.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn(
        "component", F.coalesce("component", "set_key")
    )
    mixed = named.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = mixed.where("least <> most")
    rest = _kept(named.join(mixed, "bucket").join(classes.select("set_key", "signature", "buckets"), "set_key"), "rest")
    member = F.struct("set_key", "component", "signature", "buckets")
    block = F.pmod(F.xxhash64("set_key"), F.ceil(F.col("n") / BLOCK)).alias("block")
    # Members of the bucket's largest-named component meet all others, but not each other.
    few = rest.where("component <> most").groupBy("bucket", "n", block).agg(F.collect_list(member).alias("few"))
    every = rest.groupBy("bucket", "n", block).agg(F.collect_list(member).alias("all"))
    met = _dealt(few, "few", BLOCK).join(_copied(every, "all", BLOCK), ["bucket", "lane"]).drop("lane", "block")
    again = _kept(met.mapInArrow(_compare, "bucket bigint, set_key binary, component binary").distinct(), "again")

    counts = again.groupBy("bucket").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("set_key"), F.ceil(F.col("n") / SET_BLOCK)).alias("block")
    whole = again.join(counts, "bucket").join(sets, "set_key").groupBy("bucket", "n", block)
    whole = _kept(whole.agg(F.collect_list(F.struct("set_key", "component", "own")).alias("members")), "whole")
    left = _dealt(whole.withColumnRenamed("members", "left"), "left", SET_BLOCK).withColumnRenamed("block", "i")
    right = _copied(whole.withColumnRenamed("members", "right"), "right", SET_BLOCK).withColumnRenamed("block", "j")
    met = left.join(right, ["bucket", "lane"]).where("i <= j").select("left", "right")
    more = met.mapInArrow(_joining, "a binary, b binary")
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def _with_components(docs: DataFrame, keyed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component`` of every document, and ``text_key``, a digest of its text, if ``keyed``."""
    prepare(docs.sparkSession)
    own, schema, more = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text", "xxhash64(text) AS text_hash"), _SIGNED, []
    if keyed:
        own, schema, more = own.withColumn("text_key", _text_key()), f"{_SIGNED}, text_key binary", ["text_key"]
    signed = _kept(own.mapInArrow(_sign, schema), "signed")
    found = _kept(class_components(docs, signed), "components")
    rows = signed.select("doc_id", "n_shingles", "set_key", *more).join(
        found.withColumnRenamed("node", "set_key"), "set_key", "left"
    )
    return rows.withColumn("component", F.coalesce("component", "set_key"))


def _text_key() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; one row out per row in."""
    rows = _with_components(docs)
    names = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = _kept(names, "names")  # a join of two plain shuffles, which Spark splits where a component is large
    told = rows.join(names, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return told.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The input's rows of exactly one document per group, with all columns.

    That is the row with the smallest id, of these the one with the smallest digest of its text; a row without an
    id comes last. Of equal rows of that id and text one stays. Rows whose text has no words belong to no group and all stay.
    """
    rows = _with_components(docs.select("doc_id", "text"), keyed=True).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    chosen = rows.groupBy("component").agg(first).select(F.col("first.doc_id").alias("id"), F.col("first.text_key").alias("key"))
    chosen = _kept(chosen, "kept")
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    key, at = ("_" * k + max(docs.columns, key=len) for k in (1, 2))
    named = docs.where(words).withColumn(key, _text_key())
    named = named.join(chosen, (F.col(key) == chosen["key"]) & docs["doc_id"].cast("bigint").eqNullSafe(chosen["id"]), "left_semi")
    order = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(key))
    one = named.withColumn(at, order).where(F.col(at) == 1).drop(key, at)
    return one.unionByName(docs.where(~words))
