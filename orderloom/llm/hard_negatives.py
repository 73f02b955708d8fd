"""Hard negatives by exact scores from a residue-number-system matrix product.

Vectors are quantised to whole numbers. A score is the inner product of two rows, exact at any size that
64 bits hold: both matrices are taken modulo several primes below 1024, the residues (at most 511 in size) are
multiplied as float32 matrices, ``DEPTH`` components at a time (all at once where the lengths of the residues
allow it) so that no sum leaves the range that float32 holds
exactly, and the signed score is put together again from its residues by the Chinese remainder theorem. How many
primes it takes follows from the lengths of the vectors of two blocks (a score is at most the product of the
lengths).

1. Rows are packed into blocks, once: anchors into blocks of ``ANCHORS``, all rows into blocks of ``ROWS``, none
   over ``BLOCK_BYTES``, in files of small row groups. A block is in order of label and id.
2. Every block of rows meets every block of anchors: a task reads its share of the blocks of rows from the files,
   one after the other, for its share of the anchors. No block of rows is copied, and no pair of rows.
3. A task keeps the best ``n_positives`` rows with the anchor's label for every anchor while blocks pass (an anchor
   is multiplied only with the labels of its tile of ``TILE``), and returns them at the end; a windowed selection
   over all of them keeps as many per anchor.
4. The anchors go round once more with their positives. The rows of another label whose score lies between two
   shares of a positive's score are selected in the same way.

Nothing is capped: ties at the border of a selection are all looked at, and the smaller id wins. No pair of rows
leaves a task but those selected in all its blocks.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part; rows that
repeat are rows of their own (as anchors once), but a row with the anchor's id is never its positive;
missing components at the end of a shorter vector count as 0; an anchor without positives or
negatives gives no rows; empty tables give none; other columns are not read. A component or score that 64 bits cannot hold is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import prepare
from orderloom.session import scratch_path

ROWS = 8192
ANCHORS = 8192
# Bytes of the vectors of a block, and of a row group of blocks: a reader holds a row group at once.
BLOCK_BYTES = 2 << 20
GROUP_BYTES = 8 << 20
# Rows and anchors whose scores are held at once; rows at first, while all of them are among the best.
STEP = 1024
TILE = 256
LEAST = 64
# Components multiplied before residues are taken again: 64 * 511 * 511 + 1024 < 2 ** 24.
DEPTH = 64
# The largest primes below 1024. Seven of them span more than 64 bits.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
# Whole numbers that float32 holds and that are still held when the nearest multiple of a prime is taken away;
# what is left is at most ``NEAREST`` (the quotient's rounding may miss the nearest multiple by little).
EXACT, NEAREST = (1 << 24) - 1024, 516
MOST = np.iinfo(np.int64).max
NONE = -MOST


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all whole numbers from ``-bound`` to ``bound`` apart, with room for rounded quotients."""
    if bound >= 1 << 63:
        raise OverflowError("a score does not fit in 64 bits")
    n = 1
    while 10 * math.prod(PRIMES[:n]) <= 21 * bound:
        n += 1
    return PRIMES[:n]


def centred(values, prime: int):
    """The residues nearest to 0."""
    half = prime // 2
    return (values + half) % prime - half


def take_multiples(values: np.ndarray, prime: int, spare: np.ndarray) -> None:
    """Takes multiples of a prime away in place, so that whole numbers in float32 are at most ``NEAREST``."""
    np.multiply(values, np.float32(1 / prime), out=spare)
    np.rint(spare, out=spare)
    np.multiply(spare, np.float32(prime), out=spare)
    np.subtract(values, spare, out=values)


def longest(vectors: np.ndarray) -> float:
    """The largest length of a row."""
    return math.sqrt(float((vectors.astype(np.float64) ** 2).sum(1).max(initial=0)))


class Residues:
    """Vectors of whole numbers with their residues modulo the primes, made when first asked for."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.longest = vectors, longest(vectors)
        self.largest = int(np.abs(vectors).max(initial=0))
        self._made: dict[tuple[int, int], tuple[np.ndarray, float]] = {}

    def modulo(self, prime: int, weight: int = 1) -> tuple[np.ndarray, float]:
        """The residues of ``weight`` times the vectors in float32, and the largest length of a row."""
        if (prime, weight) not in self._made:
            if weight == 1 and self.largest <= prime // 2:
                self._made[prime, weight] = self.vectors.astype(np.float32), self.longest
            else:
                whole = centred(self.vectors.astype(np.int64) % prime * weight, prime)
                self._made[prime, weight] = whole.astype(np.float32), longest(whole)
        return self._made[prime, weight]


def bound_of(a: float, b: float) -> int:
    """No inner product of rows of these lengths, nor a part of its sum, is larger than this."""
    return math.ceil(a * b * (1 + 1e-9)) + 1


class Product:
    """The exact inner products of the rows of ``a`` with those of ``b``, a tile at a time.

    A score is ``d1 + p1 * (d2 + p2 * (d3 + ...))`` with digits around 0. The residues of the later primes are
    weighted, so that a product less what the earlier digits make of it is the next digit modulo its prime.
    """

    def __init__(self, a: Residues, b: Residues):
        bound = bound_of(a.longest, b.longest)
        self.primes = primes_for(bound)
        self.kind = next(k for k, most in ((np.float32, 1 << 24), (np.float64, 1 << 53), (np.int64, math.inf)) if bound + 2 * NEAREST <= most)
        self._width = min(a.vectors.shape[1], b.vectors.shape[1])
        self._factors = []
        for k, prime in enumerate(self.primes):
            weight = centred(pow(math.prod(PRIMES[:k]), -1, prime), prime)
            (left, far), (right, wide) = a.modulo(prime, weight), b.modulo(prime)
            earlier = [centred(math.prod(PRIMES[:j]) * weight, prime) for j in range(k)]
            self._factors.append((prime, left, right, bound_of(far, wide), earlier))
        self._spares: list[np.ndarray] = []

    def _spare(self, number: int, shape: tuple[int, int]) -> np.ndarray:
        size = shape[0] * shape[1]
        if number == len(self._spares):
            self._spares.append(np.empty(0, np.float32))
        if len(self._spares[number]) < size:
            self._spares[number] = np.empty(size, np.float32)
        return self._spares[number][:size].reshape(shape)

    def tile(self, rows: slice, columns: slice) -> np.ndarray:
        """Scores of some rows of ``a`` with some of ``b``, in a kind that holds them; good until the next call."""
        digits: list[np.ndarray] = []
        for k, (prime, left, right, most, earlier) in enumerate(self._factors):
            left, right = left[rows, : self._width], right[columns, : self._width]
            shape = len(left), len(right)
            spare, out = self._spare(0, shape), self._spare(k + 1, shape)
            if most <= EXACT:
                np.matmul(left, right.T, out=out)
            else:
                out[:] = 0
                for at in range(0, self._width, DEPTH):
                    np.matmul(left[:, at : at + DEPTH], right[:, at : at + DEPTH].T, out=spare)
                    out += spare
                    take_multiples(out, prime, spare)
                most = NEAREST
            if most + NEAREST * sum(map(abs, earlier)) > EXACT:
                take_multiples(out, prime, spare)
            for digit, times in zip(digits, earlier, strict=True):
                np.multiply(digit, np.float32(times), out=spare)
                np.subtract(out, spare, out=out)
            take_multiples(out, prime, spare)
            digits.append(out)
        score = digits.pop().astype(self.kind, copy=False)
        for prime, digit in zip(self.primes[-2::-1], reversed(digits), strict=True):
            score *= prime
            score += digit.astype(self.kind, copy=False)
        return score


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of all rows of ``a`` with all rows of ``b`` (int64)."""
    return Product(Residues(a), Residues(b)).tile(slice(None), slice(None)).astype(np.int64)


# --- blocks -------------------------------------------------------------------

_BLOCK = "block string, n int, ids binary, labels binary, width int, vectors binary"
_KINDS = (np.int16, np.int32, np.int64)


def quantised(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` of every vector, padded to the longest, and which of them take part."""
    n = len(column)
    sizes = column.value_lengths().fill_null(0).to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(n), sizes)
    good = column.is_valid().to_numpy(zero_copy_only=False).copy()
    good[row[~np.isfinite(values)]] = False
    out = np.zeros((n, int(sizes.max(initial=0))), np.float64)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, inside] = values
    out = np.floor(out[good] * scale)
    if len(out) and out.size and np.abs(out).max() >= 2.0**62:
        raise OverflowError("a component does not fit in 64 bits")
    return out.astype(np.int64), good


def kind_of(whole: np.ndarray) -> type:
    """The smallest kind that holds these numbers."""
    return next(k for k in _KINDS if not whole.size or np.abs(whole).max() <= np.iinfo(k).max)


def _packer(scale: float, most: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        labels: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        widths: list[int] = []  # in bytes

        def block() -> pa.RecordBatch:
            width = max(v.shape[1] for v in vectors)
            own, named = np.concatenate(ids), np.concatenate(labels)
            order = np.lexsort((own, named))
            whole = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in vectors])[order]
            own, named, names = own[order], named[order], [part.split()[0] for part in _BLOCK.split(", ")]
            # Named by its own rows, so that a task that runs again gives the same name.
            row = (f"{own[0]}-{own[-1]}-{len(own)}-{hash_of(own, whole)}", len(own), own.tobytes(), named.tobytes(), width, whole.astype(kind_of(whole)).tobytes())
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            values, good = quantised(batch.column("vector"), scale)
            own = np.asarray(batch.column("id"))[good], np.asarray(batch.column("label"))[good]
            wide = values.shape[1] * np.dtype(kind_of(values)).itemsize
            fit = max(1, min(most, BLOCK_BYTES // max(1, wide)))
            for at in range(0, len(values), fit):
                part = slice(at, at + fit)
                n, bytes_each = sum(map(len, ids)) + len(values[part]), max([wide, *widths])
                if ids and (n > most or n * bytes_each > BLOCK_BYTES):
                    yield block()
                    ids, labels, vectors, widths = [], [], [], []
                ids.append(own[0][part])
                labels.append(own[1][part])
                vectors.append(values[part])
                widths.append(wide)
        if sum(map(len, ids)):
            yield block()

    return pack


def hash_of(*arrays: np.ndarray) -> str:
    """A name for the values of some arrays."""
    digest = hashlib.blake2b(digest_size=12)
    for array in arrays:
        digest.update(np.ascontiguousarray(array).tobytes())
    return digest.hexdigest()


class Block:
    """The rows of a block, in order of label and id."""

    def __init__(self, batch: pa.RecordBatch, row: int, side: str):
        n, width, ids, labels, raw = (batch.column(f"{side}_{name}")[row].as_py() for name in ("n", "width", "ids", "labels", "vectors"))
        kind = next(k for k in _KINDS if n * width * np.dtype(k).itemsize == len(raw))
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.residues = Residues(np.frombuffer(raw, kind).reshape(n, width))


class Search:
    """The best ``k`` rows that each anchor of a block has met so far, by score (largest first), then id.

    An anchor has one or more places, each with a lowest and a highest score it asks for (a row of ``bottom`` and
    ``top`` for each anchor). With ``same`` the rows are those of the anchor's label with another id, else those of
    other labels.
    """

    def __init__(self, block: Block, k: int, same: bool, bottom: np.ndarray, top: np.ndarray):
        self.block, self.k, self.same, self.top = block, k, same, top
        self.bottom = np.where(bottom <= top, bottom, MOST)
        self.values = np.full((*bottom.shape, k), NONE, np.int64)
        self.ids = np.zeros((*bottom.shape, k), np.int64)
        # A lower score is of no use to a place; one outside of low and high is of no use to any place of the anchor.
        self._least = self.bottom.copy()
        self._low, self._high = self.bottom.min(axis=1), top.max(axis=1)
        # By tile: rows met, rows met when the best were last picked, and what was found since.
        tiles = range(-(-len(block.ids) // TILE))
        self._met, self._picked = [0 for _ in tiles], [0 for _ in tiles]
        self._since: list[list[tuple[np.ndarray, ...]]] = [[] for _ in tiles]

    def meet(self, rows: Block) -> None:
        """The anchors look through the rows of a block."""
        product = Product(self.block.residues, rows.residues)
        for number in range(len(self._met)):
            tile = slice(number * TILE, (number + 1) * TILE)
            first, last = self.block.labels[tile][[0, -1]]
            begin, end = np.searchsorted(rows.labels, first), np.searchsorted(rows.labels, last, "right")
            parts = [(0, len(rows.ids))]
            if self.same:
                parts = [(begin, end)]
            elif first == last:
                parts = [(0, begin), (end, len(rows.ids))]
            for at, stop in parts:
                while at < stop:
                    part = slice(at, min(stop, at + max(LEAST, min(STEP, self._met[number]))))
                    self._look(number, tile, part, product.tile(tile, part), rows)
                    self._met[number] += part.stop - at
                    at = part.stop
                    # Picked when the rows have doubled, or much was found.
                    n = sum(len(asker) for asker, _, _ in self._since[number])
                    if n and (self._met[number] >= 2 * self._picked[number] or n >= TILE * STEP // 4):
                        self._pick(number, tile)

    def _look(self, number: int, tile: slice, part: slice, values: np.ndarray, rows: Block) -> None:
        kind = values.dtype
        fits = values >= self._low[tile].astype(kind)[:, None]
        if not self.same:
            fits &= values <= self._high[tile].astype(kind)[:, None]
        found = np.flatnonzero(fits)
        if not len(found):
            return
        at, column = np.divmod(found, values.shape[1])
        value = values.reshape(-1)[found].astype(np.int64)
        at, column = at + tile.start, column + part.start
        alike = self.block.labels[at] == rows.labels[column]
        good = alike & (self.block.ids[at] != rows.ids[column]) if self.same else ~alike
        at, value, own = at[good], value[good], rows.ids[column[good]]
        fit = (value[:, None] >= self._least[at]) & (value[:, None] <= self.top[at])
        which, place = np.nonzero(fit)
        at, value, own = at[which], value[which], own[which]
        fit = (value > self.values[at, place, -1]) | (own < self.ids[at, place, -1])
        if fit.any():
            self._since[number].append(((at * self.top.shape[1] + place)[fit], value[fit], own[fit]))

    def _pick(self, number: int, tile: slice) -> None:
        """The best of those kept and of what was found since."""
        asker, value, own = (np.concatenate(parts) for parts in zip(*self._since[number], strict=True))
        values, ids = self.values.reshape(-1, self.k), self.ids.reshape(-1, self.k)
        asking = np.unique(asker)
        asker = np.concatenate((np.repeat(asking, self.k), asker))
        value = np.concatenate((values[asking].reshape(-1), value))
        own = np.concatenate((ids[asking].reshape(-1), own))
        order = np.lexsort((own, -value, asker))
        asker = asker[order]
        rank = np.arange(len(asker)) - np.searchsorted(asker, asker)
        keep = order[rank < self.k]
        values[asking] = value[keep].reshape(-1, self.k)
        ids[asking] = own[keep].reshape(-1, self.k)
        self._least[tile] = np.maximum(self.bottom[tile], self.values[tile, :, -1])
        self._low[tile] = self._least[tile].min(axis=1)
        self._picked[number], self._since[number] = self._met[number], []

    def found(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Anchor, place, score and id of the rows found, some anchors at a time."""
        for number, since in enumerate(self._since):
            if since:
                self._pick(number, slice(number * TILE, (number + 1) * TILE))
        for first in range(0, len(self.values), STEP):
            part = self.values[first : first + STEP]
            at, place, rank = np.nonzero(part != NONE)
            yield at + first, place, part[at, place, rank], self.ids[at + first, place, rank]


def _met(batches: Iterator[pa.RecordBatch], search: Callable[[Block, pa.RecordBatch, int], Search]) -> Iterator[tuple[str, Search]]:
    """Every block of anchors of a task when it has met all blocks of rows."""
    searches: dict[str, Search] = {}
    name, rows = None, None
    for batch in batches:
        for row, (b_name, a_name) in enumerate(zip(batch.column("b_block").to_pylist(), batch.column("a_block").to_pylist(), strict=True)):
            if b_name != name:
                name, rows = b_name, Block(batch, row, "b")
            if a_name not in searches:
                searches[a_name] = search(Block(batch, row, "a"), batch, row)
            searches[a_name].meet(rows)
    yield from searches.items()


_POSITIVE = "block string, at int, anchor_id bigint, positive_score bigint, positive_id bigint"


def _positives(k: int):
    def search(block: Block, batch: pa.RecordBatch, row: int) -> Search:
        shape = len(block.ids), 1
        return Search(block, k, True, np.full(shape, NONE), np.full(shape, MOST))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, asked in _met(batches, search):
            for at, _, value, own in asked.found():
                yield _table(_POSITIVE, [name] * len(at), at, asked.block.ids[at], value, own)

    return found


_NEGATIVE = (
    "block string, at int, place int, anchor_id bigint, positive_id bigint, positive_score bigint, "
    "negative_id bigint, negative_score bigint"
)


def _negatives(k: int, low: int, high: int, whole: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positives: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def search(block: Block, batch: pa.RecordBatch, row: int) -> Search:
            asked = batch.column("positives").slice(row, 1).flatten()
            at, place, own, score = (asked.field(name).to_numpy() for name in ("at", "place", "positive_id", "positive_score"))
            shape = len(block.ids), int(place.max())
            ids, its, bottom, top = (np.full(shape, v, np.int64) for v in (0, 0, MOST, NONE))
            ids[at, place - 1], its[at, place - 1] = own, score
            # whole * score between low and high times the positive's score, in whole numbers
            bottom[at, place - 1] = np.array([-(-low * s // whole) for s in score.tolist()], np.int64)
            top[at, place - 1] = np.array([high * s // whole for s in score.tolist()], np.int64)
            made = Search(block, k, False, bottom, top)
            positives[id(made)] = ids, its
            return made

        for name, asked in _met(batches, search):
            ids, its = positives[id(asked)]
            for at, place, value, own in asked.found():
                yield _table(_NEGATIVE, [name] * len(at), at, place + 1, asked.block.ids[at], ids[at, place], its[at, place], own, value)

    return found


def _table(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    fields = [part.split() for part in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# A writer looks at the size of its pages and row groups after every block, and not first after a hundred.
_FILES = {
    "parquet.block.size": str(GROUP_BYTES), "parquet.enable.dictionary": "false",
    "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}


def _kept(blocks: DataFrame, name: str) -> DataFrame:
    path = scratch_path(blocks.sparkSession, name)
    blocks.write.options(**_FILES).parquet(path)
    return blocks.sparkSession.read.parquet(path)


def _blocks(rows: DataFrame, scale: float, most: int, name: str) -> DataFrame:
    return _kept(rows.mapInArrow(_packer(scale, most), _BLOCK), name)


def _meeting(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows (``b_``) with every block of anchors (``a_``).

    A task has a share of the blocks of rows and a share of the anchors, which it reads for itself: the anchors
    are dealt out once, the blocks of rows are not. As many shares of rows are made as fill the session's shuffle
    partitions, so what tasks return for each anchor does not grow with the blocks.
    """
    slots = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, most = anchors.agg(F.sum("n"), F.max("n")).first()
    shares = -(-n // most) if n else 1
    b = blocks.select(*(F.col(c).alias(f"b_{c}") for c in blocks.columns)).coalesce(-(-slots // shares))
    a = anchors.select(*(F.col(c).alias(c if c == "positives" else f"a_{c}") for c in anchors.columns)).repartition(shares)
    return b.crossJoin(a.hint("shuffle_replicate_nl"))


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256,
) -> DataFrame:
    """Hard negatives of ``rows`` (id, label, vector): one row per anchor, positive and negative, with its rank.

    Anchors are the rows for which ``anchor`` holds. A negative's score lies between ``low`` and ``high`` per cent
    of the positive's.
    """
    prepare(rows.sparkSession)
    vector = F.col("vector")
    if dict(rows.dtypes)["vector"] != "array<float>":  # which the packers widen themselves
        vector = vector.cast("array<double>")
    given = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).select(
        F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
        vector.alias("vector"), anchor.alias("is_anchor"),
    )
    blocks = _blocks(given.drop("is_anchor"), scale, ROWS, "rows")
    # One row of each repeated anchor, in partitions of a size that suits the blocks.
    chosen = given.where("is_anchor").drop("is_anchor").distinct().hint("rebalance")
    anchors = _blocks(chosen, scale, ANCHORS, "anchors")

    order = [F.col("positive_score").desc(), "positive_id"]
    place = F.row_number().over(Window.partitionBy("block", "at").orderBy(*order))
    met = _meeting(blocks, anchors).mapInArrow(_positives(n_positives), _POSITIVE)
    positives = met.withColumn("place", place).where(F.col("place") <= n_positives)
    asked = positives.groupBy("block").agg(
        F.collect_list(F.struct("at", "place", "anchor_id", "positive_id", "positive_score")).alias("positives")
    )
    asking = _kept(anchors.join(asked, "block"), "asking")

    order = [F.col("negative_score").desc(), "negative_id"]
    rank = F.row_number().over(Window.partitionBy("block", "at", "place").orderBy(*order))
    met = _meeting(blocks, asking).mapInArrow(_negatives(n_negatives, low, high, 100), _NEGATIVE)
    return met.withColumn("rank", rank).where(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
