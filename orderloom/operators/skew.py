"""Joins on a key that may be hot on one or more sides.

A key that holds a large share of the rows of a table would send them all to one
task. Such keys are found beforehand with a bounded sketch and only they are
split: every side with hot keys gets a salt column, its own rows are dealt out
over the salts and the rows of the other sides are copied to each of them. The
join result is the same whichever keys are split, so the sketch may be inexact.
Without a hot key the plan is that of the plain join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Keys that one sketch keeps track of, at most (Spark's own limit is a million).
MOST_TRACKED = 1 << 19
# Shuffle partitions per slice of the keys; each slice has a sketch, merged by a task of its own.
SLICE_PARTITIONS = 16
# Sketches that are kept with a table do not know the session that will use them: their slices and what each of them tracks
# are fixed. One is off by 3.5 / 16384 of the rows of its slice, a 64th of the keys.
KEPT_SLICES, KEPT_TRACKED = 64, 1 << 14
# Hot means this many times the rows of an average shuffle partition, or more.
HOT_PARTITIONS = 2


@dataclass(frozen=True)
class HotKeys:
    """Hot values of ``key``: ``table`` has one row per value, with a split count per side.

    ``sides`` names the sides that have hot keys; only they get a salt column.
    """

    key: str
    sides: tuple[str, ...] = ()
    table: DataFrame | None = None

    @property
    def join_on(self) -> list[str]:
        return [self.key, *(f"salt_{s}" for s in self.sides)]

    def only(self, *sides: str) -> HotKeys:
        """The hot keys of the named sides, for a join that has no other salted side.

        Every side with a salt must deal out its rows in the join; a salt that no
        side deals out would only multiply rows.
        """
        kept = tuple(s for s in self.sides if s in sides)
        return HotKeys(self.key, kept, self.table if kept else None)

    def spread(self, df: DataFrame, side: str | None = None, counts: Sequence[str] = ()) -> DataFrame:
        """Add the salt columns to the rows of one side.

        ``counts`` names columns that say how often a row counts. They are divided
        over the salts of ``side`` in place of dealing out whole rows, which suits
        a table with one row per key. A slice whose counts are all 0 is kept.

        Row numbers make the salts, so ``df`` must come straight from files: a
        task that is run again then sees its rows in the same order.
        """
        if self.table is None:
            return df
        columns = df.columns
        splits = {s: F.coalesce(F.col(f"splits_{s}"), F.lit(1)) for s in self.sides}
        df = df.join(F.broadcast(self.table), self.key, "left")
        if side in self.sides and not counts:
            # Hashed, as hot rows may sit at regular distances from each other.
            own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), splits[side]).cast("int")
            df = df.withColumn(f"salt_{side}", own)
        for s in self.sides:
            if s != side or counts:
                df = df.withColumn(f"salt_{s}", F.explode(F.sequence(F.lit(0), splits[s] - 1)))
        if side in self.sides and counts:
            n, salt = splits[side].cast("long"), F.col(f"salt_{side}")
            rest = {c: F.col(c) % n for c in counts}
            df = df.withColumns(
                {c: ((F.col(c) - rest[c]) / n).cast("long") + (salt < rest[c]).cast("long") for c in counts}
            )
        return df.select(*columns, *(f"salt_{s}" for s in self.sides))


def hot_keys(sides: Mapping[str, DataFrame], key: str) -> HotKeys:
    """Find the hot values of ``key`` in each of ``sides``, which hold the rows to be joined.

    Rows a filter drops must not count: the other sides would be copied for them.
    Two passes over the key columns: rows are counted, then keys are cut into slices by a hash,
    so the sketches of one side are merged by many tasks that share no key. The driver receives at
    most half as many keys per side as there are shuffle partitions, since no more
    can be hot.
    """
    first = next(iter(sides.values()))
    spark = first.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, partitions // HOT_PARTITIONS)
    # The sketch may be off by 3.5 / tracked of all rows, far below a hot share.
    tracked = min(MOST_TRACKED, 1 << max(10, (32 * partitions).bit_length()))
    slices = 1 + partitions // SLICE_PARTITIONS
    keys = [df.select(F.lit(s).alias("side"), F.col(key).alias("k")) for s, df in sides.items()]
    rows = reduce(DataFrame.union, keys).where(F.col("k").isNotNull())
    totals = {side: n for side, n in rows.groupBy("side").count().collect()}
    sketches = rows.groupBy("side", F.pmod(F.xxhash64("k"), F.lit(slices)).alias("slice")).agg(
        F.expr(f"approx_top_k(k, {min(limit, tracked)}, {tracked})").alias("top")
    )
    return _hot(sketches, totals, key, first.schema[key].dataType, tuple(sides))


def key_sketches(rows: DataFrame, key: str) -> DataFrame:
    """Sketches of the frequent values of a key, to be kept with a table: one row per slice of the keys.

    ``rows`` are those that will be joined. Sketches of several parts of a table, such as its days, may be put together.
    """
    keys = rows.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    return keys.groupBy(F.pmod(F.xxhash64("k"), F.lit(KEPT_SLICES)).cast("int").alias("slice")).agg(
        F.count("*").alias("n_rows"), F.expr(f"approx_top_k_accumulate(k, {KEPT_TRACKED})").alias("state")
    )


def kept_hot_keys(sides: Mapping[str, DataFrame], key: str, kind: T.DataType) -> HotKeys:
    """``hot_keys`` from the kept sketches of each side, without a look at its rows."""
    spark = next(iter(sides.values())).sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = min(max(1, partitions // HOT_PARTITIONS), KEPT_TRACKED)
    kept = reduce(DataFrame.union, [df.select(F.lit(s).alias("side"), "slice", "n_rows", "state") for s, df in sides.items()])
    totals = {side: n for side, n in kept.groupBy("side").agg(F.sum("n_rows")).collect()}
    sketches = (
        kept.groupBy("side", "slice")
        .agg(F.expr(f"approx_top_k_combine(state, {KEPT_TRACKED})").alias("state"))
        .select("side", F.expr(f"approx_top_k_estimate(state, {limit})").alias("top"))
    )
    return _hot(sketches, totals, key, kind, tuple(sides))


def _hot(sketches: DataFrame, totals: dict[str, int], key: str, kind: T.DataType, sides: tuple[str, ...]) -> HotKeys:
    """The hot keys among the most frequent ones (``side, top``) of all slices."""
    spark = sketches.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = reduce(lambda c, s: c.when(F.col("side") == s, totals[s]), totals, F.when(F.lit(False), 0))
    share = F.col("count") / total * partitions
    found = (
        sketches.select("side", F.inline("top").alias("item", "count"))
        .where(share >= HOT_PARTITIONS)
        .select("side", "item", F.ceil(share).cast("int").alias("splits"))
        .collect()
    )
    splits: dict[object, dict[str, int]] = {}
    for side, value, count in found:
        splits.setdefault(value, {})[side] = count
    if not splits:
        return HotKeys(key)
    names = tuple(s for s in sides if any(s in by_side for by_side in splits.values()))
    fields = [T.StructField(key, kind)]
    fields += [T.StructField(f"splits_{s}", T.IntegerType()) for s in names]
    rows = [(value, *(by_side.get(s, 1) for s in names)) for value, by_side in splits.items()]
    return HotKeys(key, names, spark.createDataFrame(rows, T.StructType(fields)))
