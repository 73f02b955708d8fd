"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words (runs of anything but space and the control characters 9 to 13) are hashed, and every run
of ``GRAM`` = 4 words ending at each word is hashed by rolling two doublings; runs at the front are filled
up with zeros, so that a text of n words has n grams. Of every ``WINDOW`` = 4 neighbouring grams the one
with the smallest hash is picked, of equal ones the rightmost. Two texts that share ``GRAM + WINDOW - 1`` =
7 words in a row therefore share a pick, and picks keep the positions of their grams. In ``report`` each code
point of a word of more than ``LONG_WORD`` code points counts as a word of its own, so that texts without spaces
(Chinese, Thai, base64) share a pick where they share 7 code points of such words in a row; elsewhere this is
the option ``long_word``. A text with fewer
grams than a window has one pick, an empty or null one has none.

Hash and position travel in one long: 39 bits of hash above 24 bits of reversed position, so a plain
minimum prefers the rightmost tie. (Past 16.7 million words positions start again from 0, and a tie across
that border goes to the left.)

The likeness of two fingerprints is the Jaccard similarity of their sets of hashes; two empty ones are
alike (1.0).

``neighbours`` finds each row's successor in descending order of ids without a global sort: ids are cut into
buckets at approximate quantiles (from a hash sample of ids; the result is the same for any cut points), the
rows of a bucket are ordered by one window, and the first row of a bucket is copied to the bucket before
it, where the last row needs it. Whole texts are shuffled once. Rows with equal ids are ordered by a hash of
their text (largest first), and an id with the rows of several buckets is cut by that hash, so that only rows equal in
both stay together. A null id counts as the smallest, the successor of the last row is the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import prepare

GRAM = 4
WINDOW = 4
LONG_WORD = 64
POSITION_BITS = 24
SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SAMPLE_PER_BUCKET = 200
SMALLEST = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _paired(a: Column, apart: int, n: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``n`` joined pairs of elements that lie ``apart``."""
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + apart), n), join)


def picks(text: Column, long_word: int | None = None) -> Column:
    """Picked grams of a text, in order, as packed hashes and positions.

    Words of more than ``long_word`` code points, if given, are cut into code points.
    """
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))
    if long_word is not None:
        apart = F.flatten(
            F.transform(words, lambda word: F.when(F.length(word) > long_word, F.split(word, "")).otherwise(F.array(word)))
        )
        word = "[^\\x20\\x09-\\x0D]"
        words = F.when(bare.rlike(f"(?<!{word}){word}{{{long_word + 1}}}"), apart).otherwise(words)
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    last = (1 << POSITION_BITS) - 1

    def grams(h):
        n = F.size(h)
        filled = F.concat(F.array_repeat(F.lit(0).cast("bigint"), GRAM - 1), h)
        pairs = lambda a: _paired(a, 1, n + 2, lambda x, y: F.xxhash64(x, y))
        fours = lambda a: _paired(a, 2, n, lambda x, y: F.xxhash64(x, y))
        return let(filled, lambda a: let(pairs(a), fours))

    def packed(g):
        return F.transform(
            g,
            lambda x, i: F.shiftleft(F.shiftrightunsigned(x, POSITION_BITS + 1), POSITION_BITS)
            + (last - i % (last + 1)),
        )

    def chosen(v):
        n = F.size(v)
        least = lambda x, y: F.least(x, y)
        fours = lambda a: _paired(a, 2, n - 3, least)
        return (
            F.when(n == 0, v)
            .when(n <= WINDOW, F.array(F.array_min(v)))
            .otherwise(F.array_distinct(let(_paired(v, 1, n - 1, least), fours)))
        )

    return let(let(let(hashes, grams), packed), chosen)


def pick_hash(pick: Column) -> Column:
    return F.shiftright(pick, POSITION_BITS)


def pick_position(pick: Column) -> Column:
    last = (1 << POSITION_BITS) - 1
    return F.lit(last) - pick.bitwiseAND(F.lit(last))


def hashes_of(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, pick_hash))


def written(chosen: Column) -> Column:
    """A fingerprint as text: ``hash@position`` of every pick, in order."""
    return F.array_join(
        F.transform(
            chosen, lambda p: F.concat(F.lower(F.hex(pick_hash(p))), F.lit("@"), pick_position(p).cast("string"))
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    return let(
        F.size(F.array_intersect(a, b)).cast("double"),
        lambda both: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / (F.size(a) + F.size(b) - both)),
    )


def fingerprints(docs: DataFrame, text: str = "text", long_word: int | None = None) -> DataFrame:
    """The input with ``picks``: position and hash of every picked gram."""
    prepare(docs.sparkSession)
    return docs.withColumn(
        "picks",
        F.transform(
            picks(F.col(text), long_word), lambda p: F.struct(pick_position(p).alias("position"), pick_hash(p).alias("hash"))
        ),
    )


def _cut_points(ids: DataFrame, buckets: int) -> list[tuple[int, int]]:
    """Pairs of id and text hash at which buckets begin, in order: quantiles of the ids, and even
    steps of the hash inside an id that has the rows of several buckets. There are at most a few per bucket."""
    n = ids.count()
    every = max(1, n // (SAMPLE_PER_BUCKET * buckets))
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    some = ids.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)
    cuts = {(key, SMALLEST) for key in some.agg(F.percentile_approx("key", steps, 10 * buckets)).first()[0] or []}
    often = ids.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * buckets >= 2 * n)
    for key, rows in often.collect():
        parts = -(-rows * buckets // n)
        cuts |= {(key, SMALLEST + (i << 64) // parts) for i in range(parts)}
        if key < -(SMALLEST + 1):
            cuts.add((key + 1, SMALLEST))
    return sorted(cuts)


def _numbers(values: list[int]) -> Column:
    """Whole numbers as one constant, not as an expression for each."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bucket(key: Column, mark: Column, cuts: list[tuple[int, int]]) -> Column:
    """The number of cut points that are at most the pair of ``key`` and ``mark``: a binary search."""
    if not cuts:
        return F.lit(0)
    keys, marks = (_numbers(list(part)) for part in zip(*cuts, strict=True))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])

    def reached(s, place):
        k = F.get(s["keys"], place)
        return (k < s["key"]) | ((k == s["key"]) & (F.get(s["marks"], place) <= s["mark"]))

    return let(
        F.struct(keys.alias("keys"), marks.alias("marks"), key.alias("key"), mark.alias("mark")),
        lambda s: F.aggregate(
            steps,
            F.lit(0),
            lambda low, step: F.when((low + step <= len(cuts)) & reached(s, low + step - 1), low + step).otherwise(low),
        ),
    )


def neighbours(docs: DataFrame, buckets: int | None = None) -> tuple[DataFrame, Window]:
    """``key, mark, bucket, ghost, doc_id, text`` rows, and the window under which ``lead`` gives the successor.

    Rows with ``ghost`` are copies that only serve as successors; drop them after the last ``lead``.
    """
    spark = prepare(docs.sparkSession)
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key, text = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(SMALLEST)), F.coalesce("text", F.lit(""))
    cuts = _cut_points(docs.select(key.alias("key")), buckets)
    given = docs.select("doc_id", text.alias("text"), key.alias("key"), F.xxhash64(text).alias("mark"))
    rows = given.withColumn("bucket", _bucket(F.col("key"), F.col("mark"), cuts))
    # One row per bucket, a few times ``buckets`` at most.
    first = {
        r["bucket"]: r["first"]
        for r in rows.groupBy("bucket").agg(F.max(F.struct("key", "mark")).alias("first")).collect()
    }
    order = sorted(first)
    before = dict(zip(order, order[1:] + order[:1]))
    numbers = range(len(cuts) + 1)
    first_key, first_mark = (_numbers([first[b][part] if b in first else 0 for b in numbers]) for part in ("key", "mark"))
    targets = _numbers([before.get(b, b) for b in numbers])
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost"))
    copy = F.struct(F.get(targets, F.col("bucket")).cast("int").alias("bucket"), F.lit(True).alias("ghost"))
    is_first = (F.get(first_key, F.col("bucket")) == F.col("key")) & (F.get(first_mark, F.col("bucket")) == F.col("mark"))
    placed = rows.withColumn("place", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own)))).select(
        "doc_id", "text", "key", "mark", "place.bucket", "place.ghost"
    )
    window = Window.partitionBy("bucket").orderBy("ghost", F.desc("key"), F.desc("mark"), "text")
    return placed, window


def report(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by as many from the front of the
    successor, or by all of it if it is shorter.
    """
    placed, window = neighbours(docs.select("doc_id", "text"), buckets)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    told = (
        placed.withColumn("next_text", F.lead("text").over(window))
        .withColumn("chosen", picks(F.col("text"), LONG_WORD))
        .withColumn("own", hashes_of(F.col("chosen")))
        .withColumn("next", F.lead("own").over(window))
        .where(~F.col("ghost"))
        .withColumn("edited", F.concat(F.left("text", n - third), F.left("next_text", third)))
        .withColumn("edited_chosen", picks(F.col("edited"), LONG_WORD))
        .withColumn("edited_own", hashes_of(F.col("edited_chosen")))
    )
    return told.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("chosen")).alias("fingerprint"),
        written(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
