"""CSV files with line breaks inside quotes, split over tasks.

Spark's own reader gives such a file to one task, as no task can tell where records begin in the middle of a file. Here
files are read as text lines, in splits of any size:

1. A quote opens or closes a cell, and a doubled one does both, so a line with an odd number of quotes turns
   the state at its end. One aggregate counts these lines per split and finds the first and the last.
2. Sums from the left over the splits of a file say which splits begin inside quotes.
3. Each task puts the lines of its splits together to records. Lines of records that cross a border of splits,
   which step 1 and 2 tell apart, meet by record in a small group.
4. Records are parsed by ``from_csv``.

A file without any odd line holds one record a line and is left to Spark's reader, which splits it.

Records equal those of Spark's reader with ``multiLine`` for files in which quotes enclose cells or are doubled inside
them. Where an unquoted cell holds quotes, lines might be joined that do not belong together: such a
record is an error, as is a file that ends inside quotes. Lines end in ``\\n`` or ``\\r\\n``; empty lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import stored
from . import csv

_RECORD = "record string, file string, start bigint, row bigint, crlf boolean"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines with their file, the beginning of their split in it and their number in the task.

    Numbers come straight from the scan, so another scan of the same files gives the same ones.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def _odd(line: Column) -> Column:
    return (F.length(line) - F.length(F.translate(line, '"', ""))) % 2 == 1


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: its odd lines, whether it begins and ends inside quotes, and whether the file's header ends in ``\\r\\n``."""
    row = F.when(_odd(F.col("line")), F.col("row"))
    found = lines.groupBy("file", "start").agg(
        F.min("row").alias("first"), F.count(row).alias("n_odd"), F.min(row).alias("first_odd"), F.max(row).alias("last_odd"),
        F.min_by(F.col("line").endswith("\r"), "row").alias("crlf"),
    )
    order = Window.partitionBy("file").orderBy("start")
    odd_before = F.coalesce(F.sum("n_odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumns(
        {
            "inside": odd_before % 2 == 1,
            "open": (odd_before + F.col("n_odd")) % 2 == 1,
            "crlf": F.first("crlf").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in one split; the header line of every file is left out."""
    split, inside, held, at = None, False, [], 0

    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        lines, files, starts, numbers = (batch.column(k) for k in range(4))
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        start_of, number = starts.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)
        coded = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        other = np.flatnonzero((start_of[1:] != start_of[:-1]) | (coded[1:] != coded[:-1])) + 1
        records: list[str] = []
        places: list[int] = []
        for first, stop in zip([0, *other.tolist()], [*other.tolist(), rows], strict=True):
            now = files[first].as_py(), int(start_of[first])
            if now != split:  # what is held was open at the end of its split
                split, inside, held = now, batch.column("inside")[first].as_py(), []
                skipping = inside  # up to the end of a record that began in an earlier split
                header = now[1] == 0
            own = lines.slice(first, stop - first).to_pylist()
            turns = quotes[first:stop] % 2 == 1
            for k, (line, turn) in enumerate(zip(own, turns.tolist(), strict=True)):
                if not inside:
                    at = int(number[first + k])
                inside ^= turn
                if skipping:
                    skipping = inside
                    continue
                if inside or held:
                    held.append(line)
                    if inside:
                        continue
                    line = "\n".join(held)
                    held = []
                if header:
                    header = False
                    continue
                records.append(line)
                places.append(at)
        index = np.searchsorted(number, places)
        # A record may have begun in the batch before, but never in another split.
        index = np.minimum(index, rows - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(records, pa.string()), files.take(pa.array(index)), starts.take(pa.array(index)), pa.array(places, pa.int64()),
             batch.column("crlf").take(pa.array(index))],
            ["record", "file", "start", "row", "crlf"],
        )


def _crossing(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records that lie in several splits."""
    border = splits.where("inside or open").drop("n_odd")
    near = lines.join(F.broadcast(border), ["file", "start"])
    row = F.col("row")
    head = F.col("inside") & (row <= F.coalesce("first_odd", row))
    tail = F.col("open") & F.coalesce(row >= F.col("last_odd"), F.lit(False)) & ~head
    pieces = near.where(head | tail).groupBy("file", "start", tail.alias("is_tail")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("text"),
        F.min("row").alias("row"),
        F.first("first").alias("first"),
        F.first("crlf").alias("crlf"),
    )
    # A piece at the beginning of a split goes on with the record that the last split before left open.
    order = Window.partitionBy("file").orderBy("start", "is_tail")
    numbered = pieces.withColumn("record_no", F.sum(F.col("is_tail").cast("int")).over(order))
    return (
        numbered.groupBy("file", "record_no")
        .agg(F.sort_array(F.collect_list(F.struct("start", "row", "text", "first", "crlf"))).alias("parts"))
        .select(
            F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record"),
            "file",
            F.col("parts")[0]["start"].alias("start"),
            F.col("parts")[0]["row"].alias("row"),
            F.col("parts")[0]["crlf"].alias("crlf"),
            F.col("parts")[0]["first"].alias("first"),
        )
        .where((F.col("start") > 0) | (F.col("row") > F.col("first")))
        .drop("first")
    )


def records(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    """The rows of ``_RECORD`` of every record but headers; None if every line is a record of its own."""
    lines = _lines(spark, path)
    splits = stored(_splits(lines))
    if splits.where("n_odd > 0").isEmpty():
        return None
    ends = Window.partitionBy("file").orderBy(F.col("start").desc())
    left = splits.withColumn("nth", F.row_number().over(ends)).where("nth = 1 and open").first()
    if left:
        raise ValueError(f"{left['file']} ends inside quotes: read it with multi_line")
    # Only splits that begin inside quotes, one per record that crosses a border, and those of files with \\r\\n are sent round.
    marked = splits.where("inside or crlf").select("file", "start", "inside", "crlf")
    placed = lines.join(F.broadcast(marked), ["file", "start"], "left")
    no = F.lit(False)
    placed = placed.select("line", "file", "start", "row", F.coalesce("inside", no).alias("inside"), F.coalesce("crlf", no).alias("crlf"))
    found = placed.mapInArrow(_whole, _RECORD)
    if not splits.where("inside").isEmpty():
        found = found.unionByName(_crossing(lines, splits))
    return found


# A quoted cell from one border of cells to the next.
_CELL = r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"(?![^,])'


def read_records(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    types: dict[str, str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Scan CSV with a header line and line breaks inside quotes; arguments as in ``csv.read_csv``.

    ``order`` names a column for the position of each row in its input. ``infer`` finds the types with a pass of Spark's
    reader, which is one task per file.
    """
    found = records(spark, path)
    if found is None:
        scan = csv.read_csv(spark, path, schema, infer, types=types)
        return csv.with_file_order(scan, order) if order else scan
    schema = csv.read_csv(spark, path, schema, infer, multi_line=True, types=types).schema
    # As Spark's reader does, a file whose lines end in \\r\\n has its line breaks inside quotes made \\n as well.
    record = F.when(F.col("crlf"), F.replace(F.regexp_replace("record", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    rest = F.regexp_replace(record, _CELL, "")
    stray = record.contains("\n") & (rest.contains("\n") | rest.contains('"'))
    problem = F.raise_error(F.concat(F.lit("quotes inside an unquoted cell, read it with multi_line: "), F.col("file")))
    checked = F.when(stray, problem.cast("string")).otherwise(record)
    parsed = F.from_csv(checked, schema.toDDL(), {"escape": '"', "multiLine": "true"}).alias("parsed")
    rows = found.where(record != "").select(parsed, F.struct("file", "start", "row").alias("place"))
    return rows.select("parsed.*", *([F.col("place").alias(order)] if order else []))
