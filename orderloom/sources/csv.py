"""CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    multi_line: bool = False,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Scan CSV with a header line.

    Without a schema all columns are text, which needs no pass over the data;
    ``infer`` adds that pass. ``types`` gives columns a type by name, for which only
    the header line is read; a cell that does not parse is null. ``multi_line`` allows line breaks inside quotes, but
    then a file cannot be split: use it for many files of moderate size.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    elif types:
        names = reader.csv(path).columns
        reader = reader.schema(T.StructType([T.StructField(n, T.DataType.fromDDL(types.get(n, "string"))) for n in names]))
    return reader.csv(path)


def with_null_tokens(df: DataFrame) -> DataFrame:
    """Text cells that spell a missing value become null."""
    return df.withColumns(
        {c: text.null_if_token(F.col(c)) for c, kind in df.dtypes if kind == "string"}
    )


def with_file_order(scan: DataFrame, out: str = "ingest_seq") -> DataFrame:
    """Add the position of each row in its input: file, offset of the split, row.

    Only for a frame that comes straight from a file scan.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.withColumn(out, position)


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header that ``read_csv`` reads back cell for cell."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
