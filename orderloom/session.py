"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings the operators rely on. They are runtime settings, so a session built
# elsewhere can be brought in line as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A sum that overflows is an error and not a wrong number.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Counts of whole Parquet tables are answered by their footers (see ``counted_from_footers``).
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(
    app: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; master and sizes are left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **(conf or {}),
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="orderloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Bytes that a shuffle partition should hold.
PARTITION_BYTES = 128 << 20
# Bytes of a value as Spark's own estimates have them; others are taken for text.
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
_TEXT_WIDTH, _ROW_WIDTH = 20, 8


def partitions_for(n_bytes: int, target: int = PARTITION_BYTES) -> int:
    """How many shuffle partitions so many bytes take."""
    return max(1, -(-n_bytes // target))


def table_bytes(df: DataFrame) -> int:
    """The size of a table's rows: their number, which Parquet has in its footers, times the width of their types."""
    width = _ROW_WIDTH + sum(_WIDTHS.get(kind, _TEXT_WIDTH) for _, kind in df.dtypes)
    return width * df.count()


@contextmanager
def shuffles_of(spark: SparkSession, n_bytes: int, target: int = PARTITION_BYTES) -> Iterator[int]:
    """Inside, shuffles have as many partitions as so many bytes take, and no fewer than before.

    The session's number holds for inputs of any size; where it is too small, partitions
    spill. Adaptive execution joins partitions that turn out to be small.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    n = max(int(before), partitions_for(n_bytes, target))
    spark.conf.set(name, str(n))
    try:
        yield n
    finally:
        spark.conf.set(name, before)


_V1_SOURCES = "spark.sql.sources.useV1SourceList"


@contextmanager
def counted_from_footers(spark: SparkSession) -> Iterator[None]:
    """Frames read from Parquet inside push ``count(*)`` down to the files' footers.

    Only the second version of Spark's file sources does that, and it is chosen when a frame is made.
    """
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_V1_SOURCES, before)


# Folders made by ``scratch_path`` and not removed since.
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    folder = f"{shared_folder(spark)}/orderloom-{uuid.uuid4().hex}"
    _made.append(folder)
    return f"{folder}/{name}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are removed at the end, also if it fails.

    For whole jobs, whose results are written by then; a frame that reads from
    scratch cannot be used afterwards.
    """
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder as Parquet and read it from there.

    Used where a result is read more than once: a lost executor then costs a
    re-read of files and not a second run of the joins behind them. Readers fetch only
    the columns they use.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "stored")
    # Parquet has no type for a column that is null by type.
    void = [name for name, kind in df.dtypes if kind == "void"]
    kept = df.drop(*void)
    kept.write.parquet(path)
    back = spark.read.schema(kept.schema).parquet(path)
    return back.select(*(F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns)) if void else back
