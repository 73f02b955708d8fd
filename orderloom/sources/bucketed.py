"""Tables kept in buckets of a key, so that joins and sums over it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


def keep(df: DataFrame, name: str, key: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write a table in sorted buckets of ``key`` and read it as such.

    Tables that are to meet need the same number of buckets; left out, it is that of the shuffle partitions. Every
    bucket is one file, as rows are brought together by the hash that makes the buckets. The table's name
    is a fresh one in the session's catalog; its files lie at ``path``, or in the shared scratch folder.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path or scratch_path(spark, name))
        .saveAsTable(table, format="parquet")
    )
    return spark.table(table)
