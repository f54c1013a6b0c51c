"""Joins against lookups whose size is only known at run time.

A derived lookup (duplicate groups, per-key statistics) can be tiny or as
large as the fact it annotates. It is materialised once as a written table
in the cluster's checkpoint folder (which also cuts its lineage), counted,
and broadcast only when the counted size is under a bound in bytes; otherwise Spark plans a
shuffle join, where AQE splits skewed partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir


#: Bytes up to which a lookup of counted rows is broadcast, and what a column of a row is taken to weigh.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 64


def materialize(df: DataFrame, partition_by: tuple[str, ...] = (), folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Unlike ``checkpoint()`` (serialised rows behind an RDD scan), the written
    table is columnar: every consumer scans only the columns it projects and
    gets its filters pushed into the scan. The folder is shared storage named
    by the cluster (``folder`` or ``spark.checkpoint.dir``), so a lost
    executor does not lose the copy; each call writes a fresh folder, so a
    retried job never reads a half-written one. ``partition_by`` columns
    become folders, so a consumer filtering on them reads only its part
    (``PartitionFilters``); the read-back keeps the original schema and
    column order.
    """
    spark = df.sparkSession
    path = f"{(folder or checkpoint_dir(spark)).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    copy = spark.read.schema(df.schema).parquet(path).select(*df.columns) if partition_by else spark.read.parquet(path)
    copy._written_to = path
    return copy


def discard(copy: DataFrame) -> None:
    """Delete the folder a materialised copy was written to."""
    spark = copy.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(copy._written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Materialise a lookup and return it with its row count (the size proof)."""
    df = materialize(df)
    return df, df.count()


def row_bytes(df: DataFrame) -> int:
    """What a row of a lookup is taken to weigh: an allowance for each column, hashes and names included."""
    return ROW_BYTES * max(1, len(df.columns))


def join_lookup(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` to a materialised ``small``, broadcasting it only under a proven size."""
    small, rows = materialize_counted(small)
    return big.join(broadcast_bounded(small, rows, max_bytes), on, how)


def broadcast_bounded(df: DataFrame, bound_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a lookup whose counted (or fixed) rows weigh at most ``max_bytes``.

    Above that the join is left to the planner and AQE.
    """
    return F.broadcast(df) if bound_rows * row_bytes(df) <= max_bytes else df
