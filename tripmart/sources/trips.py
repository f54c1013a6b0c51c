"""Trip source scans and Bronze lineage stamping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import TRIP_SOURCE_SYSTEM


def read_trips(spark: SparkSession, path: str, year: int | str, fmt: str = "parquet") -> DataFrame:
    """Scan a ``year=/month=`` partitioned trip dataset, keeping one year.

    The partition values are compared as text (``year = '2025'``), which lets
    Spark prune partitions at listing time (``PartitionFilters`` in the plan).
    Each row gets a stable identity, a number from its file and row position,
    used to choose one survivor per duplicate group without a global ordering.
    """
    df = (
        spark.read.format(fmt)
        .option("basePath", path)
        .load(path)
        .where(F.col("year") == F.lit(str(year)))
    )
    return df.withColumn(
        "_source_row_id",
        F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")),
    )


def stamp_trip_lineage(df: DataFrame, source_table: str) -> DataFrame:
    """Bronze trip lineage columns (constant per run plus refresh time)."""
    return df.withColumns(
        {
            "_source_system": F.lit(TRIP_SOURCE_SYSTEM),
            "_source_table": F.lit(source_table),
            "_ingested_at": F.current_timestamp(),
        }
    )


def bronze_trips(raw: DataFrame, year: int | str, source_table: str) -> DataFrame:
    """Bronze copy of one source year: partition filter plus lineage."""
    return stamp_trip_lineage(raw.where(F.col("year") == F.lit(str(year))), source_table)
