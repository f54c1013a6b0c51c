"""Triggered Bronze refresh (the source pipeline is refreshed by trigger).

A file-source stream with ``Trigger.AvailableNow`` processes every new file
of the landing folder once, appends it to Bronze with lineage columns and
stops; the checkpoint records which files were taken, so a re-run after a
failure neither loses nor duplicates files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmart.sources.trips import stamp_trip_lineage


def refresh_bronze_trips(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    year: int | str,
    source_table: str,
) -> StreamingQuery:
    """Start a run-to-completion stream from ``landing`` (parquet) into ``target``."""
    stream = (
        spark.readStream.schema(schema)
        .option("basePath", landing)
        .parquet(landing)
        .where(f"year = '{year}'")
    )
    return (
        stamp_trip_lineage(stream, source_table)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("year", "month")
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
