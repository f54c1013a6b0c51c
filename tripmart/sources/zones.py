"""Zone lookup CSV scan and Bronze lineage stamping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tripmart.config import ZONE_SOURCE_FORMAT, ZONE_SOURCE_SYSTEM

ZONE_LOOKUP_SCHEMA = StructType(
    [
        StructField("LocationID", IntegerType(), True),
        StructField("Borough", StringType(), True),
        StructField("Zone", StringType(), True),
        StructField("service_zone", StringType(), True),
    ]
)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Read the zone lookup CSV with a fixed schema.

    ``FAILFAST`` rejects malformed rows (e.g. a non-integer id) and
    ``enforceSchema=false`` makes Spark check the header names against the
    schema, so a renamed column fails the read instead of being ignored.
    """
    return (
        spark.read.format("csv")
        .schema(ZONE_LOOKUP_SCHEMA)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("encoding", "UTF-8")
        .option("enforceSchema", "false")
        .load(path)
    )


def write_zones(df: DataFrame, path: str) -> None:
    """Write a lookup as the CSV that :func:`read_zones` reads; blanks inside texts are kept."""
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.select(*ZONE_LOOKUP_SCHEMA.names).write.options(header="true", **blanks).csv(path)


def stamp_zone_lookup_lineage(df: DataFrame, source_path: str) -> DataFrame:
    return df.withColumns(
        {
            "_source_system": F.lit(ZONE_SOURCE_SYSTEM),
            "_source_format": F.lit(ZONE_SOURCE_FORMAT),
            "_source_path": F.lit(source_path),
            "_pipeline_refresh_timestamp": F.current_timestamp(),
        }
    )
