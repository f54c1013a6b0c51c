"""Rename-and-cast projections driven by column spec tables (PRJ1, PRJ2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed trip column contract: (source name, normalised name, type), in the
# order the record hash uses.
TRIP_COLUMN_SPEC = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "decimal(18,3)"),
    ("RatecodeID", "rate_code_id", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "flag"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "decimal(18,2)"),
    ("extra", "extra_amount", "decimal(18,2)"),
    ("mta_tax", "mta_tax_amount", "decimal(18,2)"),
    ("tip_amount", "tip_amount", "decimal(18,2)"),
    ("tolls_amount", "tolls_amount", "decimal(18,2)"),
    ("improvement_surcharge", "improvement_surcharge_amount", "decimal(18,2)"),
    ("total_amount", "total_amount", "decimal(18,2)"),
    ("congestion_surcharge", "congestion_surcharge_amount", "decimal(18,2)"),
    ("Airport_fee", "airport_fee_amount", "decimal(18,2)"),
    ("cbd_congestion_fee", "cbd_congestion_fee_amount", "decimal(18,2)"),
    ("year", "source_year", "int"),
    ("month", "source_month", "int"),
)
# The nine money components that make up a fare (total excluded).
FINANCIAL_COMPONENTS = (
    "fare_amount",
    "extra_amount",
    "mta_tax_amount",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge_amount",
    "congestion_surcharge_amount",
    "airport_fee_amount",
    "cbd_congestion_fee_amount",
)
# ---------------------------------------------------------------------------

HASH_COLUMNS = tuple(target for _, target, _ in TRIP_COLUMN_SPEC)


def normalize_trips(df: DataFrame, keep: tuple[str, ...] = ("_source_row_id",)) -> DataFrame:
    """Project raw trips onto the normalised contract.

    Text flags are trimmed and upper-cased; the flag is also copied under its
    long name. ``keep`` carries technical columns that are not hashed.
    """
    exprs = []
    for source, target, kind in TRIP_COLUMN_SPEC:
        if kind == "flag":
            exprs.append(f"upper(trim(`{source}`)) AS {target}")
        else:
            exprs.append(f"CAST(`{source}` AS {kind}) AS {target}")
    exprs.append("upper(trim(`store_and_fwd_flag`)) AS store_and_forward_flag")
    exprs += [c for c in keep if c in df.columns]
    return df.selectExpr(*exprs)


def normalize_zones(df: DataFrame) -> DataFrame:
    """Cast the zone id, trim the texts, carry Bronze lineage."""
    return df.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.trim(F.col("Borough")).alias("borough"),
        F.trim(F.col("Zone")).alias("zone"),
        F.trim(F.col("service_zone")).alias("service_zone"),
        F.col("_source_system"),
        F.col("_source_format"),
        F.col("_source_path"),
        F.col("_pipeline_refresh_timestamp").alias("_bronze_refresh_timestamp"),
    )
