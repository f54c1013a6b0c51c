"""Bronze reports and quarantine summaries (AG3, AG4, VR1, VR2, DQ7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.config import ZONE_SOURCE_FORMAT, ZONE_SOURCE_SYSTEM
from tripmart.functions.predicates import count_true, is_blank
from tripmart.operators.checks import combine

c = F.col


def bronze_reconciliation(lake) -> DataFrame:
    """Per-partition row counts of source vs Bronze, one summary row (JN4, AG3, VR1).

    Both sides are answered from file footers; no row is read.
    """
    source, bronze = (
        lake.counts(layer, lake.cfg.expected_pickup_year).withColumnRenamed("rows", name)
        for layer, name in (("raw_trips", "source_count"), ("bronze_trips", "bronze_count"))
    )
    both = source.join(bronze, ["year", "month"], "full").select(
        "year",
        "month",
        F.coalesce(c("source_count"), F.lit(0)).alias("source_count"),
        F.coalesce(c("bronze_count"), F.lit(0)).alias("bronze_count"),
    )
    divergent = count_true(c("source_count") != c("bronze_count"))
    return both.agg(
        F.count(F.lit(1)).alias("compared_partitions"),
        F.sum("source_count").alias("source_total"),
        F.sum("bronze_count").alias("bronze_total"),
        (F.sum("bronze_count") - F.sum("source_count")).alias("total_difference"),
        divergent.alias("divergent_partitions"),
        F.when(
            (F.count(F.lit(1)) == lake.cfg.expected_month_partitions) & (divergent == 0),
            F.lit("BRONZE_VALIDATED"),
        )
        .otherwise(F.lit("VALIDATION_FAILED"))
        .alias("validation_status"),
    )


def bronze_zone_profile(lake) -> DataFrame:
    """Zone lookup profile with the first failing status (AG4, VR2).

    The per-id occurrence counts are a small aggregate reduced to one row
    and combined with the one-row profile (a one-row by one-row product).
    """
    z = lake.bronze_zones
    per_id = z.groupBy("LocationID").agg(F.count(F.lit(1)).alias("occurrences"))
    dup = per_id.agg(
        count_true(c("occurrences") > 1).alias("duplicated_location_ids"),
        F.coalesce(
            F.sum(F.when(c("occurrences") > 1, c("occurrences") - 1).otherwise(F.lit(0))), F.lit(0)
        ).alias("duplicated_rows"),
    )
    profile = z.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("LocationID").alias("distinct_location_ids"),
        count_true(c("LocationID").isNull()).alias("null_location_ids"),
        count_true(is_blank(c("Borough"))).alias("missing_borough"),
        count_true(is_blank(c("Zone"))).alias("missing_zone"),
        count_true(is_blank(c("service_zone"))).alias("missing_service_zone"),
        count_true(
            c("_source_system").isNull() | (c("_source_system") != ZONE_SOURCE_SYSTEM)
        ).alias("invalid_source_system"),
        count_true(
            c("_source_format").isNull() | (c("_source_format") != ZONE_SOURCE_FORMAT)
        ).alias("invalid_source_format"),
        count_true(is_blank(c("_source_path"))).alias("missing_source_path"),
        count_true(c("_pipeline_refresh_timestamp").isNull()).alias("missing_refresh_timestamp"),
    )
    status = (
        F.when(c("row_count") != lake.cfg.expected_zone_rows, F.lit("UNEXPECTED_ROW_COUNT"))
        .when(c("null_location_ids") > 0, F.lit("NULL_LOCATION_ID"))
        .when(c("duplicated_location_ids") > 0, F.lit("DUPLICATED_LOCATION_ID"))
        .when(
            (c("missing_borough") > 0) | (c("missing_zone") > 0) | (c("missing_service_zone") > 0),
            F.lit("MISSING_REFERENCE_ATTRIBUTE"),
        )
        .when(
            (c("invalid_source_system") > 0)
            | (c("invalid_source_format") > 0)
            | (c("missing_source_path") > 0)
            | (c("missing_refresh_timestamp") > 0),
            F.lit("INVALID_TECHNICAL_METADATA"),
        )
        .otherwise(F.lit("BRONZE_LOOKUP_VALIDATED"))
    )
    return combine(profile, dup).select(
        "row_count",
        "distinct_location_ids",
        "null_location_ids",
        "duplicated_location_ids",
        "duplicated_rows",
        "missing_borough",
        "missing_zone",
        "missing_service_zone",
        "invalid_source_system",
        "invalid_source_format",
        "missing_source_path",
        "missing_refresh_timestamp",
        status.alias("validation_status"),
    )


def quarantine_reason_counts(lake) -> DataFrame:
    """Quarantined trips per critical reason (a trip counts once per reason)."""
    return (
        lake.quarantine_trips.select(F.explode("_dq_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(c("record_count").desc(), "reason")
    )
