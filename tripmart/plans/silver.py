"""Silver layer: zone lookup and trip classification, valid / quarantine split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.config import RunConfig
from tripmart.functions.identity import record_hash
from tripmart.functions.measures import date_parts, duration_minutes
from tripmart.operators.dedup import flag_duplicates
from tripmart.operators.eligibility import add_eligibility
from tripmart.operators.normalize import HASH_COLUMNS, normalize_trips
from tripmart.operators.quality import add_critical_reasons, add_row_flags, add_warnings
from tripmart.operators.zones import attach_zones, classify_zones

TECHNICAL_COLUMNS = ("_source_row_id", "_is_duplicate_canonical")


def classified_zones(bronze_zones: DataFrame) -> DataFrame:
    """The zone lookup with its reasons and quarantine flag; both parts are published as layers."""
    return classify_zones(bronze_zones)


def hashed_trips(bronze: DataFrame) -> DataFrame:
    """Normalised trips with their record hash."""
    normalized = normalize_trips(bronze)
    return normalized.withColumn("_record_hash", record_hash(HASH_COLUMNS))


def classify_trips(
    hashed: DataFrame, groups: DataFrame, valid_zones: DataFrame, cfg: RunConfig, zone_rows: int
) -> DataFrame:
    """Every Bronze trip with zone attributes, identity, reasons, flags, eligibility.

    Plan shape: one scan of the hashed trips; their duplicate groups joined
    back by a size-checked broadcast; the zone lookup joined twice by
    broadcast; everything else is row-local projection.
    """
    flagged = flag_duplicates(hashed, groups, max_bytes=cfg.broadcast_bytes)
    zones = valid_zones.select("location_id", "borough", "zone", "service_zone")
    enriched = attach_zones(flagged, zones, zone_rows, cfg.broadcast_bytes)
    measured = enriched.withColumns(date_parts()).withColumn(
        "trip_duration_minutes", duration_minutes("pickup_datetime", "dropoff_datetime")
    ).withColumn("record_hash", F.col("_record_hash"))
    classified = add_eligibility(
        add_warnings(add_row_flags(add_critical_reasons(measured, cfg), cfg))
    )
    stamped = classified.withColumns(
        {
            "_quality_rule_version": F.lit(cfg.quality_rule_version),
            "_silver_refresh_timestamp": F.current_timestamp(),
            "_eligibility_refresh_timestamp": F.current_timestamp(),
        }
    )
    return stamped.drop(*TECHNICAL_COLUMNS)


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(published Silver, quarantine) from one classified frame."""
    return (
        classified.where(~F.col("_is_quarantined")),
        classified.where(F.col("_is_quarantined")),
    )
