"""Zone lookup classification (DQ3, DUP2) and the role-split zone join (PRJ7, JN1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.predicates import reason_array
from tripmart.operators.lookup import BROADCAST_BYTES, broadcast_bounded
from tripmart.operators.normalize import normalize_zones
from tripmart.operators.quality import zone_rules

ZONE_ATTRIBUTES = (("location_id", "zone_location_id"), ("borough", "borough"), ("zone", "zone"), ("service_zone", "service_zone"))


def classify_zones(bronze_zones: DataFrame) -> DataFrame:
    """Normalise, count rows per id (NULL ids form one group), attach reasons.

    Reject-all duplicate policy: every member of a duplicated id is rejected.
    The per-id count is an aggregate joined back null-safely instead of a
    window, so a repeated id never forces its rows into one task.
    """
    zones = normalize_zones(bronze_zones)
    counts = zones.groupBy(F.col("location_id").alias("_dup_id")).agg(
        F.count(F.lit(1)).alias("_duplicate_location_id_count")
    )
    joined = zones.join(counts, zones["location_id"].eqNullSafe(counts["_dup_id"]), "left").drop(
        "_dup_id"
    )
    return (
        joined.withColumn("_dq_reasons", reason_array(zone_rules()))
        .withColumn("_is_quarantined", F.size("_dq_reasons") > 0)
        .withColumn("_silver_refresh_timestamp", F.current_timestamp())
    )


def role_zones(zones: DataFrame, role: str) -> DataFrame:
    """One role's copy of the lookup: ``{role}_zone_location_id``, ``{role}_borough``..."""
    return zones.select(*[F.col(src).alias(f"{role}_{dst}") for src, dst in ZONE_ATTRIBUTES])


def attach_zones(
    trips: DataFrame, zones: DataFrame, zone_rows: int, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left-join the lookup twice (pickup, dropoff).

    The valid lookup has unique ids, so neither join multiplies rows.
    ``zone_rows`` is the counted size of the materialised lookup: under
    ``max_bytes`` both joins are broadcast and the trip side is never
    shuffled; above it the planner chooses a shuffle join.
    """
    pickup = broadcast_bounded(role_zones(zones, "pickup"), zone_rows, max_bytes)
    dropoff = broadcast_bounded(role_zones(zones, "dropoff"), zone_rows, max_bytes)
    return trips.join(
        pickup, F.col("pickup_location_id") == F.col("pickup_zone_location_id"), "left"
    ).join(dropoff, F.col("dropoff_location_id") == F.col("dropoff_zone_location_id"), "left")
