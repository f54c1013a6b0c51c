"""Registered queries: one entry per operator key of the coverage checklist.

Each entry maps a :class:`~tripmart.plans.lake.Lake` to a DataFrame. The
driver entry point wraps them as ``(spark, sf_dir) -> DataFrame`` and renders
engine-neutral types (:mod:`tripmart.plans.compare`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dedup import number_duplicates
from tripmart.plans import expectations, gold_validation, inventory, reports, validation
from tripmart.plans.lake import Lake

c = F.col

FLAG_COLUMNS = [
    "_is_zero_distance",
    "_is_passenger_count_missing",
    "_is_zero_passenger_count",
    "_is_negative_passenger_count",
    "_is_non_positive_passenger_count",
    "_is_flex_fare",
    "_is_expected_flex_fare_passenger_gap",
    "_is_unexpected_passenger_count_missing",
    "_is_negative_total_amount",
    "_is_negative_fare_amount",
    "_is_negative_tip_amount",
    "_has_negative_financial_component",
    "_is_rate_code_missing_or_unmapped",
    "_is_expected_flex_fare_rate_gap",
    "_is_unexpected_rate_code_gap",
    "_is_vendor_missing_or_unmapped",
    "_is_payment_type_missing_or_unmapped",
    "_is_cross_year_trip",
    "_is_tip_reported_outside_supported_payment",
    "_is_long_trip",
    "_is_efficiency_kpi_eligible",
]
ELIGIBILITY_COLUMNS = [
    "_is_trip_volume_metric_eligible",
    "_is_passenger_metric_eligible",
    "_is_distance_metric_eligible",
    "_is_duration_metric_eligible",
    "_is_efficiency_metric_eligible",
    "_is_recorded_amount_metric_eligible",
    "_is_financial_breakdown_metric_eligible",
    "_is_reported_tip_metric_eligible",
    "_is_rate_code_metric_eligible",
    "_is_vendor_metric_eligible",
    "_is_payment_type_metric_eligible",
    "_is_route_metric_eligible",
    "_is_reversal_or_adjustment",
    "_is_ml_distance_feature_eligible",
    "_is_ml_passenger_feature_eligible",
    "_is_ml_financial_feature_eligible",
    "_is_ml_categorical_feature_eligible",
    "_is_standard_operational_trip_eligible",
    "_is_ml_standard_trip_eligible",
    "_requires_gold_date_extension",
    "_requires_data_review",
]


def _classified(*cols: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: lake.trips_classified.select("record_hash", *cols)


def _trip_duplicates(lake: Lake) -> DataFrame:
    """Group size, flags and occurrence number of every trip, from the classified copy.

    Rows of a group are alike, so any numbering that starts at its canonical
    row serves; the numbers are given to the members of groups alone.
    """
    flagged = lake.trips_classified.select(
        "record_hash", "_duplicate_record_count", "_is_duplicate_group", "_is_duplicate_record"
    ).withColumn("_row", F.monotonically_increasing_id())
    return number_duplicates(flagged, key="record_hash", row_id="_row").drop("_row")


QUERIES: dict[str, Callable[[Lake], DataFrame]] = {
    # Bronze and sources
    "bronze_trips": lambda lake: lake.bronze_trips,
    "bronze_zones": lambda lake: lake.bronze_zones,
    "source_profile_by_month": inventory.source_profile_by_month,
    "source_profile_total": inventory.source_profile_total,
    "bronze_reconciliation": reports.bronze_reconciliation,
    "bronze_zone_profile": reports.bronze_zone_profile,
    # Silver building blocks
    "trips_normalized": lambda lake: lake.hashed_trips.drop("_record_hash", "_source_row_id"),
    "trip_record_hash": lambda lake: lake.hashed_trips.select(
        c("_record_hash").alias("record_hash"), "_source_row_id"
    ),
    "trip_duplicates": _trip_duplicates,
    "trips_zone_enriched": _classified(
        "pickup_zone_location_id",
        "pickup_borough",
        "pickup_zone",
        "pickup_service_zone",
        "dropoff_zone_location_id",
        "dropoff_borough",
        "dropoff_zone",
        "dropoff_service_zone",
    ),
    "trip_date_parts": _classified(
        "pickup_date",
        "dropoff_date",
        "pickup_year",
        "dropoff_year",
        "pickup_month",
        "pickup_day",
        "pickup_hour",
        "pickup_day_of_week",
        "trip_duration_minutes",
    ),
    "trip_flags": _classified(*FLAG_COLUMNS),
    "trip_reconciliation": _classified(
        "_financial_component_amount",
        "_financial_reconciliation_difference",
        "_is_financially_unreconciled",
    ),
    "trip_critical_reasons": _classified("_dq_reasons", "_is_quarantined"),
    "trip_warning_reasons": _classified("_dq_warning_reasons", "_dq_warning_count", "_has_dq_warnings"),
    "trip_eligibility": _classified(*ELIGIBILITY_COLUMNS),
    "trip_statuses": _classified(
        "_passenger_data_status", "_distance_data_status", "_financial_record_type"
    ),
    "trip_eligibility_reasons": _classified(
        "_eligibility_reasons", "_eligibility_restriction_count", "_eligibility_status"
    ),
    "zones_classified": lambda lake: lake.zones_classified,
    "silver_zones": lambda lake: lake.silver_zones,
    "quarantine_zones": lambda lake: lake.quarantine_zones,
    "silver_trips": lambda lake: lake.silver_trips,
    "quarantine_trips": lambda lake: lake.quarantine_trips,
    "quarantine_reason_counts": reports.quarantine_reason_counts,
    # Gold
    "gold_trip_source": lambda lake: lake.gold_trip_source,
    "gold_zone_source": lambda lake: lake.gold_zone_source,
    "dim_date": lambda lake: lake.dim_date,
    "dim_pickup_zone": lambda lake: lake.dim_pickup_zone,
    "dim_dropoff_zone": lambda lake: lake.dim_dropoff_zone,
    "fact_trips": lambda lake: lake.fact_trips,
    # Inventory, KPIs, listings
    "dim_date_holidays": inventory.dim_date_holidays,
    "dim_date_profile": inventory.dim_date_profile,
    "zones_by_borough": inventory.zones_by_borough,
    "airport_zones": inventory.airport_zones,
    "fact_profile": inventory.fact_profile,
    "trips_by_hour": inventory.trips_by_hour,
    "payment_type_usage": inventory.payment_type_usage,
    "rate_code_usage": inventory.rate_code_usage,
    "vendor_usage": inventory.vendor_usage,
    "fact_routes_approx": inventory.fact_routes_approx,
    "kpi_by_payment_type": inventory.kpi_by_payment_type,
    "kpi_by_rate_code": inventory.kpi_by_rate_code,
    "kpi_by_airport": inventory.kpi_by_airport,
    "kpi_by_route": inventory.kpi_by_route,
    "kpi_baseline": inventory.kpi_baseline,
    # Contract counters and validation reports
    "silver_contract_counts": validation.silver_contract_counts,
    "quarantine_contract_counts": validation.quarantine_contract_counts,
    "silver_validation": validation.silver_validation,
    "gold_aggregate_parity": gold_validation.gold_aggregate_parity,
    "gold_fact_counts": gold_validation.gold_fact_counts,
    "gold_record_parity": gold_validation.gold_record_parity,
    "gold_foreign_keys": gold_validation.gold_foreign_keys,
    "gold_dimension_stats": gold_validation.gold_dimension_stats,
    "gold_validation": gold_validation.gold_validation,
    # Expectation sets
    **{key: expectations.report(key) for key in expectations.SETS},
}
