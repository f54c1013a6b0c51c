"""Run parameters and fixed code lists.

Everything a pipeline run can vary lives in :class:`RunConfig`; operators take
it as an argument and never read session configuration themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the source contract for results to match.
# Valid business codes, in natural order.
VALID_PAYMENT_TYPE_CODES = (0, 1, 2, 3, 4, 5, 6)
VALID_RATE_CODE_IDS = (1, 2, 3, 4, 5, 6, 99)
VALID_VENDOR_IDS = (1, 2, 6, 7)
# Payment codes under which a tip can be reported (flex fare, credit card).
TIP_SUPPORTED_PAYMENT_CODES = (0, 1)
FLEX_FARE_PAYMENT_CODE = 0
CREDIT_CARD_PAYMENT_CODE = 1
# Airport zones: location id -> airport code.
AIRPORT_ZONES = {132: "JFK", 138: "LGA", 1: "EWR"}
# Contract version stamped on Silver rows and required by Gold.
QUALITY_RULE_VERSION = "2.0"
# Lineage constants written by the Bronze layer.
TRIP_SOURCE_SYSTEM = "aws_glue"
ZONE_SOURCE_SYSTEM = "unity_catalog_volume"
ZONE_SOURCE_FORMAT = "csv"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one pipeline run (defaults follow the source contract)."""

    expected_pickup_year: int = 2025
    max_trip_duration_minutes: int = 360
    financial_tolerance: str = "0.01"
    quality_rule_version: str = QUALITY_RULE_VERSION
    trip_source_table: str = "yellow_tripdata"
    zone_source_path: str = "taxi_zone_lookup.csv"
    # Bronze report constants (data specific, hence parameters).
    expected_month_partitions: int = 12
    expected_zone_rows: int = 265
    # Bytes up to which a materialised lookup of counted rows is broadcast.
    broadcast_bytes: int = 64 << 20
    # Shared folder of the published layers; None takes ``spark.checkpoint.dir``.
    shared_folder: str | None = None


# The binding of the driver's TPC-H-like tables uses order year 1998.
FIXTURE_CONFIG = RunConfig(
    expected_pickup_year=1998,
    trip_source_table="tpch.lineitem_trips",
    zone_source_path="tpch/nation_zone_lookup",
    # 25 nation zones plus 7 dirty rows.
    expected_zone_rows=32,
)
