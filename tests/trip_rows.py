"""Minimal raw trip rows for rule tests: one clean 2025 trip plus overrides."""

from __future__ import annotations

import datetime as dt

from tripmart.config import RunConfig
from tripmart.operators.dedup import duplicate_groups
from tripmart.plans import gold, silver
from tripmart.sources.inline import inline_rows
from tripmart.sources.trips import bronze_trips

CFG = RunConfig(expected_pickup_year=2025)
RAW_DDL = (
    "VendorID bigint, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double, "
    "year string, month string, _source_row_id bigint"
)
FIELDS = [f.split()[0] for f in RAW_DDL.split(", ")]
PICKUP = dt.datetime(2025, 3, 10, 8, 0, 0)


def clean(**over) -> dict:
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": PICKUP,
        "tpep_dropoff_datetime": PICKUP + dt.timedelta(minutes=20),
        "passenger_count": 1,
        "trip_distance": 3.5,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 10,
        "DOLocationID": 11,
        "payment_type": 1,
        "fare_amount": 20.0,
        "extra": 1.0,
        "mta_tax": 0.5,
        "tip_amount": 4.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 29.0,
        "congestion_surcharge": 2.5,
        "Airport_fee": 0.0,
        "cbd_congestion_fee": 0.0,
        "year": "2025",
        "month": "3",
    }
    row.update(over)
    return row


ZONE_DDL = "location_id int, borough string, zone string, service_zone string"
ZONES = [(10, "Manhattan", "Midtown", "Yellow Zone"), (11, "Queens", "Astoria", "Boro Zone"),
         (132, "Queens", "JFK Airport", "Airports")]


def classify(spark, rows: list[dict]):
    data = [tuple(r.get(f) for f in FIELDS[:-1]) + (i,) for i, r in enumerate(rows)]
    raw = inline_rows(spark, data, RAW_DDL)
    zones = inline_rows(spark, ZONES, ZONE_DDL)
    bronze = bronze_trips(raw, 2025, "test")
    hashed = silver.hashed_trips(bronze)
    return silver.classify_trips(hashed, duplicate_groups(hashed), zones, CFG, len(ZONES))


def by_id(df) -> dict:
    """Rows keyed by position of the input row (hash order is not input order)."""
    return {r["record_hash"]: r for r in df.collect()}
