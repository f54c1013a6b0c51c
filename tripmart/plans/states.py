"""Mergeable state of the fact by source partition (AG11, AG14-AG17, JN7).

Each is a small layer that is brought up to date with the months that changed
and folded by the reports, which then read no fact:

* ``fact_states``: additive sums and counts by zone pair, payment, rate,
  vendor and airport;
* ``fact_members``: the dimension members each foreign key uses, with their rows;
* ``fact_sketches``: HyperLogLog sketches of the routes, merged by union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.kpi import count_where, sum_where

SOURCE_BY = ("source_year", "source_month")
STATE_KEYS = (
    *SOURCE_BY, "route_key", "pickup_zone_key", "dropoff_zone_key", "payment_type_key", "rate_code_key", "vendor_key",
    "airport_trip_code", "is_airport_trip",
)
SUMS = (
    "trip_count", "total_amount", "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "cbd_congestion_fee_amount", "airport_fee_amount",
    "trip_distance_miles", "trip_duration_minutes", "passenger_count",
)
#: Measures whose mean is asked for: the rows that have a value are counted beside the sum.
COUNTED = ("total_amount", "trip_distance_miles", "trip_duration_minutes", "passenger_count")
#: Measures summed over the trips that count for efficiency.
EFFICIENT = ("trip_count", "total_amount", "trip_distance_miles", "trip_duration_minutes")
#: Size parameter of a sketch (its relative error is about 1.04 / sqrt(2**12)).
SKETCH_BITS = 12


def fact_states(fact: DataFrame) -> DataFrame:
    c = F.col
    return fact.groupBy(*STATE_KEYS).agg(
        *[F.sum(m).alias(m) for m in SUMS],
        *[F.count(m).alias(f"rows_{m}") for m in COUNTED],
        *[sum_where(c(m), c("is_efficiency_kpi_eligible")).alias(f"efficient_{m}") for m in EFFICIENT],
        count_where(c("is_route_metric_eligible")).alias("route_eligible_trips"),
    )


def fact_members(fact: DataFrame, keys: list[str]) -> DataFrame:
    """``(source partition, fact_key, member, rows)`` for every foreign key."""
    uses = F.explode(F.array(*[F.struct(F.lit(k).alias("fact_key"), F.col(k).alias("member")) for k in keys]))
    used = fact.select(*SOURCE_BY, uses.alias("use")).select(*SOURCE_BY, "use.*")
    return used.groupBy(*SOURCE_BY, "fact_key", "member").agg(F.count(F.lit(1)).alias("rows"))


def fact_sketches(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*SOURCE_BY).agg(F.hll_sketch_agg("route_key", SKETCH_BITS).alias("routes"))
