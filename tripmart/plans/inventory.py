"""Source profiles, dimension listings and business KPIs (AG1-AG2, AG11-AG17, LS1-LS3, FC6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.checks import combine
from tripmart.operators.kpi import count_where, ratio, sum_where
from tripmart.operators.lookup import broadcast_bounded
from tripmart.plans.states import EFFICIENT

c = F.col


def source_profile_by_month(lake) -> DataFrame:
    """Rows and pickup range per source partition (year, month)."""
    return (
        lake.raw_trips.groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.min("tpep_pickup_datetime").alias("min_pickup"),
            F.max("tpep_pickup_datetime").alias("max_pickup"),
        )
        .orderBy("year", "month")
    )


def source_profile_total(lake) -> DataFrame:
    return lake.raw_trips.agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count_distinct("year", "month").alias("published_months"),
        F.min("tpep_pickup_datetime").alias("min_pickup"),
        F.max("tpep_pickup_datetime").alias("max_pickup"),
        F.sum("total_amount").alias("gross_revenue"),
    )


def dim_date_holidays(lake) -> DataFrame:
    return (
        lake.dim_date.where(c("is_federal_holiday"))
        .select("full_date", "holiday_name", "holiday_scope")
        .orderBy("full_date")
    )


def dim_date_profile(lake) -> DataFrame:
    return lake.dim_date.where(c("date_key") != 0).agg(
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
        F.count(F.lit(1)).alias("date_member_count"),
        count_where(c("is_weekend")).alias("weekend_days"),
        count_where(c("is_federal_holiday")).alias("federal_holidays"),
        count_where(c("is_business_day")).alias("business_days"),
    )


def zones_by_borough(lake) -> DataFrame:
    return (
        lake.dim_pickup_zone.where(c("pickup_zone_key") != 0)
        .groupBy("pickup_borough", "pickup_service_zone")
        .agg(F.count(F.lit(1)).alias("zone_count"))
        .orderBy("pickup_borough", "pickup_service_zone")
    )


def airport_zones(lake) -> DataFrame:
    return (
        lake.dim_pickup_zone.where(c("is_airport_zone"))
        .select(
            "pickup_location_id",
            "pickup_borough",
            "pickup_zone_name",
            "pickup_zone_display_name",
            "airport_code",
        )
        .orderBy("airport_code")
    )


def fact_profile(lake) -> DataFrame:
    """Semantic profile of the fact: exact measures in one aggregate pass."""
    f = lake.fact_trips
    return f.agg(
        F.count(F.lit(1)).alias("fact_row_count"),
        F.count_distinct("trip_key").alias("distinct_trip_count"),
        F.min("pickup_datetime").alias("min_pickup_datetime"),
        F.max("pickup_datetime").alias("max_pickup_datetime"),
        F.min("dropoff_datetime").alias("min_dropoff_datetime"),
        F.max("dropoff_datetime").alias("max_dropoff_datetime"),
        count_where(c("passenger_count").isNull()).alias("missing_passenger_count"),
        count_where(c("trip_distance_miles") <= 0).alias("non_positive_distance"),
        count_where(c("trip_duration_minutes") <= 0).alias("non_positive_duration"),
        count_where(~c("is_efficiency_kpi_eligible")).alias("efficiency_ineligible_trips"),
        count_where(c("total_amount") < 0).alias("negative_total_amount_trips"),
        count_where(c("fare_amount") < 0).alias("negative_fare_amount_trips"),
        count_where(c("tip_amount") < 0).alias("negative_tip_amount_trips"),
        count_where(c("is_airport_trip")).alias("airport_trips"),
        count_where(c("has_reported_electronic_tip")).alias("trips_with_reported_electronic_tip"),
        count_where(
            (c("pickup_date_key") == 0)
            | (c("dropoff_date_key") == 0)
            | (c("pickup_zone_key") == 0)
            | (c("dropoff_zone_key") == 0)
        ).alias("unknown_critical_dimension_trips"),
        count_where(
            (c("payment_type_key") == -1) | (c("rate_code_key") == -1) | (c("vendor_key") == -1)
        ).alias("unknown_business_dimension_trips"),
    )


#: Relative error the route estimate is asked for, and the multiple of it that is still accepted.
ROUTE_ERROR, ROUTE_SIGMAS = 0.02, 4


def fact_routes_approx(lake) -> DataFrame:
    """Distinct routes, and whether the union of the months' sketches estimates them as near as promised."""
    exact = lake.fact_states.agg(F.count_distinct("route_key").alias("distinct_routes"))
    estimate = lake.fact_sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("routes")).alias("estimate"))
    near = F.abs(c("estimate") - c("distinct_routes")) <= F.ceil(c("distinct_routes") * F.lit(ROUTE_ERROR * ROUTE_SIGMAS))
    return combine(exact, estimate).select("distinct_routes", F.coalesce(near, c("distinct_routes") == 0).alias("estimate_within_tolerance"))


def _usage(lake, dimension: str, key: str, fact_key: str, *columns: str) -> DataFrame:
    """Members of a dimension that trips use, with their trips and amounts, in key order."""
    members = broadcast_bounded(lake.dimension(dimension).select(key, *columns), lake.dimension_rows(dimension))
    used = lake.fact_trips.groupBy(F.col(fact_key).alias(key)).agg(
        F.sum("trip_count").alias("trip_count"), F.sum("total_amount").alias("total_amount")
    )
    return used.join(members, key).select(key, *columns, "trip_count", "total_amount").orderBy(key)


def trips_by_hour(lake) -> DataFrame:
    """Trips and recorded amount per pickup hour, with its bands."""
    return _usage(
        lake, "dim_time", "time_key", "pickup_time_key", "hour_number", "hour_range", "day_period", "business_time_band",
        "is_peak_hour",
    )


def payment_type_usage(lake) -> DataFrame:
    return _usage(lake, "dim_payment_type", "payment_type_key", "payment_type_key", "payment_type_name", "tip_data_note")


def rate_code_usage(lake) -> DataFrame:
    return _usage(lake, "dim_rate_code", "rate_code_key", "rate_code_key", "rate_code_name", "airport_code")


def vendor_usage(lake) -> DataFrame:
    return _usage(lake, "dim_vendor", "vendor_key", "vendor_key", "vendor_name", "vendor_short_name")


def _with_payment(lake) -> DataFrame:
    pay = broadcast_bounded(lake.dim_payment_type, 8)
    return lake.fact_states.join(pay, "payment_type_key")


def kpi_by_payment_type(lake) -> DataFrame:
    return (
        _with_payment(lake)
        .groupBy("payment_type_name", "payment_category", "is_electronic_payment")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("tip_amount").alias("raw_tip_amount"),
        )
        .orderBy(c("trip_count").desc())
    )


def kpi_by_rate_code(lake) -> DataFrame:
    rate = broadcast_bounded(lake.dim_rate_code, 8)
    return (
        lake.fact_states.join(rate, "rate_code_key")
        .groupBy("rate_code_name", "rate_category", "airport_code")
        .agg(F.sum("trip_count").alias("trip_count"), F.sum("total_amount").alias("total_amount"))
        .orderBy(c("trip_count").desc())
    )


def _mean(measure: str):
    """Mean of a measure over the trips that have it, from its sums and counts."""
    return ratio(F.sum(measure), F.sum(f"rows_{measure}"))


def kpi_by_airport(lake) -> DataFrame:
    segment = F.coalesce(c("airport_trip_code"), F.lit("Non-airport")).alias("airport_trip_segment")
    return (
        lake.fact_states.groupBy(segment)
        .agg(
            F.sum("trip_count").alias("trip_count"),
            F.sum("total_amount").alias("total_amount"),
            _mean("total_amount").alias("average_total_amount"),
            _mean("trip_distance_miles").alias("average_distance"),
            _mean("trip_duration_minutes").alias("average_duration"),
        )
        .orderBy(c("trip_count").desc())
    )


def kpi_by_route(lake) -> DataFrame:
    """Trips and recorded amount per pickup/dropoff zone pair."""
    return (
        lake.fact_states.groupBy("route_key", "pickup_zone_key", "dropoff_zone_key")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("route_eligible_trips").alias("route_eligible_trips"),
        )
        .orderBy(c("trip_count").desc(), "route_key")
    )


def kpi_baseline(lake) -> DataFrame:
    """Business KPI baseline: totals, filtered sums and ratios of sums (AG17), folded from additive states."""
    f = _with_payment(lake)
    card = c("payment_type_code") == 1
    trips = F.sum("trip_count")
    amount = F.sum("total_amount")
    el_trips, el_amount, el_miles, el_minutes = (F.sum(f"efficient_{m}") for m in EFFICIENT)
    pax, pax_trips = F.sum("passenger_count"), F.sum("rows_passenger_count")
    return f.agg(
        trips.alias("trip_count"),
        amount.alias("total_recorded_amount"),
        ratio(amount, trips).alias("average_recorded_amount_per_trip"),
        F.sum("fare_amount").alias("fare_amount"),
        F.sum("extra_amount").alias("extra_amount"),
        F.sum("mta_tax_amount").alias("mta_tax_amount"),
        F.sum("tolls_amount").alias("tolls_amount"),
        F.sum("improvement_surcharge_amount").alias("improvement_surcharge_amount"),
        F.sum("congestion_surcharge_amount").alias("congestion_surcharge_amount"),
        F.sum("cbd_congestion_fee_amount").alias("cbd_congestion_fee_amount"),
        F.sum("airport_fee_amount").alias("airport_fee_amount"),
        sum_where(c("tip_amount"), card).alias("reported_card_tip_amount"),
        el_trips.alias("efficiency_eligible_trip_count"),
        ratio(el_miles, el_trips).alias("average_eligible_distance_miles"),
        ratio(el_minutes, el_trips).alias("average_eligible_duration_minutes"),
        ratio(el_miles * F.lit(60), el_minutes).alias("estimated_average_speed_mph"),
        ratio(el_amount, el_miles).alias("recorded_amount_per_mile"),
        pax.alias("reported_passenger_count"),
        pax_trips.alias("trips_with_reported_passenger_count"),
        ratio(pax, pax_trips).alias("average_reported_passengers"),
        ratio(sum_where(c("trip_count"), card), trips).alias("credit_card_trip_share"),
        ratio(sum_where(c("trip_count"), c("is_airport_trip")), trips).alias("airport_trip_share"),
    )
