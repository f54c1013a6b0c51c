"""Oracle SQL per registered query key (DuckDB dialect).

Each statement is the full CTE chain (fixture binding, Bronze, Silver, Gold)
followed by the key's final SELECT. Output types follow the engine-neutral
rendering of the Spark side: decimals as DOUBLE, dates as text, string lists
joined by commas.
"""

from tripmart.oracle.base import HASH_COLS, RAW_TRIPS, RAW_ZONES, SILVER_TRIPS
from tripmart.oracle.gold import GOLD

CHAIN = "WITH " + ",".join([RAW_TRIPS, RAW_ZONES, SILVER_TRIPS, GOLD])

MONEY = [
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "total_amount", "congestion_surcharge_amount",
    "airport_fee_amount", "cbd_congestion_fee_amount",
]
SILVER_DECIMALS = ["trip_distance", *MONEY, "_financial_component_amount", "_financial_reconciliation_difference"]
SILVER_DATES = ["pickup_date", "dropoff_date"]
SILVER_ARRAYS = ["_dq_reasons", "_dq_warning_reasons", "_eligibility_reasons"]
GOLD_DECIMALS = ["trip_distance_miles", "trip_duration_minutes", *MONEY,
                 "financial_component_amount", "financial_reconciliation_difference"]
GOLD_ARRAYS = ["critical_quality_reasons", "dq_warning_reasons", "eligibility_reasons"]
FACT_DECIMALS = GOLD_DECIMALS + ["reported_card_tip_amount"]
FACT_ARRAYS = ["dq_warning_reasons", "eligibility_reasons"]

FLAG_COLUMNS = [
    "_is_zero_distance", "_is_passenger_count_missing", "_is_zero_passenger_count",
    "_is_negative_passenger_count", "_is_non_positive_passenger_count", "_is_flex_fare",
    "_is_expected_flex_fare_passenger_gap", "_is_unexpected_passenger_count_missing",
    "_is_negative_total_amount", "_is_negative_fare_amount", "_is_negative_tip_amount",
    "_has_negative_financial_component", "_is_rate_code_missing_or_unmapped",
    "_is_expected_flex_fare_rate_gap", "_is_unexpected_rate_code_gap",
    "_is_vendor_missing_or_unmapped", "_is_payment_type_missing_or_unmapped",
    "_is_cross_year_trip", "_is_tip_reported_outside_supported_payment", "_is_long_trip",
    "_is_efficiency_kpi_eligible",
]
ELIGIBILITY_COLUMNS = [
    "_is_trip_volume_metric_eligible", "_is_passenger_metric_eligible",
    "_is_distance_metric_eligible", "_is_duration_metric_eligible",
    "_is_efficiency_metric_eligible", "_is_recorded_amount_metric_eligible",
    "_is_financial_breakdown_metric_eligible", "_is_reported_tip_metric_eligible",
    "_is_rate_code_metric_eligible", "_is_vendor_metric_eligible",
    "_is_payment_type_metric_eligible", "_is_route_metric_eligible", "_is_reversal_or_adjustment",
    "_is_ml_distance_feature_eligible", "_is_ml_passenger_feature_eligible",
    "_is_ml_financial_feature_eligible", "_is_ml_categorical_feature_eligible",
    "_is_standard_operational_trip_eligible", "_is_ml_standard_trip_eligible",
    "_requires_gold_date_extension", "_requires_data_review",
]


def _replace(decimals=(), dates=(), arrays=()) -> str:
    parts = [f"CAST({c} AS DOUBLE) AS {c}" for c in decimals]
    parts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    parts += [f"array_to_string({c}, ',') AS {c}" for c in arrays]
    return f"REPLACE ({', '.join(parts)})" if parts else ""


def _cols(names, decimals=(), dates=(), arrays=()) -> str:
    out = []
    for n in names:
        if n in decimals:
            out.append(f"CAST({n} AS DOUBLE) AS {n}")
        elif n in dates:
            out.append(f"strftime({n}, '%Y-%m-%d') AS {n}")
        elif n in arrays:
            out.append(f"array_to_string({n}, ',') AS {n}")
        else:
            out.append(n)
    return ", ".join(out)


def _classified(*cols) -> str:
    return (
        f"SELECT record_hash, {_cols(cols, SILVER_DECIMALS, SILVER_DATES, SILVER_ARRAYS)} "
        "FROM trips_classified"
    )


_SILVER_ROWS = (
    "SELECT * EXCLUDE (_duplicate_occurrence_number) "
    + _replace(SILVER_DECIMALS, SILVER_DATES, SILVER_ARRAYS)
)
_ZONE_ROWS = "SELECT * " + _replace(arrays=["_dq_reasons"])

FINAL: dict[str, str] = {
    # Bronze and sources
    "bronze_trips": "SELECT * EXCLUDE (source_row_id), source_row_id AS _source_row_id FROM bronze_trips",
    "bronze_zones": "SELECT * FROM bronze_zones",
    "source_profile_by_month": """
        SELECT year, month, CAST(count(*) AS BIGINT) AS trip_count,
               min(tpep_pickup_datetime) AS min_pickup, max(tpep_pickup_datetime) AS max_pickup
        FROM raw_trips GROUP BY year, month ORDER BY year, month""",
    "source_profile_total": """
        SELECT CAST(count(*) AS BIGINT) AS trip_count,
               CAST(count(DISTINCT (year, month)) FILTER (WHERE year IS NOT NULL AND month IS NOT NULL) AS BIGINT)
                 AS published_months,
               min(tpep_pickup_datetime) AS min_pickup, max(tpep_pickup_datetime) AS max_pickup,
               round(sum(total_amount), 2) AS gross_revenue
        FROM raw_trips""",
    "bronze_reconciliation": """
        , s AS (SELECT year, month, count(*) AS source_count FROM raw_trips WHERE year = '1998' GROUP BY ALL),
        b AS (SELECT year, month, count(*) AS bronze_count FROM bronze_trips WHERE year = '1998' GROUP BY ALL),
        cmp AS (SELECT coalesce(s.year, b.year) AS year, coalesce(s.month, b.month) AS month,
                       coalesce(source_count, 0) AS source_count, coalesce(bronze_count, 0) AS bronze_count
                FROM s FULL OUTER JOIN b ON s.year = b.year AND s.month = b.month)
        SELECT CAST(count(*) AS BIGINT) AS compared_partitions,
               CAST(sum(source_count) AS BIGINT) AS source_total,
               CAST(sum(bronze_count) AS BIGINT) AS bronze_total,
               CAST(sum(bronze_count) - sum(source_count) AS BIGINT) AS total_difference,
               CAST(count_if(source_count <> bronze_count) AS BIGINT) AS divergent_partitions,
               CASE WHEN count(*) = 12 AND count_if(source_count <> bronze_count) = 0
                    THEN 'BRONZE_VALIDATED' ELSE 'VALIDATION_FAILED' END AS validation_status
        FROM cmp""",
    "bronze_zone_profile": """
        , per_id AS (SELECT LocationID, count(*) AS occurrences FROM bronze_zones GROUP BY LocationID),
        d AS (SELECT CAST(count_if(occurrences > 1) AS BIGINT) AS duplicated_location_ids,
                     CAST(coalesce(sum(CASE WHEN occurrences > 1 THEN occurrences - 1 ELSE 0 END), 0) AS BIGINT)
                       AS duplicated_rows FROM per_id),
        p AS (SELECT CAST(count(*) AS BIGINT) AS row_count,
                     CAST(count(DISTINCT LocationID) AS BIGINT) AS distinct_location_ids,
                     CAST(count_if(LocationID IS NULL) AS BIGINT) AS null_location_ids,
                     CAST(count_if(Borough IS NULL OR trim(Borough) = '') AS BIGINT) AS missing_borough,
                     CAST(count_if(Zone IS NULL OR trim(Zone) = '') AS BIGINT) AS missing_zone,
                     CAST(count_if(service_zone IS NULL OR trim(service_zone) = '') AS BIGINT) AS missing_service_zone,
                     CAST(count_if(_source_system IS NULL OR _source_system <> 'unity_catalog_volume') AS BIGINT)
                       AS invalid_source_system,
                     CAST(count_if(_source_format IS NULL OR _source_format <> 'csv') AS BIGINT) AS invalid_source_format,
                     CAST(count_if(_source_path IS NULL OR trim(_source_path) = '') AS BIGINT) AS missing_source_path,
                     CAST(0 AS BIGINT) AS missing_refresh_timestamp
              FROM bronze_zones)
        SELECT p.*, d.*,
          CASE WHEN row_count <> 32 THEN 'UNEXPECTED_ROW_COUNT'
               WHEN null_location_ids > 0 THEN 'NULL_LOCATION_ID'
               WHEN duplicated_location_ids > 0 THEN 'DUPLICATED_LOCATION_ID'
               WHEN missing_borough > 0 OR missing_zone > 0 OR missing_service_zone > 0
                 THEN 'MISSING_REFERENCE_ATTRIBUTE'
               WHEN invalid_source_system > 0 OR invalid_source_format > 0 OR missing_source_path > 0
                    OR missing_refresh_timestamp > 0 THEN 'INVALID_TECHNICAL_METADATA'
               ELSE 'BRONZE_LOOKUP_VALIDATED' END AS validation_status
        FROM p CROSS JOIN d""",
    # Silver building blocks
    "trips_normalized": "SELECT "
    + _cols(HASH_COLS + ["store_and_forward_flag"], SILVER_DECIMALS)
    + " FROM trips_hashed",
    "trip_record_hash": "SELECT _record_hash AS record_hash, source_row_id AS _source_row_id FROM trips_hashed",
    "trip_duplicates": """
        SELECT _record_hash AS record_hash, _duplicate_record_count, _duplicate_occurrence_number,
               _duplicate_record_count > 1 AS _is_duplicate_group,
               _duplicate_occurrence_number > 1 AS _is_duplicate_record
        FROM trips_dedup""",
    "trips_zone_enriched": _classified(
        "pickup_zone_location_id", "pickup_borough", "pickup_zone", "pickup_service_zone",
        "dropoff_zone_location_id", "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
    ),
    "trip_date_parts": _classified(
        "pickup_date", "dropoff_date", "pickup_year", "dropoff_year", "pickup_month", "pickup_day",
        "pickup_hour", "pickup_day_of_week", "trip_duration_minutes",
    ),
    "trip_flags": _classified(*FLAG_COLUMNS),
    "trip_reconciliation": _classified(
        "_financial_component_amount", "_financial_reconciliation_difference", "_is_financially_unreconciled"
    ),
    "trip_critical_reasons": _classified("_dq_reasons", "_is_quarantined"),
    "trip_warning_reasons": _classified("_dq_warning_reasons", "_dq_warning_count", "_has_dq_warnings"),
    "trip_eligibility": _classified(*ELIGIBILITY_COLUMNS),
    "trip_statuses": _classified("_passenger_data_status", "_distance_data_status", "_financial_record_type"),
    "trip_eligibility_reasons": _classified(
        "_eligibility_reasons", "_eligibility_restriction_count", "_eligibility_status"
    ),
    "zones_classified": _ZONE_ROWS + " FROM zones_classified",
    "silver_zones": _ZONE_ROWS + " FROM silver_zones",
    "quarantine_zones": _ZONE_ROWS + " FROM quarantine_zones",
    "silver_trips": _SILVER_ROWS + " FROM silver_trips",
    "quarantine_trips": _SILVER_ROWS + " FROM quarantine_trips",
    "quarantine_reason_counts": """
        SELECT reason, CAST(count(*) AS BIGINT) AS record_count
        FROM (SELECT unnest(_dq_reasons) AS reason FROM quarantine_trips) r
        GROUP BY reason ORDER BY record_count DESC, reason""",
    # Gold
    "gold_trip_source": "SELECT * " + _replace(GOLD_DECIMALS, (), GOLD_ARRAYS) + " FROM gold_trip_source",
    "gold_zone_source": "SELECT * FROM gold_zone_source",
    "dim_date": "SELECT * " + _replace(dates=["full_date"]) + " FROM dim_date",
    "dim_pickup_zone": "SELECT * FROM dim_pickup_zone",
    "dim_dropoff_zone": "SELECT * FROM dim_dropoff_zone",
    "fact_trips": "SELECT * " + _replace(FACT_DECIMALS, (), FACT_ARRAYS) + " FROM fact_trips",
    # Inventory, KPIs, listings
    "dim_date_holidays": """
        SELECT strftime(full_date, '%Y-%m-%d') AS full_date, holiday_name, holiday_scope
        FROM dim_date WHERE is_federal_holiday ORDER BY 1""",
    "dim_date_profile": """
        SELECT strftime(min(full_date), '%Y-%m-%d') AS min_date, strftime(max(full_date), '%Y-%m-%d') AS max_date,
               CAST(count(*) AS BIGINT) AS date_member_count,
               CAST(count_if(is_weekend) AS BIGINT) AS weekend_days,
               CAST(count_if(is_federal_holiday) AS BIGINT) AS federal_holidays,
               CAST(count_if(is_business_day) AS BIGINT) AS business_days
        FROM dim_date WHERE date_key <> 0""",
    "zones_by_borough": """
        SELECT pickup_borough, pickup_service_zone, CAST(count(*) AS BIGINT) AS zone_count
        FROM dim_pickup_zone WHERE pickup_zone_key <> 0
        GROUP BY pickup_borough, pickup_service_zone ORDER BY 1, 2""",
    "airport_zones": """
        SELECT pickup_location_id, pickup_borough, pickup_zone_name, pickup_zone_display_name, airport_code
        FROM dim_pickup_zone WHERE is_airport_zone ORDER BY airport_code""",
    "fact_profile": """
        SELECT CAST(count(*) AS BIGINT) AS fact_row_count,
               CAST(count(DISTINCT trip_key) AS BIGINT) AS distinct_trip_count,
               min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime,
               min(dropoff_datetime) AS min_dropoff_datetime, max(dropoff_datetime) AS max_dropoff_datetime,
               CAST(count_if(passenger_count IS NULL) AS BIGINT) AS missing_passenger_count,
               CAST(count_if(trip_distance_miles <= 0) AS BIGINT) AS non_positive_distance,
               CAST(count_if(trip_duration_minutes <= 0) AS BIGINT) AS non_positive_duration,
               CAST(count_if(NOT is_efficiency_kpi_eligible) AS BIGINT) AS efficiency_ineligible_trips,
               CAST(count_if(total_amount < 0) AS BIGINT) AS negative_total_amount_trips,
               CAST(count_if(fare_amount < 0) AS BIGINT) AS negative_fare_amount_trips,
               CAST(count_if(tip_amount < 0) AS BIGINT) AS negative_tip_amount_trips,
               CAST(count_if(is_airport_trip) AS BIGINT) AS airport_trips,
               CAST(count_if(has_reported_electronic_tip) AS BIGINT) AS trips_with_reported_electronic_tip,
               CAST(count_if(pickup_date_key = 0 OR dropoff_date_key = 0 OR pickup_zone_key = 0
                             OR dropoff_zone_key = 0) AS BIGINT) AS unknown_critical_dimension_trips,
               CAST(count_if(payment_type_key = -1 OR rate_code_key = -1 OR vendor_key = -1) AS BIGINT)
                 AS unknown_business_dimension_trips
        FROM fact_trips""",
    "fact_routes_approx": """
        SELECT CAST(count(DISTINCT route_key) AS BIGINT) AS distinct_routes, TRUE AS estimate_within_tolerance
        FROM fact_trips""",
    "trips_by_hour": """
        SELECT t.time_key, t.hour_number, t.hour_range, t.day_period, t.business_time_band, t.is_peak_hour,
               CAST(count(*) AS BIGINT) AS trip_count, CAST(sum(f.total_amount) AS DOUBLE) AS total_amount
        FROM fact_trips f JOIN dim_time t ON t.time_key = f.pickup_time_key GROUP BY ALL ORDER BY 1""",
    "payment_type_usage": """
        SELECT p.payment_type_key, p.payment_type_name, p.tip_data_note, CAST(count(*) AS BIGINT) AS trip_count,
               CAST(sum(f.total_amount) AS DOUBLE) AS total_amount
        FROM fact_trips f JOIN dim_payment_type p USING (payment_type_key) GROUP BY ALL ORDER BY 1""",
    "rate_code_usage": """
        SELECT r.rate_code_key, r.rate_code_name, r.airport_code, CAST(count(*) AS BIGINT) AS trip_count,
               CAST(sum(f.total_amount) AS DOUBLE) AS total_amount
        FROM fact_trips f JOIN dim_rate_code r USING (rate_code_key) GROUP BY ALL ORDER BY 1""",
    "vendor_usage": """
        SELECT v.vendor_key, v.vendor_name, v.vendor_short_name, CAST(count(*) AS BIGINT) AS trip_count,
               CAST(sum(f.total_amount) AS DOUBLE) AS total_amount
        FROM fact_trips f JOIN dim_vendor v USING (vendor_key) GROUP BY ALL ORDER BY 1""",
    "kpi_by_payment_type": """
        SELECT p.payment_type_name, p.payment_category, p.is_electronic_payment,
               CAST(sum(f.trip_count) AS BIGINT) AS trip_count,
               CAST(sum(f.total_amount) AS DOUBLE) AS total_amount,
               CAST(sum(f.tip_amount) AS DOUBLE) AS raw_tip_amount
        FROM fact_trips f JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key
        GROUP BY ALL ORDER BY trip_count DESC""",
    "kpi_by_rate_code": """
        SELECT r.rate_code_name, r.rate_category, r.airport_code,
               CAST(sum(f.trip_count) AS BIGINT) AS trip_count,
               CAST(sum(f.total_amount) AS DOUBLE) AS total_amount
        FROM fact_trips f JOIN dim_rate_code r ON f.rate_code_key = r.rate_code_key
        GROUP BY ALL ORDER BY trip_count DESC""",
    "kpi_by_airport": """
        SELECT coalesce(airport_trip_code, 'Non-airport') AS airport_trip_segment,
               CAST(sum(trip_count) AS BIGINT) AS trip_count,
               CAST(sum(total_amount) AS DOUBLE) AS total_amount,
               round(avg(CAST(total_amount AS DOUBLE)), 6) AS average_total_amount,
               round(avg(CAST(trip_distance_miles AS DOUBLE)), 6) AS average_distance,
               round(avg(CAST(trip_duration_minutes AS DOUBLE)), 6) AS average_duration
        FROM fact_trips GROUP BY 1 ORDER BY trip_count DESC""",
    "kpi_by_route": """
        SELECT route_key, pickup_zone_key, dropoff_zone_key,
               CAST(sum(trip_count) AS BIGINT) AS trip_count,
               CAST(sum(total_amount) AS DOUBLE) AS total_amount,
               CAST(count_if(is_route_metric_eligible) AS BIGINT) AS route_eligible_trips
        FROM fact_trips GROUP BY ALL ORDER BY trip_count DESC, route_key""",
    "kpi_baseline": """
        , f AS (SELECT fact_trips.*, p.payment_type_code FROM fact_trips
                JOIN dim_payment_type p ON fact_trips.payment_type_key = p.payment_type_key),
        a AS (SELECT
            sum(trip_count) AS trips, sum(total_amount) AS amount,
            sum(fare_amount) AS fare, sum(extra_amount) AS extra, sum(mta_tax_amount) AS mta,
            sum(tolls_amount) AS tolls, sum(improvement_surcharge_amount) AS impr,
            sum(congestion_surcharge_amount) AS cong, sum(cbd_congestion_fee_amount) AS cbd,
            sum(airport_fee_amount) AS airport,
            sum(tip_amount) FILTER (WHERE payment_type_code = 1) AS card_tip,
            sum(trip_count) FILTER (WHERE is_efficiency_kpi_eligible) AS el_trips,
            sum(trip_distance_miles) FILTER (WHERE is_efficiency_kpi_eligible) AS el_miles,
            sum(trip_duration_minutes) FILTER (WHERE is_efficiency_kpi_eligible) AS el_minutes,
            sum(total_amount) FILTER (WHERE is_efficiency_kpi_eligible) AS el_amount,
            sum(CAST(passenger_count AS DOUBLE)) FILTER (WHERE passenger_count IS NOT NULL) AS pax,
            count_if(passenger_count IS NOT NULL) AS pax_trips,
            sum(trip_count) FILTER (WHERE payment_type_code = 1) AS card_trips,
            sum(trip_count) FILTER (WHERE is_airport_trip) AS airport_trips
          FROM f)
        SELECT CAST(trips AS BIGINT) AS trip_count, CAST(amount AS DOUBLE) AS total_recorded_amount,
          round(CAST(amount AS DOUBLE) / NULLIF(CAST(trips AS DOUBLE), 0), 6) AS average_recorded_amount_per_trip,
          CAST(fare AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra_amount,
          CAST(mta AS DOUBLE) AS mta_tax_amount, CAST(tolls AS DOUBLE) AS tolls_amount,
          CAST(impr AS DOUBLE) AS improvement_surcharge_amount,
          CAST(cong AS DOUBLE) AS congestion_surcharge_amount,
          CAST(cbd AS DOUBLE) AS cbd_congestion_fee_amount, CAST(airport AS DOUBLE) AS airport_fee_amount,
          CAST(card_tip AS DOUBLE) AS reported_card_tip_amount,
          CAST(el_trips AS BIGINT) AS efficiency_eligible_trip_count,
          round(CAST(el_miles AS DOUBLE) / NULLIF(CAST(el_trips AS DOUBLE), 0), 6) AS average_eligible_distance_miles,
          round(CAST(el_minutes AS DOUBLE) / NULLIF(CAST(el_trips AS DOUBLE), 0), 6) AS average_eligible_duration_minutes,
          round(CAST(el_miles AS DOUBLE) / NULLIF(CAST(el_minutes AS DOUBLE) / 60.0, 0), 6) AS estimated_average_speed_mph,
          round(CAST(el_amount AS DOUBLE) / NULLIF(CAST(el_miles AS DOUBLE), 0), 6) AS recorded_amount_per_mile,
          CAST(pax AS BIGINT) AS reported_passenger_count,
          CAST(pax_trips AS BIGINT) AS trips_with_reported_passenger_count,
          round(pax / NULLIF(CAST(pax_trips AS DOUBLE), 0), 6) AS average_reported_passengers,
          round(CAST(card_trips AS DOUBLE) / NULLIF(CAST(trips AS DOUBLE), 0), 6) AS credit_card_trip_share,
          round(CAST(airport_trips AS DOUBLE) / NULLIF(CAST(trips AS DOUBLE), 0), 6) AS airport_trip_share
        FROM a""",
}


def oracle_sql() -> dict[str, str]:
    from tripmart.oracle.validation import FINAL as VALIDATION

    out = {}
    for key, final in {**FINAL, **VALIDATION}.items():
        final = final.strip()
        if final.startswith(","):
            out[key] = CHAIN + final
        else:
            out[key] = CHAIN + "\n" + final
    return out
