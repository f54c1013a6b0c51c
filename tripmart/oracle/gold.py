"""DuckDB SQL for the Gold star schema over the oracle's Silver layer."""

GOLD_FLAGS = [
    "is_quarantined", "is_flex_fare", "is_zero_distance", "is_passenger_count_missing",
    "is_zero_passenger_count", "is_financially_unreconciled", "is_negative_total_amount",
    "has_negative_financial_component", "is_cross_year_trip",
    "is_trip_volume_metric_eligible", "is_passenger_metric_eligible", "is_distance_metric_eligible",
    "is_duration_metric_eligible", "is_efficiency_metric_eligible", "is_efficiency_kpi_eligible",
    "is_recorded_amount_metric_eligible", "is_financial_breakdown_metric_eligible",
    "is_reported_tip_metric_eligible", "is_rate_code_metric_eligible", "is_vendor_metric_eligible",
    "is_payment_type_metric_eligible", "is_route_metric_eligible", "is_reversal_or_adjustment",
    "is_standard_operational_trip_eligible", "is_ml_distance_feature_eligible",
    "is_ml_passenger_feature_eligible", "is_ml_financial_feature_eligible",
    "is_ml_categorical_feature_eligible", "is_ml_standard_trip_eligible",
    "requires_data_review", "requires_gold_date_extension",
]
_FLAG_SELECT = ",\n    ".join(f"_{f} AS {f}" for f in GOLD_FLAGS)

GOLD = f"""
gold_trip_source AS (
  SELECT
    vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
    trip_distance AS trip_distance_miles,
    CAST(trip_duration_minutes AS DECIMAL(12,2)) AS trip_duration_minutes,
    rate_code_id, store_and_fwd_flag, pickup_location_id, dropoff_location_id,
    payment_type AS payment_type_id,
    fare_amount, extra_amount, mta_tax_amount, tip_amount, tolls_amount,
    improvement_surcharge_amount, total_amount, congestion_surcharge_amount,
    airport_fee_amount, cbd_congestion_fee_amount,
    record_hash AS source_record_hash, source_year, source_month,
    _financial_component_amount AS financial_component_amount,
    _financial_reconciliation_difference AS financial_reconciliation_difference,
    _dq_reasons AS critical_quality_reasons,
    _dq_warning_reasons AS dq_warning_reasons,
    _dq_warning_count AS dq_warning_count,
    _has_dq_warnings AS has_dq_warnings,
    _passenger_data_status AS passenger_data_status,
    _distance_data_status AS distance_data_status,
    _financial_record_type AS financial_record_type,
    _eligibility_reasons AS eligibility_reasons,
    _eligibility_restriction_count AS eligibility_restriction_count,
    _eligibility_status AS eligibility_status,
    _quality_rule_version AS quality_rule_version,
    {_FLAG_SELECT}
  FROM silver_trips
),
gold_zone_source AS (
  SELECT location_id, borough, zone AS zone_name, service_zone FROM silver_zones
),
date_bounds AS (
  SELECT year(lo) AS minimum_source_year, year(hi) AS maximum_source_year,
         make_date(CAST(year(lo) - 1 AS BIGINT), 1, 1) AS calendar_start_date,
         make_date(CAST(year(hi) + 1 AS BIGINT), 12, 31) AS calendar_end_date
  FROM (
    SELECT least(min(CAST(pickup_datetime AS DATE)), min(CAST(dropoff_datetime AS DATE))) AS lo,
           greatest(max(CAST(pickup_datetime AS DATE)), max(CAST(dropoff_datetime AS DATE))) AS hi
    FROM gold_trip_source) b
),
calendar_days AS (
  SELECT CAST(gs.d AS DATE) AS full_date, b.minimum_source_year, b.maximum_source_year,
         CAST(isodow(CAST(gs.d AS DATE)) AS INTEGER) AS dow,
         month(CAST(gs.d AS DATE)) AS m, day(CAST(gs.d AS DATE)) AS dd
  FROM date_bounds b,
       LATERAL (SELECT unnest(generate_series(CAST(b.calendar_start_date AS TIMESTAMP),
                                              CAST(b.calendar_end_date AS TIMESTAMP),
                                              INTERVAL 1 DAY)) AS d) gs
  WHERE b.calendar_start_date IS NOT NULL
),
calendar_named AS (
  SELECT *,
    CASE WHEN m = 1 AND dd = 1 THEN 'New Year''s Day'
         WHEN m = 1 AND dow = 1 AND dd BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
         WHEN m = 2 AND dow = 1 AND dd BETWEEN 15 AND 21 THEN 'Washington''s Birthday'
         WHEN m = 5 AND dow = 1 AND dd BETWEEN 25 AND 31 THEN 'Memorial Day'
         WHEN m = 6 AND dd = 19 THEN 'Juneteenth National Independence Day'
         WHEN m = 7 AND dd = 4 THEN 'Independence Day'
         WHEN m = 9 AND dow = 1 AND dd BETWEEN 1 AND 7 THEN 'Labor Day'
         WHEN m = 10 AND dow = 1 AND dd BETWEEN 8 AND 14 THEN 'Columbus Day'
         WHEN m = 11 AND dd = 11 THEN 'Veterans Day'
         WHEN m = 11 AND dow = 4 AND dd BETWEEN 22 AND 28 THEN 'Thanksgiving Day'
         WHEN m = 12 AND dd = 25 THEN 'Christmas Day' END AS holiday_name
  FROM calendar_days
),
dim_date AS (
  SELECT
    CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
    full_date,
    CAST(year(full_date) AS INTEGER) AS year_number,
    CASE WHEN m <= 6 THEN 1 ELSE 2 END AS semester_number,
    CAST(quarter(full_date) AS INTEGER) AS quarter_number,
    'Q' || CAST(quarter(full_date) AS VARCHAR) AS quarter_name,
    CAST(strftime(full_date, '%Y%m') AS INTEGER) AS year_month_key,
    strftime(full_date, '%Y-%m') AS year_month,
    CAST(m AS INTEGER) AS month_number,
    strftime(full_date, '%B') AS month_name,
    CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
    CAST(dd AS INTEGER) AS day_of_month,
    dow AS day_of_week_number,
    strftime(full_date, '%A') AS day_name,
    dow IN (6, 7) AS is_weekend,
    holiday_name,
    holiday_name IS NOT NULL AS is_federal_holiday,
    CASE WHEN holiday_name IS NOT NULL THEN 'US Federal' END AS holiday_scope,
    dow NOT IN (6, 7) AND holiday_name IS NULL AS is_business_day,
    CASE WHEN year(full_date) < minimum_source_year THEN 'PREDECESSOR_YEAR'
         WHEN year(full_date) > maximum_source_year THEN 'SUCCESSOR_YEAR'
         ELSE 'SOURCE_YEAR_RANGE' END AS calendar_year_role,
    year(full_date) BETWEEN minimum_source_year AND maximum_source_year AS is_source_year
  FROM calendar_named
  UNION ALL
  SELECT 0, NULL, NULL, NULL, NULL, 'Unknown', NULL, 'Unknown', NULL, 'Unknown', NULL, NULL, NULL,
         'Unknown', false, 'Unknown', false, NULL, false, 'UNKNOWN', false
),
dim_time AS (
  SELECT CAST(h AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour_number,
    printf('%02d:00-%02d:59', h, h) AS hour_range,
    CASE WHEN h BETWEEN 0 AND 5 THEN 'Overnight' WHEN h BETWEEN 6 AND 11 THEN 'Morning'
         WHEN h BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Evening' END AS day_period,
    CASE WHEN h BETWEEN 0 AND 5 THEN 'Overnight' WHEN h BETWEEN 6 AND 9 THEN 'Morning peak'
         WHEN h BETWEEN 10 AND 15 THEN 'Midday' WHEN h BETWEEN 16 AND 19 THEN 'Evening peak'
         ELSE 'Late evening' END AS business_time_band,
    h BETWEEN 6 AND 9 OR h BETWEEN 16 AND 19 AS is_peak_hour
  FROM range(0, 24) r(h)
  UNION ALL
  SELECT -1, NULL, 'Unknown', 'Unknown', 'Unknown', false
),
zone_dim_base AS (
  SELECT location_id, borough, zone_name, service_zone,
    borough || ' - ' || zone_name AS display_name,
    location_id IN (1, 132, 138) AS is_airport_zone,
    CASE location_id WHEN 132 THEN 'JFK' WHEN 138 THEN 'LGA' WHEN 1 THEN 'EWR' END AS airport_code
  FROM gold_zone_source
  UNION ALL
  SELECT 0, 'Unknown', 'Unknown', 'Unknown', 'Unknown - Unknown', false, NULL
),
dim_pickup_zone AS (
  SELECT location_id AS pickup_zone_key, location_id AS pickup_location_id, borough AS pickup_borough,
         zone_name AS pickup_zone_name, service_zone AS pickup_service_zone,
         display_name AS pickup_zone_display_name, is_airport_zone, airport_code
  FROM zone_dim_base
),
dim_dropoff_zone AS (
  SELECT location_id AS dropoff_zone_key, location_id AS dropoff_location_id, borough AS dropoff_borough,
         zone_name AS dropoff_zone_name, service_zone AS dropoff_service_zone,
         display_name AS dropoff_zone_display_name, is_airport_zone, airport_code
  FROM zone_dim_base
),
dim_payment_type AS (
  SELECT * FROM (VALUES
    (-1, NULL, 'Missing or unmapped', 'Unknown', false, 'Tip coverage unknown'),
    (0, 0, 'Flex Fare trip', 'Flex Fare', true, 'Depends on payment channel'),
    (1, 1, 'Credit card', 'Electronic', true, 'Electronic tips reported'),
    (2, 2, 'Cash', 'Cash', false, 'Cash tips are not captured'),
    (3, 3, 'No charge', 'Non-revenue', false, 'No passenger charge'),
    (4, 4, 'Dispute', 'Disputed', false, 'Tip not expected'),
    (5, 5, 'Unknown', 'Unknown', false, 'Tip coverage unknown'),
    (6, 6, 'Voided trip', 'Voided', false, 'Tip not expected'))
  AS t(payment_type_key, payment_type_code, payment_type_name, payment_category,
       is_electronic_payment, tip_data_note)
),
dim_rate_code AS (
  SELECT * FROM (VALUES
    (-1, NULL, 'Missing or unmapped', 'Unknown', NULL),
    (1, 1, 'Standard rate', 'Metered', NULL),
    (2, 2, 'JFK', 'Airport', 'JFK'),
    (3, 3, 'Newark', 'Airport', 'EWR'),
    (4, 4, 'Nassau or Westchester', 'Out-of-area', NULL),
    (5, 5, 'Negotiated fare', 'Negotiated', NULL),
    (6, 6, 'Group ride', 'Group', NULL),
    (99, 99, 'Null or unknown', 'Unknown', NULL))
  AS t(rate_code_key, rate_code_id, rate_code_name, rate_category, airport_code)
),
dim_vendor AS (
  SELECT * FROM (VALUES
    (-1, NULL, 'Missing or unmapped', 'Unknown'),
    (1, 1, 'Creative Mobile Technologies, LLC', 'CMT'),
    (2, 2, 'Curb Mobility, LLC', 'Curb'),
    (6, 6, 'Myle Technologies Inc', 'Myle'),
    (7, 7, 'Helix', 'Helix'))
  AS t(vendor_key, vendor_id, vendor_name, vendor_short_name)
),
fact_trips AS (
  SELECT
    t.source_record_hash AS trip_key,
    t.source_record_hash,
    CAST(coalesce(pd.date_key, 0) AS INTEGER) AS pickup_date_key,
    CAST(coalesce(dd.date_key, 0) AS INTEGER) AS dropoff_date_key,
    CAST(coalesce(pt.time_key, -1) AS INTEGER) AS pickup_time_key,
    CAST(coalesce(dt.time_key, -1) AS INTEGER) AS dropoff_time_key,
    CAST(coalesce(pz.pickup_zone_key, 0) AS INTEGER) AS pickup_zone_key,
    CAST(coalesce(dz.dropoff_zone_key, 0) AS INTEGER) AS dropoff_zone_key,
    CAST(coalesce(pay.payment_type_key, -1) AS INTEGER) AS payment_type_key,
    CAST(coalesce(rc.rate_code_key, -1) AS INTEGER) AS rate_code_key,
    CAST(coalesce(v.vendor_key, -1) AS INTEGER) AS vendor_key,
    CAST(coalesce(pz.pickup_zone_key, 0) AS VARCHAR) || ':' || CAST(coalesce(dz.dropoff_zone_key, 0) AS VARCHAR) AS route_key,
    t.pickup_datetime, t.dropoff_datetime, t.passenger_count, t.trip_distance_miles, t.trip_duration_minutes,
    t.fare_amount, t.extra_amount, t.mta_tax_amount, t.tip_amount, t.tolls_amount,
    t.improvement_surcharge_amount, t.total_amount, t.congestion_surcharge_amount,
    t.airport_fee_amount, t.cbd_congestion_fee_amount,
    t.financial_component_amount, t.financial_reconciliation_difference,
    CAST(1 AS BIGINT) AS trip_count,
    t.source_year, t.source_month,
    coalesce(upper(trim(t.store_and_fwd_flag)) = 'Y', false) AS is_store_and_forward,
    coalesce(pz.airport_code, dz.airport_code, rc.airport_code) IS NOT NULL AS is_airport_trip,
    coalesce(pz.airport_code, dz.airport_code, rc.airport_code) AS airport_trip_code,
    coalesce(CASE WHEN t.payment_type_id = 1 AND t.is_reported_tip_metric_eligible THEN t.tip_amount END,
             CAST(0 AS DECIMAL(18,2))) AS reported_card_tip_amount,
    coalesce(t.payment_type_id = 1 AND t.is_reported_tip_metric_eligible AND t.tip_amount > 0, false)
      AS has_reported_electronic_tip,
    t.passenger_data_status, t.distance_data_status, t.financial_record_type, t.dq_warning_reasons,
    t.dq_warning_count, t.has_dq_warnings, t.eligibility_reasons, t.eligibility_restriction_count,
    t.eligibility_status, t.quality_rule_version,
    t.is_flex_fare, t.is_zero_distance, t.is_passenger_count_missing, t.is_zero_passenger_count,
    t.is_financially_unreconciled, t.is_negative_total_amount, t.has_negative_financial_component,
    t.is_cross_year_trip, t.is_reversal_or_adjustment, t.requires_data_review, t.requires_gold_date_extension,
    t.is_trip_volume_metric_eligible, t.is_passenger_metric_eligible, t.is_distance_metric_eligible,
    t.is_duration_metric_eligible, t.is_efficiency_metric_eligible, t.is_efficiency_kpi_eligible,
    t.is_recorded_amount_metric_eligible, t.is_financial_breakdown_metric_eligible,
    t.is_reported_tip_metric_eligible, t.is_rate_code_metric_eligible, t.is_vendor_metric_eligible,
    t.is_payment_type_metric_eligible, t.is_route_metric_eligible,
    t.is_standard_operational_trip_eligible, t.is_ml_distance_feature_eligible,
    t.is_ml_passenger_feature_eligible, t.is_ml_financial_feature_eligible,
    t.is_ml_categorical_feature_eligible, t.is_ml_standard_trip_eligible
  FROM gold_trip_source t
  LEFT JOIN dim_date pd ON CAST(t.pickup_datetime AS DATE) = pd.full_date
  LEFT JOIN dim_date dd ON CAST(t.dropoff_datetime AS DATE) = dd.full_date
  LEFT JOIN dim_time pt ON hour(t.pickup_datetime) = pt.time_key
  LEFT JOIN dim_time dt ON hour(t.dropoff_datetime) = dt.time_key
  LEFT JOIN dim_pickup_zone pz ON t.pickup_location_id = pz.pickup_location_id
  LEFT JOIN dim_dropoff_zone dz ON t.dropoff_location_id = dz.dropoff_location_id
  LEFT JOIN dim_payment_type pay ON t.payment_type_id = pay.payment_type_code
  LEFT JOIN dim_rate_code rc ON t.rate_code_id = rc.rate_code_id
  LEFT JOIN dim_vendor v ON t.vendor_id = v.vendor_id
)"""
