"""DuckDB SQL for the fixture binding, Bronze and Silver layers.

Written directly in SQL (window functions, CASE, list functions) as an
independent statement of the same contract the Spark operators implement;
tables ``lineitem orders customer supplier nation region`` are views over
the driver's parquet files.
"""

EXPECTED_YEAR = 1998
MAX_MINUTES = 360

RAW_TRIPS = f"""
fx_base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         o.o_orderdate, c.c_nationkey, s.s_nationkey,
         (7 * l.l_orderkey + 13 * l.l_partkey + 3 * l.l_suppkey + 31 * l.l_linenumber) % 1000 AS h
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
fx_1 AS (
  SELECT *,
    CASE WHEN h BETWEEN 20 AND 24 THEN NULL
         WHEN h BETWEEN 45 AND 49 THEN make_timestamp(year(o_orderdate), 12, 31, 23, 50, 0.0)
         ELSE o_orderdate + to_hours(CAST(l_partkey % 24 AS BIGINT))
                          + to_minutes(CAST(trunc(l_quantity) AS BIGINT)) END AS pickup,
    CASE WHEN h BETWEEN 135 AND 139 THEN NULL WHEN h BETWEEN 140 AND 144 THEN 9
         ELSE l_partkey % 7 END AS payment,
    CASE WHEN h BETWEEN 115 AND 119 THEN NULL WHEN h BETWEEN 120 AND 124 THEN 900
         WHEN c_nationkey = 0 THEN 1 ELSE 120 + c_nationkey END AS pu,
    CASE WHEN h BETWEEN 155 AND 164 THEN -1 ELSE 1 END AS sgn,
    300 + CAST(round(l_extendedprice * 100) AS BIGINT) % 9000 AS fare_c
  FROM fx_base
),
fx_2 AS (
  SELECT *,
    CASE WHEN h BETWEEN 25 AND 29 THEN NULL
         ELSE pickup + to_minutes(CAST(CASE WHEN h BETWEEN 30 AND 34 THEN -5
                                            WHEN h BETWEEN 35 AND 39 THEN 400
                                            WHEN h BETWEEN 40 AND 44 THEN 0
                                            WHEN h BETWEEN 45 AND 49 THEN 30
                                            ELSE 2 + l_partkey % 80 END AS BIGINT)) END AS dropoff,
    sgn * fare_c AS c_fare,
    sgn * 100 AS c_extra,
    sgn * CASE WHEN h BETWEEN 168 AND 170 THEN -50 ELSE 50 END AS c_mta,
    sgn * CASE WHEN h BETWEEN 145 AND 149 THEN 200 WHEN payment = 1 THEN fare_c // 5 ELSE 0 END AS c_tip,
    sgn * CASE WHEN pu IN (132, 138) THEN 694 ELSE 0 END AS c_tolls,
    sgn * 100 AS c_impr,
    sgn * 250 AS c_cong,
    sgn * CASE WHEN pu IN (132, 138) THEN 175 ELSE 0 END AS c_airport,
    sgn * CASE WHEN l_linenumber = 1 THEN NULL ELSE 75 END AS c_cbd
  FROM fx_1
),
fx_3 AS (
  SELECT *,
    c_fare + c_extra + c_mta + c_tip + c_tolls + c_impr + c_cong + c_airport + coalesce(c_cbd, 0) AS c_sum,
    coalesce(pickup, o_orderdate) AS part_ts
  FROM fx_2
),
fx_trips AS (
  SELECT
    CAST(CASE WHEN h BETWEEN 0 AND 9 THEN NULL WHEN h BETWEEN 10 AND 19 THEN 4
         ELSE CASE l_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 7 END END AS BIGINT) AS VendorID,
    pickup AS tpep_pickup_datetime,
    dropoff AS tpep_dropoff_datetime,
    CAST(CASE WHEN h BETWEEN 50 AND 59 THEN 0 WHEN h BETWEEN 60 AND 64 THEN -1
         WHEN h BETWEEN 65 AND 79 THEN NULL ELSE 1 + l_linenumber % 6 END AS BIGINT) AS passenger_count,
    CASE WHEN h BETWEEN 80 AND 94 THEN CAST(0 AS DOUBLE) WHEN h BETWEEN 95 AND 97 THEN CAST(-1.5 AS DOUBLE)
         WHEN h BETWEEN 98 AND 99 THEN NULL ELSE l_quantity / CAST(4 AS DOUBLE) END AS trip_distance,
    CAST(CASE WHEN h BETWEEN 100 AND 109 THEN NULL WHEN h BETWEEN 110 AND 114 THEN 8
         ELSE CASE l_partkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4
                                 WHEN 4 THEN 5 WHEN 5 THEN 6 ELSE 99 END END AS BIGINT) AS RatecodeID,
    CASE WHEN h % 50 = 0 THEN ' y ' WHEN h % 50 = 1 THEN NULL ELSE 'N' END AS store_and_fwd_flag,
    CAST(pu AS BIGINT) AS PULocationID,
    CAST(CASE WHEN h BETWEEN 125 AND 129 THEN NULL WHEN h BETWEEN 130 AND 134 THEN 900
         WHEN s_nationkey = 0 THEN 1 ELSE 120 + s_nationkey END AS BIGINT) AS DOLocationID,
    CAST(payment AS BIGINT) AS payment_type,
    CAST(c_fare AS DOUBLE) / 100 AS fare_amount,
    CAST(c_extra AS DOUBLE) / 100 AS extra,
    CAST(c_mta AS DOUBLE) / 100 AS mta_tax,
    CAST(c_tip AS DOUBLE) / 100 AS tip_amount,
    CAST(c_tolls AS DOUBLE) / 100 AS tolls_amount,
    CAST(c_impr AS DOUBLE) / 100 AS improvement_surcharge,
    CAST(CASE WHEN h BETWEEN 165 AND 167 THEN NULL WHEN h BETWEEN 150 AND 154 THEN c_sum + 300
              ELSE c_sum END AS DOUBLE) / 100 AS total_amount,
    CAST(c_cong AS DOUBLE) / 100 AS congestion_surcharge,
    CAST(c_airport AS DOUBLE) / 100 AS Airport_fee,
    CAST(c_cbd AS DOUBLE) / 100 AS cbd_congestion_fee,
    CAST(year(part_ts) AS VARCHAR) AS year,
    CAST(CASE WHEN h BETWEEN 171 AND 173 THEN month(part_ts) % 12 + 1 ELSE month(part_ts) END AS VARCHAR) AS month,
    l_orderkey * 16 + l_linenumber * 2 AS line_id,
    h
  FROM fx_3
),
raw_trips AS (
  SELECT * EXCLUDE (line_id, h), line_id AS source_row_id FROM fx_trips
  UNION ALL
  SELECT * EXCLUDE (line_id, h), line_id + 1 AS source_row_id FROM fx_trips WHERE h BETWEEN 174 AND 183
),
bronze_trips AS (
  SELECT *, 'aws_glue' AS _source_system, 'tpch.lineitem_trips' AS _source_table
  FROM raw_trips WHERE year = '{EXPECTED_YEAR}'
)"""

RAW_ZONES = """
raw_zones AS (
  SELECT CAST(CASE WHEN n.n_nationkey = 0 THEN 1 ELSE 120 + n.n_nationkey END AS INTEGER) AS LocationID,
         r.r_name AS Borough, n.n_name AS Zone, 'Z' || CAST(n.n_nationkey % 3 AS VARCHAR) AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT * FROM (VALUES
    (300, 'EUROPE', 'DUPLICATE_A', 'Z0'),
    (300, 'EUROPE', 'DUPLICATE_B', 'Z1'),
    (NULL, 'ASIA', 'NO_ID_A', 'Z2'),
    (NULL, 'ASIA', 'NO_ID_B', 'Z0'),
    (0, 'AFRICA', 'ZERO_ID', 'Z1'),
    (301, '  ', 'BLANK_BOROUGH', 'Z2'),
    (302, 'AMERICA', 'NO_SERVICE_ZONE', NULL)) AS d(LocationID, Borough, Zone, service_zone)
),
bronze_zones AS (
  SELECT CAST(LocationID AS INTEGER) AS LocationID, Borough, Zone, service_zone,
         'unity_catalog_volume' AS _source_system, 'csv' AS _source_format,
         'tpch/nation_zone_lookup' AS _source_path
  FROM raw_zones
),
zones_norm AS (
  SELECT CAST(LocationID AS INTEGER) AS location_id, trim(Borough) AS borough, trim(Zone) AS zone,
         trim(service_zone) AS service_zone, _source_system, _source_format, _source_path
  FROM bronze_zones
),
zones_counted AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY location_id) AS BIGINT) AS _duplicate_location_id_count
  FROM zones_norm
),
zones_classified AS (
  SELECT *, len(_dq_reasons) > 0 AS _is_quarantined FROM (
    SELECT *, list_filter([
      CASE WHEN location_id IS NULL THEN 'LOCATION_ID_MISSING' END,
      CASE WHEN location_id IS NOT NULL AND location_id <= 0 THEN 'LOCATION_ID_NOT_POSITIVE' END,
      CASE WHEN _duplicate_location_id_count > 1 THEN 'DUPLICATE_LOCATION_ID' END,
      CASE WHEN borough IS NULL OR length(trim(borough)) = 0 THEN 'BOROUGH_MISSING' END,
      CASE WHEN zone IS NULL OR length(trim(zone)) = 0 THEN 'ZONE_MISSING' END,
      CASE WHEN service_zone IS NULL OR length(trim(service_zone)) = 0 THEN 'SERVICE_ZONE_MISSING' END
    ], lambda x: x IS NOT NULL) AS _dq_reasons
    FROM zones_counted) z
),
silver_zones AS (SELECT * FROM zones_classified WHERE NOT _is_quarantined),
quarantine_zones AS (SELECT * FROM zones_classified WHERE _is_quarantined)"""

HASH_COLS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "rate_code_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
    "payment_type", "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount",
    "tolls_amount", "improvement_surcharge_amount", "total_amount",
    "congestion_surcharge_amount", "airport_fee_amount", "cbd_congestion_fee_amount",
    "source_year", "source_month",
]
_HASH_EXPR = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in HASH_COLS)
COMPONENTS = [
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount",
]
_COMPONENT_SUM = " + ".join(f"coalesce({c}, 0)" for c in COMPONENTS)
_ANY_NEG = " OR ".join(f"{c} < 0" for c in COMPONENTS)

SILVER_TRIPS = f"""
trips_norm AS (
  SELECT
    CAST(VendorID AS INTEGER) AS vendor_id,
    CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance,
    CAST(RatecodeID AS INTEGER) AS rate_code_id,
    upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag,
    CAST(PULocationID AS INTEGER) AS pickup_location_id,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    CAST(payment_type AS INTEGER) AS payment_type,
    CAST(fare_amount AS DECIMAL(18,2)) AS fare_amount,
    CAST(extra AS DECIMAL(18,2)) AS extra_amount,
    CAST(mta_tax AS DECIMAL(18,2)) AS mta_tax_amount,
    CAST(tip_amount AS DECIMAL(18,2)) AS tip_amount,
    CAST(tolls_amount AS DECIMAL(18,2)) AS tolls_amount,
    CAST(improvement_surcharge AS DECIMAL(18,2)) AS improvement_surcharge_amount,
    CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
    CAST(congestion_surcharge AS DECIMAL(18,2)) AS congestion_surcharge_amount,
    CAST(Airport_fee AS DECIMAL(18,2)) AS airport_fee_amount,
    CAST(cbd_congestion_fee AS DECIMAL(18,2)) AS cbd_congestion_fee_amount,
    CAST(year AS INTEGER) AS source_year,
    CAST(month AS INTEGER) AS source_month,
    source_row_id
  FROM bronze_trips
),
trips_hashed AS (
  SELECT *, upper(trim(store_and_fwd_flag)) AS store_and_forward_flag,
         sha256(concat_ws('||', {_HASH_EXPR})) AS _record_hash
  FROM trips_norm
),
trips_dedup AS (
  SELECT *,
    CAST(count(*) OVER (PARTITION BY _record_hash) AS BIGINT) AS _duplicate_record_count,
    CAST(row_number() OVER (PARTITION BY _record_hash ORDER BY source_row_id) AS INTEGER) AS _duplicate_occurrence_number
  FROM trips_hashed
),
trips_enriched AS (
  SELECT t.*,
    pz.location_id AS pickup_zone_location_id, pz.borough AS pickup_borough,
    pz.zone AS pickup_zone, pz.service_zone AS pickup_service_zone,
    dz.location_id AS dropoff_zone_location_id, dz.borough AS dropoff_borough,
    dz.zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(dropoff_datetime AS DATE) AS dropoff_date,
    CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(year(dropoff_datetime) AS INTEGER) AS dropoff_year,
    CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(day(pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    round((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0, 2) AS trip_duration_minutes,
    _record_hash AS record_hash,
    _duplicate_record_count > 1 AS _is_duplicate_group,
    _duplicate_occurrence_number > 1 AS _is_duplicate_record
  FROM trips_dedup t
  LEFT JOIN silver_zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN silver_zones dz ON t.dropoff_location_id = dz.location_id
),
trips_critical AS (
  SELECT *, len(_dq_reasons) > 0 AS _is_quarantined FROM (
    SELECT *, list_filter([
      CASE WHEN pickup_datetime IS NULL THEN 'PICKUP_TIMESTAMP_MISSING' END,
      CASE WHEN dropoff_datetime IS NULL THEN 'DROPOFF_TIMESTAMP_MISSING' END,
      CASE WHEN pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
                AND dropoff_datetime <= pickup_datetime THEN 'INVALID_TRIP_PERIOD' END,
      CASE WHEN pickup_datetime IS NOT NULL AND year(pickup_datetime) <> {EXPECTED_YEAR}
           THEN 'PICKUP_OUTSIDE_EXPECTED_YEAR' END,
      CASE WHEN pickup_datetime IS NOT NULL AND (source_year IS NULL OR source_month IS NULL
                OR source_year <> {EXPECTED_YEAR} OR source_month <> month(pickup_datetime))
           THEN 'SOURCE_PARTITION_MISMATCH' END,
      CASE WHEN trip_duration_minutes IS NOT NULL AND trip_duration_minutes > {MAX_MINUTES}
           THEN 'TRIP_DURATION_EXCEEDS_LIMIT' END,
      CASE WHEN trip_distance IS NULL THEN 'TRIP_DISTANCE_MISSING' END,
      CASE WHEN trip_distance < 0 THEN 'NEGATIVE_TRIP_DISTANCE' END,
      CASE WHEN passenger_count < 0 THEN 'NEGATIVE_PASSENGER_COUNT' END,
      CASE WHEN total_amount IS NULL THEN 'TOTAL_AMOUNT_MISSING' END,
      CASE WHEN pickup_location_id IS NULL THEN 'PICKUP_LOCATION_MISSING' END,
      CASE WHEN dropoff_location_id IS NULL THEN 'DROPOFF_LOCATION_MISSING' END,
      CASE WHEN pickup_location_id IS NOT NULL AND pickup_zone_location_id IS NULL
           THEN 'PICKUP_LOCATION_NOT_RESOLVED' END,
      CASE WHEN dropoff_location_id IS NOT NULL AND dropoff_zone_location_id IS NULL
           THEN 'DROPOFF_LOCATION_NOT_RESOLVED' END,
      CASE WHEN _is_duplicate_record THEN 'DUPLICATE_TRIP_RECORD' END
    ], lambda x: x IS NOT NULL) AS _dq_reasons
    FROM trips_enriched) e
),
trips_flag1 AS (
  SELECT *,
    coalesce(trip_distance = 0, false) AS _is_zero_distance,
    passenger_count IS NULL AS _is_passenger_count_missing,
    coalesce(passenger_count = 0, false) AS _is_zero_passenger_count,
    coalesce(passenger_count < 0, false) AS _is_negative_passenger_count,
    coalesce(passenger_count <= 0, false) AS _is_non_positive_passenger_count,
    coalesce(payment_type = 0, false) AS _is_flex_fare,
    coalesce(total_amount < 0, false) AS _is_negative_total_amount,
    coalesce(fare_amount < 0, false) AS _is_negative_fare_amount,
    coalesce(tip_amount < 0, false) AS _is_negative_tip_amount,
    coalesce({_ANY_NEG}, false) AS _has_negative_financial_component,
    CAST({_COMPONENT_SUM} AS DECIMAL(20,2)) AS _financial_component_amount,
    (rate_code_id IS NULL OR rate_code_id NOT IN (1, 2, 3, 4, 5, 6, 99)) AS _is_rate_code_missing_or_unmapped,
    (vendor_id IS NULL OR vendor_id NOT IN (1, 2, 6, 7)) AS _is_vendor_missing_or_unmapped,
    (payment_type IS NULL OR payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)) AS _is_payment_type_missing_or_unmapped,
    coalesce(pickup_year <> dropoff_year, false) AS _is_cross_year_trip,
    coalesce(tip_amount > 0 AND NOT coalesce(payment_type IN (0, 1), false), false)
      AS _is_tip_reported_outside_supported_payment,
    coalesce(trip_duration_minutes > {MAX_MINUTES}, false) AS _is_long_trip,
    coalesce(NOT _is_quarantined AND trip_distance > 0 AND trip_duration_minutes > 0
             AND trip_duration_minutes <= {MAX_MINUTES}, false) AS _is_efficiency_kpi_eligible
  FROM trips_critical
),
trips_flag2 AS (
  SELECT *,
    _is_flex_fare AND _is_passenger_count_missing AS _is_expected_flex_fare_passenger_gap,
    NOT _is_flex_fare AND _is_passenger_count_missing AS _is_unexpected_passenger_count_missing,
    CAST(CAST(total_amount AS DECIMAL(20,2)) - _financial_component_amount AS DECIMAL(20,2))
      AS _financial_reconciliation_difference,
    _is_flex_fare AND _is_rate_code_missing_or_unmapped AS _is_expected_flex_fare_rate_gap,
    NOT _is_flex_fare AND _is_rate_code_missing_or_unmapped AS _is_unexpected_rate_code_gap,
    _is_duplicate_group AND NOT _is_duplicate_record AS w_dup
  FROM trips_flag1
),
trips_flag3 AS (
  SELECT *,
    coalesce(abs(_financial_reconciliation_difference) > CAST('0.01' AS DECIMAL(20,4)), false)
      AS _is_financially_unreconciled
  FROM trips_flag2
),
trips_warned AS (
  SELECT *, CAST(len(_dq_warning_reasons) AS INTEGER) AS _dq_warning_count,
         len(_dq_warning_reasons) > 0 AS _has_dq_warnings FROM (
    SELECT *, list_sort(list_filter([
      CASE WHEN w_dup THEN 'DUPLICATE_GROUP_CANONICAL_RECORD' END,
      CASE WHEN _is_zero_distance THEN 'ZERO_TRIP_DISTANCE' END,
      CASE WHEN _is_expected_flex_fare_passenger_gap THEN 'FLEX_FARE_PASSENGER_COUNT_MISSING' END,
      CASE WHEN _is_unexpected_passenger_count_missing THEN 'PASSENGER_COUNT_MISSING' END,
      CASE WHEN _is_non_positive_passenger_count THEN 'NON_POSITIVE_PASSENGER_COUNT' END,
      CASE WHEN _is_negative_total_amount THEN 'NEGATIVE_TOTAL_AMOUNT' END,
      CASE WHEN _is_negative_fare_amount THEN 'NEGATIVE_FARE_AMOUNT' END,
      CASE WHEN _is_negative_tip_amount THEN 'NEGATIVE_TIP_AMOUNT' END,
      CASE WHEN _has_negative_financial_component THEN 'NEGATIVE_FINANCIAL_COMPONENT' END,
      CASE WHEN _is_financially_unreconciled THEN 'FINANCIAL_RECONCILIATION_GAP' END,
      CASE WHEN _is_expected_flex_fare_rate_gap THEN 'FLEX_FARE_RATE_CODE_MISSING' END,
      CASE WHEN _is_unexpected_rate_code_gap THEN 'RATE_CODE_MISSING_OR_UNMAPPED' END,
      CASE WHEN _is_vendor_missing_or_unmapped THEN 'VENDOR_MISSING_OR_UNMAPPED' END,
      CASE WHEN _is_payment_type_missing_or_unmapped THEN 'PAYMENT_TYPE_MISSING_OR_UNMAPPED' END,
      CASE WHEN _is_cross_year_trip THEN 'CROSS_YEAR_TRIP' END,
      CASE WHEN _is_tip_reported_outside_supported_payment THEN 'TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT' END
    ], lambda x: x IS NOT NULL)) AS _dq_warning_reasons
    FROM trips_flag3) f
),
trips_el1 AS (
  SELECT *,
    NOT _is_quarantined AS el_valid,
    NOT _is_quarantined AND NOT (_is_expected_flex_fare_passenger_gap OR _is_unexpected_passenger_count_missing
                                 OR _is_non_positive_passenger_count) AS el_passenger,
    NOT _is_quarantined AND NOT _is_zero_distance AND coalesce(trip_distance > 0, false) AS el_distance,
    NOT _is_quarantined AND coalesce(trip_duration_minutes > 0, false)
      AND NOT coalesce(_is_long_trip, true) AS el_duration,
    NOT _is_quarantined AND total_amount IS NOT NULL AS el_recorded,
    NOT _is_quarantined AND NOT (_is_expected_flex_fare_rate_gap OR _is_unexpected_rate_code_gap) AS el_rate,
    NOT _is_quarantined AND NOT _is_vendor_missing_or_unmapped AS el_vendor,
    NOT _is_quarantined AND NOT _is_payment_type_missing_or_unmapped AS el_payment,
    NOT _is_quarantined AND pickup_zone_location_id IS NOT NULL AND dropoff_zone_location_id IS NOT NULL AS el_route,
    (_is_negative_total_amount OR _is_negative_fare_amount OR _is_negative_tip_amount
     OR _has_negative_financial_component) AS el_negative
  FROM trips_warned
),
trips_el2 AS (
  SELECT *,
    el_recorded AND NOT _is_financially_unreconciled AS el_breakdown,
    el_recorded AND el_payment AND coalesce(payment_type IN (0, 1), false)
      AND NOT _is_tip_reported_outside_supported_payment AS el_tip,
    _is_negative_total_amount AND el_negative AND NOT _is_financially_unreconciled AS el_reversal,
    el_negative AND NOT _is_negative_total_amount AS el_unusual,
    el_rate AND el_vendor AND el_payment AS el_categorical,
    el_distance AND el_duration AS el_efficiency
  FROM trips_el1
),
trips_el3 AS (
  SELECT *,
    el_breakdown AND NOT el_negative AS el_fin_feature,
    el_efficiency AND NOT _is_negative_total_amount AND NOT w_dup AS el_standard
  FROM trips_el2
),
trips_el4 AS (
  SELECT *,
    CASE WHEN _is_expected_flex_fare_passenger_gap THEN 'EXPECTED_FLEX_FARE_MISSING'
         WHEN _is_unexpected_passenger_count_missing THEN 'MISSING_UNEXPECTED'
         WHEN _is_negative_passenger_count THEN 'NEGATIVE_INVALID'
         WHEN _is_zero_passenger_count THEN 'ZERO_REPORTED'
         ELSE 'REPORTED_VALID' END AS _passenger_data_status,
    CASE WHEN trip_distance < 0 THEN 'NEGATIVE_INVALID'
         WHEN _is_zero_distance AND _is_negative_total_amount THEN 'ZERO_DISTANCE_REVERSAL'
         WHEN _is_zero_distance AND coalesce(total_amount = 0, false) THEN 'ZERO_DISTANCE_NO_CHARGE'
         WHEN _is_zero_distance THEN 'ZERO_DISTANCE_WITH_CHARGE'
         ELSE 'POSITIVE_DISTANCE' END AS _distance_data_status,
    CASE WHEN _is_financially_unreconciled AND _is_negative_total_amount THEN 'NEGATIVE_UNRECONCILED'
         WHEN _is_financially_unreconciled THEN 'UNRECONCILED'
         WHEN el_reversal THEN 'RECONCILED_REVERSAL_OR_ADJUSTMENT'
         WHEN el_unusual THEN 'NEGATIVE_COMPONENT_REVIEW'
         ELSE 'REGULAR_TRANSACTION' END AS _financial_record_type,
    el_valid AS _is_trip_volume_metric_eligible,
    el_passenger AS _is_passenger_metric_eligible,
    el_distance AS _is_distance_metric_eligible,
    el_duration AS _is_duration_metric_eligible,
    el_efficiency AS _is_efficiency_metric_eligible,
    el_recorded AS _is_recorded_amount_metric_eligible,
    el_breakdown AS _is_financial_breakdown_metric_eligible,
    el_tip AS _is_reported_tip_metric_eligible,
    el_rate AS _is_rate_code_metric_eligible,
    el_vendor AS _is_vendor_metric_eligible,
    el_payment AS _is_payment_type_metric_eligible,
    el_route AS _is_route_metric_eligible,
    el_reversal AS _is_reversal_or_adjustment,
    el_distance AS _is_ml_distance_feature_eligible,
    el_passenger AS _is_ml_passenger_feature_eligible,
    el_fin_feature AS _is_ml_financial_feature_eligible,
    el_categorical AS _is_ml_categorical_feature_eligible,
    el_standard AS _is_standard_operational_trip_eligible,
    el_standard AND el_passenger AND el_fin_feature AND el_categorical AS _is_ml_standard_trip_eligible,
    _is_cross_year_trip AS _requires_gold_date_extension,
    _is_quarantined OR _is_financially_unreconciled OR _is_unexpected_passenger_count_missing
      OR _is_non_positive_passenger_count OR _is_unexpected_rate_code_gap OR _is_vendor_missing_or_unmapped
      OR _is_payment_type_missing_or_unmapped OR _is_tip_reported_outside_supported_payment OR w_dup
      OR el_unusual AS _requires_data_review
  FROM trips_el3
),
trips_el5 AS (
  SELECT *, list_sort(list_filter([
      CASE WHEN _is_quarantined THEN 'CRITICAL_QUALITY_VIOLATION' END,
      CASE WHEN NOT _is_passenger_metric_eligible THEN 'PASSENGER_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_distance_metric_eligible THEN 'DISTANCE_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_duration_metric_eligible THEN 'DURATION_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_financial_breakdown_metric_eligible THEN 'FINANCIAL_BREAKDOWN_INELIGIBLE' END,
      CASE WHEN NOT _is_reported_tip_metric_eligible THEN 'REPORTED_TIP_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_rate_code_metric_eligible THEN 'RATE_CODE_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_vendor_metric_eligible THEN 'VENDOR_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_payment_type_metric_eligible THEN 'PAYMENT_TYPE_METRICS_INELIGIBLE' END,
      CASE WHEN NOT _is_route_metric_eligible THEN 'ROUTE_METRICS_INELIGIBLE' END,
      CASE WHEN _is_reversal_or_adjustment THEN 'RECONCILED_REVERSAL_OR_ADJUSTMENT' END,
      CASE WHEN _financial_record_type = 'NEGATIVE_COMPONENT_REVIEW' THEN 'NEGATIVE_COMPONENT_REQUIRES_REVIEW' END,
      CASE WHEN w_dup THEN 'SOURCE_DUPLICATE_CANONICAL_RECORD' END,
      CASE WHEN _requires_gold_date_extension THEN 'GOLD_DATE_EXTENSION_REQUIRED' END
    ], lambda x: x IS NOT NULL)) AS _eligibility_reasons
  FROM trips_el4
),
trips_classified AS (
  SELECT * EXCLUDE (source_row_id, w_dup, el_valid, el_passenger, el_distance, el_duration, el_recorded,
                    el_rate, el_vendor, el_payment, el_route, el_negative, el_breakdown, el_tip,
                    el_reversal, el_unusual, el_categorical, el_efficiency, el_fin_feature, el_standard),
    CAST(len(_eligibility_reasons) AS INTEGER) AS _eligibility_restriction_count,
    CASE WHEN _requires_data_review THEN 'REVIEW_REQUIRED'
         WHEN _is_ml_standard_trip_eligible AND len(_eligibility_reasons) = 0 THEN 'FULLY_ELIGIBLE'
         ELSE 'PARTIALLY_ELIGIBLE' END AS _eligibility_status,
    '2.0' AS _quality_rule_version
  FROM trips_el5
),
silver_trips AS (SELECT * FROM trips_classified WHERE NOT _is_quarantined),
quarantine_trips AS (SELECT * FROM trips_classified WHERE _is_quarantined)"""
