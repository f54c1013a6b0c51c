"""DuckDB statements for counters, expectation sets and validation reports.

Written from the contract alone: nothing here is taken from the engine's
plans, so a wrong predicate there shows as a difference. Every count is a
filtered count over one table; a metric is recomputed from row values and
warning lists. The oracle's tables have no refresh timestamps, which every
run writes, so counts of missing ones are 0.
"""

from __future__ import annotations

LAYERS = {"silver": "silver_trips", "quarantine": "quarantine_trips"}


def n(name: str, *conditions: str) -> str:
    """A named count of the rows that meet any of the conditions."""
    return f"CAST(count(*) FILTER (WHERE {' OR '.join(f'({c})' for c in conditions)}) AS BIGINT) AS {name}"


def rows(name: str) -> str:
    return f"CAST(count(*) AS BIGINT) AS {name}"


def distinct(name: str, column: str) -> str:
    return f"CAST(count(DISTINCT {column}) AS BIGINT) AS {name}"


def none(name: str) -> str:
    return f"CAST(0 AS BIGINT) AS {name}"


def warned(*codes: str, lists: str = "_dq_warning_reasons") -> str:
    return f"list_has_any({lists}, [{', '.join(repr(c) for c in codes)}])"


def other(column: str, value: str) -> str:
    return f"{column} IS DISTINCT FROM ({value})"


def select(source: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


# -- Silver -------------------------------------------------------------------
SILVER_COUNTS = select(
    "silver_trips",
    rows("silver_record_count"),
    distinct("distinct_record_hash_count", "record_hash"),
    n("missing_record_hash_count", "record_hash IS NULL"),
    n("invalid_silver_quarantine_flag_count", other("_is_quarantined", "FALSE")),
    n("silver_critical_reason_count", "_dq_reasons IS NULL", "len(_dq_reasons) > 0"),
    n("invalid_quality_rule_version_count", other("_quality_rule_version", "'2.0'")),
    none("missing_refresh_timestamp_count"),
    n("warning_count_mismatch_count", other("_dq_warning_count", "len(_dq_warning_reasons)")),
    n("warning_flag_mismatch_count", other("_has_dq_warnings", "len(_dq_warning_reasons) > 0")),
    n("eligibility_count_mismatch_count", other("_eligibility_restriction_count", "len(_eligibility_reasons)")),
    n(
        "invalid_eligibility_status_count",
        "coalesce(_eligibility_status, '') NOT IN ('REVIEW_REQUIRED', 'PARTIALLY_ELIGIBLE', 'FULLY_ELIGIBLE')",
    ),
    n("review_status_mismatch_count", other("_requires_data_review", "_eligibility_status = 'REVIEW_REQUIRED'")),
    n(
        "fully_eligible_contract_error_count",
        "_eligibility_status = 'FULLY_ELIGIBLE' AND (_eligibility_restriction_count > 0 "
        "OR _is_ml_standard_trip_eligible IS NOT TRUE)",
    ),
    n("trip_volume_eligibility_error_count", "_is_trip_volume_metric_eligible IS NOT TRUE"),
    n("recorded_amount_eligibility_error_count", "_is_recorded_amount_metric_eligible IS NOT TRUE"),
    n("route_eligibility_error_count", "_is_route_metric_eligible IS NOT TRUE"),
    n(
        "efficiency_eligibility_mismatch_count",
        other("_is_efficiency_metric_eligible", "_is_distance_metric_eligible AND _is_duration_metric_eligible"),
    ),
    n("efficiency_contract_mismatch_count", other("_is_efficiency_kpi_eligible", "_is_efficiency_metric_eligible")),
    n(
        "eligibility_warning_rule_mismatch_count",
        other(
            "_is_passenger_metric_eligible",
            "NOT " + warned("PASSENGER_COUNT_MISSING", "FLEX_FARE_PASSENGER_COUNT_MISSING", "NON_POSITIVE_PASSENGER_COUNT"),
        ),
        other("_is_distance_metric_eligible", "trip_distance > 0 AND NOT " + warned("ZERO_TRIP_DISTANCE")),
        other("_is_duration_metric_eligible", "trip_duration_minutes > 0 AND trip_duration_minutes <= 360"),
        other("_is_financial_breakdown_metric_eligible", "NOT " + warned("FINANCIAL_RECONCILIATION_GAP")),
        other("_is_vendor_metric_eligible", "coalesce(vendor_id IN (1, 2, 6, 7), FALSE)"),
        other("_is_payment_type_metric_eligible", "coalesce(payment_type BETWEEN 0 AND 6, FALSE)"),
        other("_is_rate_code_metric_eligible", "coalesce(rate_code_id IN (1, 2, 3, 4, 5, 6, 99), FALSE)"),
        other(
            "_is_reported_tip_metric_eligible",
            "coalesce(payment_type IN (0, 1), FALSE) AND NOT " + warned("TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT"),
        ),
    ),
    n(
        "ml_eligibility_mismatch_count",
        other("_is_ml_distance_feature_eligible", "_is_distance_metric_eligible"),
        other("_is_ml_passenger_feature_eligible", "_is_passenger_metric_eligible"),
        other(
            "_is_ml_categorical_feature_eligible",
            "_is_payment_type_metric_eligible AND _is_rate_code_metric_eligible AND _is_vendor_metric_eligible",
        ),
        other(
            "_is_ml_financial_feature_eligible",
            "_is_financial_breakdown_metric_eligible AND NOT "
            + warned("NEGATIVE_FARE_AMOUNT", "NEGATIVE_TIP_AMOUNT", "NEGATIVE_TOTAL_AMOUNT", "NEGATIVE_FINANCIAL_COMPONENT"),
        ),
        other(
            "_is_standard_operational_trip_eligible",
            "_is_efficiency_metric_eligible AND NOT "
            + warned("DUPLICATE_GROUP_CANONICAL_RECORD", "NEGATIVE_TOTAL_AMOUNT"),
        ),
        other(
            "_is_ml_standard_trip_eligible",
            "_is_passenger_metric_eligible AND _is_ml_financial_feature_eligible "
            "AND _is_ml_categorical_feature_eligible AND _is_standard_operational_trip_eligible",
        ),
    ),
    n("negative_passenger_in_silver_count", "passenger_count < 0"),
    n("zero_distance_warning_mismatch_count", other(warned("ZERO_TRIP_DISTANCE"), "trip_distance = 0")),
    n(
        "flex_fare_passenger_warning_mismatch_count",
        "passenger_count IS NULL AND payment_type = 0 AND NOT " + warned("FLEX_FARE_PASSENGER_COUNT_MISSING"),
    ),
    n(
        "unexpected_passenger_warning_mismatch_count",
        "passenger_count IS NULL AND payment_type IS DISTINCT FROM 0 AND NOT " + warned("PASSENGER_COUNT_MISSING"),
    ),
    n(
        "non_positive_passenger_warning_mismatch_count",
        "passenger_count < 1 AND NOT " + warned("NON_POSITIVE_PASSENGER_COUNT"),
    ),
    n(
        "financial_warning_mismatch_count",
        other(warned("FINANCIAL_RECONCILIATION_GAP"), "abs(_financial_reconciliation_difference) > 0.01"),
        other(warned("NEGATIVE_TOTAL_AMOUNT"), "coalesce(total_amount < 0, FALSE)"),
        other(warned("NEGATIVE_FARE_AMOUNT"), "coalesce(fare_amount < 0, FALSE)"),
        other(warned("NEGATIVE_TIP_AMOUNT"), "coalesce(tip_amount < 0, FALSE)"),
        other(warned("NEGATIVE_FINANCIAL_COMPONENT"), "_has_negative_financial_component"),
    ),
    n("gold_date_extension_mismatch_count", other("_requires_gold_date_extension", warned("CROSS_YEAR_TRIP"))),
    n("flex_fare_missing_passenger_count", warned("FLEX_FARE_PASSENGER_COUNT_MISSING")),
    n("unexpected_missing_passenger_count", warned("PASSENGER_COUNT_MISSING")),
    n("zero_distance_record_count", warned("ZERO_TRIP_DISTANCE")),
    n("financial_reconciliation_gap_count", warned("FINANCIAL_RECONCILIATION_GAP")),
    n("negative_total_amount_count", warned("NEGATIVE_TOTAL_AMOUNT")),
    n("gold_date_extension_required_count", "year(pickup_datetime) <> year(dropoff_datetime)"),
    n("review_required_count", "_eligibility_status = 'REVIEW_REQUIRED'"),
    n("partially_eligible_count", "_eligibility_status = 'PARTIALLY_ELIGIBLE'"),
)
QUARANTINE_COUNTS = select(
    "quarantine_trips",
    rows("quarantine_record_count"),
    n("q_missing_record_hash_count", "record_hash IS NULL"),
    n("invalid_quarantine_flag_count", "_is_quarantined IS NOT TRUE"),
    n("missing_critical_reason_count", "coalesce(len(_dq_reasons), 0) = 0"),
    n("q_invalid_quality_rule_version_count", other("_quality_rule_version", "'2.0'")),
    none("q_missing_refresh_timestamp_count"),
    n("invalid_review_status_count", "_requires_data_review IS NOT TRUE", other("_eligibility_status", "'REVIEW_REQUIRED'")),
    n(
        "invalid_quarantine_eligibility_count",
        *[
            f"_is_{m}_eligible IS NOT FALSE"
            for m in ("trip_volume_metric", "recorded_amount_metric", "route_metric", "ml_standard_trip")
        ],
    ),
    n(
        "invalid_quarantine_reason_contract_count",
        other("_eligibility_restriction_count", "len(_eligibility_reasons)"),
        "NOT " + warned("CRITICAL_QUALITY_VIOLATION", lists="_eligibility_reasons"),
    ),
    n(
        "quarantine_warning_contract_mismatch_count",
        other("_dq_warning_count", "len(_dq_warning_reasons)"),
        other("_has_dq_warnings", "len(_dq_warning_reasons) > 0"),
    ),
    n(
        "negative_passenger_reason_mismatch_count",
        other(warned("NEGATIVE_PASSENGER_COUNT", lists="_dq_reasons"), "coalesce(passenger_count < 0, FALSE)"),
    ),
)

# -- Gold ---------------------------------------------------------------------
BASELINE = select(
    "silver_trips",
    rows("s_row_count"),
    distinct("s_distinct_record_hash_count", "record_hash"),
    "min(least(CAST(pickup_datetime AS DATE), CAST(dropoff_datetime AS DATE))) AS minimum_source_date",
    "max(greatest(CAST(pickup_datetime AS DATE), CAST(dropoff_datetime AS DATE))) AS maximum_source_date",
    n("s_records_with_warning", "len(_dq_warning_reasons) > 0"),
    n("s_records_requiring_review", "_requires_data_review"),
    n("s_partially_eligible_records", "_eligibility_status = 'PARTIALLY_ELIGIBLE'"),
    n("s_review_required_records", "_eligibility_status = 'REVIEW_REQUIRED'"),
    n("s_financially_unreconciled_records", warned("FINANCIAL_RECONCILIATION_GAP")),
    n("s_negative_total_amount_records", "total_amount < 0"),
    n("s_zero_distance_records", "trip_distance = 0"),
    n("s_cross_year_records", "year(pickup_datetime) <> year(dropoff_datetime)"),
    n("s_efficiency_ineligible_records", "NOT (_is_distance_metric_eligible AND _is_duration_metric_eligible)"),
)
DATE_SPANS = {
    f"{word}_{role}_date": f"{word[:3]}(CAST({role}_datetime AS DATE))"
    for role in ("pickup", "dropoff")
    for word in ("minimum", "maximum")
}
FACT_COUNTS = select(
    "fact_trips",
    rows("row_count"),
    distinct("distinct_trip_key_count", "trip_key"),
    distinct("distinct_source_hash_count", "source_record_hash"),
    n("missing_business_key_count", "coalesce(trim(trip_key), '') = ''", "coalesce(trim(source_record_hash), '') = ''"),
    n("trip_source_hash_mismatch_count", "trip_key IS DISTINCT FROM source_record_hash"),
    n(
        "null_dimension_key_count",
        "pickup_date_key IS NULL", "dropoff_date_key IS NULL", "pickup_time_key IS NULL", "dropoff_time_key IS NULL",
        "pickup_zone_key IS NULL", "dropoff_zone_key IS NULL", "payment_type_key IS NULL", "rate_code_key IS NULL",
        "vendor_key IS NULL",
    ),
    n("unknown_date_dimension_count", "0 IN (pickup_date_key, dropoff_date_key)"),
    n(
        "unknown_critical_dimension_count",
        "0 IN (pickup_date_key, dropoff_date_key, pickup_zone_key, dropoff_zone_key)",
        "-1 IN (pickup_time_key, dropoff_time_key)",
    ),
    n("unknown_business_dimension_count", "-1 IN (payment_type_key, rate_code_key, vendor_key)"),
    n("invalid_trip_count_count", "trip_count IS DISTINCT FROM 1"),
    n("invalid_route_key_count", other("route_key", "pickup_zone_key || ':' || dropoff_zone_key")),
    n(
        "invalid_temporal_measure_count",
        "pickup_datetime IS NULL", "dropoff_datetime IS NULL", "coalesce(trip_duration_minutes, 0) <= 0",
    ),
    n(
        "warning_contract_mismatch_count",
        "dq_warning_reasons IS NULL", "dq_warning_count IS NULL", "has_dq_warnings IS NULL",
        "dq_warning_count <> len(dq_warning_reasons)", "has_dq_warnings <> (len(dq_warning_reasons) > 0)",
    ),
    n(
        "eligibility_contract_mismatch_count",
        "eligibility_reasons IS NULL", "eligibility_restriction_count IS NULL", "eligibility_status IS NULL",
        "eligibility_restriction_count <> len(eligibility_reasons)",
        "eligibility_status NOT IN ('REVIEW_REQUIRED', 'PARTIALLY_ELIGIBLE', 'FULLY_ELIGIBLE')",
        other("requires_data_review", "eligibility_status = 'REVIEW_REQUIRED'"),
    ),
    n("invalid_quality_metadata_count", other("quality_rule_version", "'2.0'")),
    n(
        "mandatory_metric_ineligible_count",
        "is_trip_volume_metric_eligible IS NOT TRUE", "is_recorded_amount_metric_eligible IS NOT TRUE",
        "is_route_metric_eligible IS NOT TRUE",
    ),
    n(
        "derived_eligibility_mismatch_count",
        other("is_efficiency_metric_eligible", "is_duration_metric_eligible AND is_distance_metric_eligible"),
        "is_efficiency_kpi_eligible IS DISTINCT FROM is_efficiency_metric_eligible",
        other(
            "is_ml_standard_trip_eligible",
            "is_passenger_metric_eligible AND is_ml_financial_feature_eligible AND is_ml_categorical_feature_eligible "
            "AND is_standard_operational_trip_eligible",
        ),
    ),
    n(
        "business_dimension_eligibility_mismatch_count",
        other("payment_type_key = -1", "NOT is_payment_type_metric_eligible"),
        other("rate_code_key = -1", "NOT is_rate_code_metric_eligible"),
        other("vendor_key = -1", "NOT is_vendor_metric_eligible"),
    ),
    n(
        "financial_contract_mismatch_count",
        other("is_financially_unreconciled", "abs(financial_reconciliation_difference) > 0.01"),
        other("financial_reconciliation_difference", "total_amount - financial_component_amount"),
    ),
    n(
        "reported_tip_contract_mismatch_count",
        other(
            "reported_card_tip_amount",
            "coalesce(CASE WHEN payment_type_key = 1 AND is_reported_tip_metric_eligible THEN tip_amount END, 0)",
        ),
        other(
            "has_reported_electronic_tip",
            "payment_type_key = 1 AND is_reported_tip_metric_eligible AND coalesce(tip_amount, 0) > 0",
        ),
    ),
    n("records_with_warning", "has_dq_warnings"),
    n("records_requiring_review", "requires_data_review"),
    n("partially_eligible_records", "eligibility_status = 'PARTIALLY_ELIGIBLE'"),
    n("review_required_records", "eligibility_status = 'REVIEW_REQUIRED'"),
    n("financially_unreconciled_records", "abs(financial_reconciliation_difference) > 0.01"),
    n("negative_total_amount_records", "total_amount < 0"),
    n("zero_distance_records", "trip_distance_miles = 0"),
    n("cross_year_records", "year(pickup_datetime) <> year(dropoff_datetime)"),
    n("efficiency_ineligible_records", "NOT (is_distance_metric_eligible AND is_duration_metric_eligible)"),
    n("financial_breakdown_ineligible_records", "NOT is_financial_breakdown_metric_eligible"),
    n("ml_standard_trip_ineligible_records", "NOT is_ml_standard_trip_eligible"),
    *[f"{expression} AS {name}" for name, expression in DATE_SPANS.items()],
)


def _orphans(counter: str, key: str, dimension: str, member: str) -> str:
    return f"(SELECT CAST(count(*) AS BIGINT) FROM fact_trips WHERE {key} IS NULL OR {key} NOT IN " \
           f"(SELECT {member} FROM {dimension})) AS orphan_{counter}_count"


FOREIGN_KEYS = "SELECT " + ", ".join([
    _orphans("pickup_date", "pickup_date_key", "dim_date", "date_key"),
    _orphans("dropoff_date", "dropoff_date_key", "dim_date", "date_key"),
    _orphans("pickup_time", "pickup_time_key", "dim_time", "time_key"),
    _orphans("dropoff_time", "dropoff_time_key", "dim_time", "time_key"),
    _orphans("pickup_zone", "pickup_zone_key", "dim_pickup_zone", "pickup_zone_key"),
    _orphans("dropoff_zone", "dropoff_zone_key", "dim_dropoff_zone", "dropoff_zone_key"),
    _orphans("payment", "payment_type_key", "dim_payment_type", "payment_type_key"),
    _orphans("rate", "rate_code_key", "dim_rate_code", "rate_code_key"),
    _orphans("vendor", "vendor_key", "dim_vendor", "vendor_key"),
])


def _unequal(*columns: str) -> list[str]:
    return [f"s.record_hash IS NOT NULL AND f.{c} IS DISTINCT FROM s._{c}" for c in columns]


RECORD_PARITY = select(
    "fact_trips f LEFT JOIN silver_trips s ON s.record_hash = f.source_record_hash",
    n("fact_without_silver_record_count", "s.record_hash IS NULL"),
    n("warning_propagation_mismatch_count", *_unequal("dq_warning_reasons", "dq_warning_count", "has_dq_warnings")),
    n(
        "eligibility_propagation_mismatch_count",
        *_unequal("eligibility_reasons", "eligibility_restriction_count", "eligibility_status", "requires_data_review"),
    ),
    n(
        "eligibility_flag_propagation_mismatch_count",
        *_unequal(
            "is_trip_volume_metric_eligible", "is_recorded_amount_metric_eligible", "is_efficiency_metric_eligible",
            "is_financial_breakdown_metric_eligible", "is_ml_standard_trip_eligible",
        ),
    ),
    n(
        "financial_propagation_mismatch_count",
        *_unequal("financial_reconciliation_difference", "is_financially_unreconciled"),
    ),
)

#: Dimension -> its prefix in the report, key, unknown key, and what makes a member invalid.
DIMENSIONS = {
    "dim_date": (
        "d_", "date_key", 0,
        "date_key = 0 AND (full_date IS NOT NULL OR calendar_year_role <> 'UNKNOWN' OR is_source_year) OR date_key <> 0 "
        "AND (full_date IS NULL OR CAST(date_key AS VARCHAR) <> strftime(full_date, '%Y%m%d') OR calendar_year_role "
        "NOT IN ('SOURCE_YEAR_RANGE', 'PREDECESSOR_YEAR', 'SUCCESSOR_YEAR'))",
    ),
    "dim_time": (
        "t_", "time_key", -1,
        "CASE WHEN time_key = -1 THEN hour_number IS NOT NULL ELSE hour_number IS NULL OR hour_number < 0 "
        "OR hour_number > 23 OR hour_number <> time_key END",
    ),
    "dim_pickup_zone": ("pz_", "pickup_zone_key", 0, "FALSE"),
    "dim_dropoff_zone": ("dz_", "dropoff_zone_key", 0, "FALSE"),
    "dim_payment_type": ("p_", "payment_type_key", -1, "FALSE"),
    "dim_rate_code": ("r_", "rate_code_key", -1, "FALSE"),
    "dim_vendor": ("v_", "vendor_key", -1, "FALSE"),
}


def _members(dimension: str, prefix: str) -> str:
    _, key, unknown, invalid = DIMENSIONS[dimension]
    return ", ".join([
        rows(f"{prefix}row_count"), distinct(f"{prefix}distinct_key_count", key),
        n(f"{prefix}unknown_member_count", f"{key} = {unknown}"), n(f"{prefix}invalid_member_count", invalid),
    ])


DIMENSION_STATS = " UNION ALL ".join(f"SELECT '{d}' AS dimension, {_members(d, '')} FROM {d}" for d in DIMENSIONS)
CALENDAR = (
    "SELECT year(minimum_source_date) AS y0, year(maximum_source_date) AS y1, make_date(y0 - 1, 1, 1) AS "
    "expected_calendar_start_date, make_date(y1 + 1, 12, 31) AS expected_calendar_end_date, "
    f"expected_calendar_end_date - expected_calendar_start_date + 2 AS expected_calendar_row_count FROM ({BASELINE})"
)
DATES = select(
    f"dim_date, ({CALENDAR}) c",
    "min(full_date) FILTER (WHERE date_key <> 0) AS minimum_calendar_date",
    "max(full_date) FILTER (WHERE date_key <> 0) AS maximum_calendar_date",
    n(
        "d_invalid_year_role_count",
        "date_key <> 0 AND calendar_year_role IS DISTINCT FROM (CASE WHEN year(full_date) BETWEEN y0 AND y1 "
        "THEN 'SOURCE_YEAR_RANGE' WHEN year(full_date) > y1 THEN 'SUCCESSOR_YEAR' ELSE 'PREDECESSOR_YEAR' END)",
    ),
    n(
        "d_invalid_source_year_flag_count",
        "date_key <> 0 AND is_source_year IS DISTINCT FROM (year(full_date) >= y0 AND year(full_date) <= y1)",
    ),
    n(
        "d_invalid_calendar_attribute_count",
        "date_key <> 0 AND is_weekend IS DISTINCT FROM (isodow(full_date) >= 6)",
        "date_key <> 0 AND is_business_day IS DISTINCT FROM (holiday_name IS NULL AND NOT is_weekend)",
        "date_key <> 0 AND holiday_name IS NOT NULL AND (is_federal_holiday AND holiday_scope = 'US Federal') IS NOT TRUE",
    ),
)


# -- Reports ------------------------------------------------------------------
def row(group: str, name: str, severity: str, parts: dict[str, str], evaluated: str, details: str, fails: str = "FAIL",
        total: str | None = None) -> str:
    """A report row: exceptions are the sum of its parts; it passes when the sum is zero."""
    amount = total or " + ".join(parts.values())
    status = "'INFO'" if severity == "INFO" else f"CASE WHEN ({amount}) = 0 THEN 'PASS' ELSE '{fails}' END"
    return (
        f"SELECT '{group}' AS validation_group, '{name}' AS validation_name, '{severity}' AS severity, {status} AS status, "
        f"CAST({amount} AS BIGINT) AS exception_record_count, CAST({evaluated} AS BIGINT) AS evaluated_record_count, "
        f"{details} AS details FROM one_row"
    )


def listed(parts: dict[str, str]) -> str:
    """``k1=v1; k2=v2``."""
    return " || '; ' || ".join(f"'{k}=' || ({v})" for k, v in parts.items())


def report(one_row: str, lines: list[str]) -> str:
    return (
        f", one_row AS ({one_row}), lines AS ({' UNION ALL '.join(lines)}) SELECT validation_group, validation_name, "
        "severity, status, exception_record_count, evaluated_record_count, CASE WHEN evaluated_record_count = 0 THEN 0.0 "
        "ELSE round(100.0 * CAST(exception_record_count AS DOUBLE) / CAST(evaluated_record_count AS DOUBLE), 6) END "
        "AS exception_rate_pct, details FROM lines"
    )


def joined(*parts: str) -> str:
    return "SELECT * FROM " + ", ".join(f"({p}) AS part{i}" for i, p in enumerate(parts))


def blocker(group: str, name: str, evaluated: str, details: str | None = None, total: str | None = None, **parts: str) -> str:
    return row(group, name, "BLOCKER", parts, evaluated, f"'{details}'" if details else listed(parts), total=total)


def monitor(name: str, evaluated: str, count: str, details: str, severity: str = "WARNING") -> str:
    return row("MONITORING", name, severity, {"n": count}, evaluated, details, "WARN")


S, Q = "silver_record_count", "quarantine_record_count"
SILVER_VALIDATION = report(
    joined("SELECT CAST(count(*) AS BIGINT) AS bronze_record_count FROM bronze_trips", SILVER_COUNTS, QUARANTINE_COUNTS),
    [
        blocker("VOLUME", "source_record_conservation", "bronze_record_count",
                total=f"abs(bronze_record_count - {S} - {Q})", bronze="bronze_record_count", silver=S, quarantine=Q),
        blocker("SILVER_CONTRACT", "silver_is_populated", S, total=f"CAST({S} = 0 AS INT)", silver_records=S),
        blocker("SILVER_CONTRACT", "record_hash_is_unique", S, total=f"{S} - distinct_record_hash_count", rows=S,
                distinct_hashes="distinct_record_hash_count"),
        blocker("SILVER_CONTRACT", "record_hash_is_present", S, "record_hash must be populated in every published Silver record",
                n="missing_record_hash_count"),
        blocker("SILVER_CONTRACT", "no_critical_record_in_silver", S, invalid_flags="invalid_silver_quarantine_flag_count",
                records_with_critical_reasons="silver_critical_reason_count"),
        blocker("METADATA_CONTRACT", "silver_rule_version_and_refresh", S,
                invalid_rule_versions="invalid_quality_rule_version_count",
                missing_refresh_timestamps="missing_refresh_timestamp_count"),
        blocker("WARNING_CONTRACT", "warning_array_count_and_flag", S, count_mismatches="warning_count_mismatch_count",
                flag_mismatches="warning_flag_mismatch_count"),
        blocker("WARNING_CONTRACT", "warning_business_rules", S, zero_distance="zero_distance_warning_mismatch_count",
                flex_passenger="flex_fare_passenger_warning_mismatch_count",
                unexpected_passenger="unexpected_passenger_warning_mismatch_count",
                non_positive_passenger="non_positive_passenger_warning_mismatch_count",
                financial="financial_warning_mismatch_count", gold_date="gold_date_extension_mismatch_count"),
        blocker("ELIGIBILITY_CONTRACT", "eligibility_reason_count_and_status", S,
                reason_count="eligibility_count_mismatch_count", invalid_status="invalid_eligibility_status_count",
                review_status="review_status_mismatch_count", fully_eligible="fully_eligible_contract_error_count"),
        blocker("ELIGIBILITY_CONTRACT", "mandatory_metric_eligibility", S,
                trip_volume="trip_volume_eligibility_error_count",
                recorded_amount="recorded_amount_eligibility_error_count", route="route_eligibility_error_count"),
        blocker("ELIGIBILITY_CONTRACT", "derived_eligibility_consistency", S,
                efficiency_formula="efficiency_eligibility_mismatch_count",
                efficiency_kpi="efficiency_contract_mismatch_count",
                warning_rules="eligibility_warning_rule_mismatch_count", ml_formula="ml_eligibility_mismatch_count"),
        blocker("BUSINESS_RULE", "negative_passenger_is_quarantined", S,
                "Negative passenger_count must not be published in the valid Silver table",
                n="negative_passenger_in_silver_count"),
        blocker("QUARANTINE_CONTRACT", "quarantine_has_critical_reasons", Q, invalid_flags="invalid_quarantine_flag_count",
                missing_reasons="missing_critical_reason_count", missing_hashes="q_missing_record_hash_count"),
        blocker("QUARANTINE_CONTRACT", "quarantine_eligibility_and_metadata", Q,
                metadata="q_invalid_quality_rule_version_count + q_missing_refresh_timestamp_count",
                review_status="invalid_review_status_count", eligibility="invalid_quarantine_eligibility_count",
                reasons="invalid_quarantine_reason_contract_count", warnings="quarantine_warning_contract_mismatch_count",
                negative_passenger="negative_passenger_reason_mismatch_count"),
        monitor("unexpected_missing_passenger", S, "unexpected_missing_passenger_count",
                "'Unexpected missing passenger_count; exclude from passenger metrics and ML features'"),
        monitor("flex_fare_missing_passenger", S, "flex_fare_missing_passenger_count",
                "'Known Flex Fare limitation; trip volume and amount remain eligible'", "INFO"),
        monitor("zero_trip_distance", S, "zero_distance_record_count",
                "'Records remain in Silver but are excluded from distance and efficiency metrics'"),
        monitor("financial_reconciliation_gap", S, "financial_reconciliation_gap_count",
                "'Records require review and are excluded from financial breakdown metrics'"),
        monitor("negative_total_amount", S, "negative_total_amount_count",
                "'Review as reversal/adjustment; do not automatically discard signed transactions'"),
        monitor("gold_date_extension_required", S, "gold_date_extension_required_count",
                "'Extend dim_date through the maximum dropoff date before rebuilding Gold'"),
        monitor("records_requiring_review", S, "review_required_count",
                listed({"review_required": "review_required_count", "partially_eligible": "partially_eligible_count"})),
    ],
)

ORPHANS = ("pickup_date", "dropoff_date", "pickup_time", "dropoff_time", "pickup_zone", "dropoff_zone", "payment", "rate", "vendor")
SHARED = (
    "records_with_warning", "records_requiring_review", "partially_eligible_records", "review_required_records",
    "financially_unreconciled_records", "negative_total_amount_records", "zero_distance_records", "cross_year_records",
    "efficiency_ineligible_records",
)
_SPAN = "strftime({}, '%Y-%m-%d')"
GOLD_VALIDATION = report(
    joined(BASELINE, CALENDAR, FACT_COUNTS, FOREIGN_KEYS, RECORD_PARITY, DATES,
           *[f"SELECT {_members(d, prefix)} FROM {d}" for d, (prefix, *_) in DIMENSIONS.items()],
           select("silver_zones", rows("z_row_count"), distinct("z_distinct_location_count", "location_id"))),
    [
        blocker("VOLUME", "silver_to_gold_record_conservation", "s_row_count", total="abs(row_count - s_row_count)",
                silver="s_row_count", gold_fact="row_count"),
        blocker("FACT_CONTRACT", "business_key_is_present_and_unique", "row_count",
                total="missing_business_key_count + trip_source_hash_mismatch_count + 2 * row_count - distinct_trip_key_count "
                      "- distinct_source_hash_count",
                rows="row_count", distinct_trip_keys="distinct_trip_key_count",
                distinct_source_hashes="distinct_source_hash_count", missing_keys="missing_business_key_count",
                trip_source_mismatches="trip_source_hash_mismatch_count"),
        blocker("FACT_CONTRACT", "mandatory_measures_and_dimension_keys", "row_count",
                null_dimension_keys="null_dimension_key_count", invalid_trip_count="invalid_trip_count_count",
                invalid_temporal="invalid_temporal_measure_count", invalid_route="invalid_route_key_count"),
        blocker("FACT_CONTRACT", "critical_dimensions_are_resolved", "row_count", total="unknown_critical_dimension_count",
                unknown_critical_dimensions="unknown_critical_dimension_count",
                unknown_dates="unknown_date_dimension_count"),
        blocker("REFERENTIAL_INTEGRITY", "all_fact_foreign_keys_exist", "row_count",
                **{k: f"orphan_{k}_count" for k in ORPHANS}),
        row("DIMENSION_CONTRACT", "dynamic_date_coverage", "BLOCKER", {}, "expected_calendar_row_count",
            listed({"source_range": f"{_SPAN.format('minimum_source_date')} || '..' || {_SPAN.format('maximum_source_date')}",
                    "expected_calendar": f"{_SPAN.format('expected_calendar_start_date')} || '..' || "
                                         f"{_SPAN.format('expected_calendar_end_date')}",
                    "actual_calendar": f"{_SPAN.format('minimum_calendar_date')} || '..' || "
                                       f"{_SPAN.format('maximum_calendar_date')}",
                    "actual_rows": "d_row_count", "expected_rows": "expected_calendar_row_count"}),
            total="abs(d_row_count - expected_calendar_row_count) + d_row_count - d_distinct_key_count + "
                  "abs(d_unknown_member_count - 1) + d_invalid_member_count + d_invalid_year_role_count + "
                  "d_invalid_source_year_flag_count + CAST(minimum_calendar_date <> expected_calendar_start_date AS INT) + "
                  "CAST(maximum_calendar_date <> expected_calendar_end_date AS INT)"),
        blocker("DIMENSION_CONTRACT", "date_business_attributes", "d_row_count",
                "Weekend, business-day and populated federal-holiday attributes must agree",
                n="d_invalid_calendar_attribute_count"),
        blocker("DIMENSION_CONTRACT", "time_dimension_complete", "25",
                total="abs(t_row_count - 25) + t_row_count - t_distinct_key_count + abs(t_unknown_member_count - 1) + "
                      "t_invalid_member_count",
                rows="t_row_count", distinct_keys="t_distinct_key_count", unknown_members="t_unknown_member_count",
                invalid_members="t_invalid_member_count"),
        blocker("DIMENSION_CONTRACT", "zone_dimensions_match_silver", "2 * z_row_count + 2",
                total="abs(pz_row_count - z_row_count - 1) + abs(dz_row_count - z_row_count - 1) + pz_row_count - "
                      "pz_distinct_key_count + dz_row_count - dz_distinct_key_count + abs(pz_unknown_member_count - 1) + "
                      "abs(dz_unknown_member_count - 1) + z_row_count - z_distinct_location_count",
                silver_zones="z_row_count", pickup_dim="pz_row_count", dropoff_dim="dz_row_count",
                expected_each="z_row_count + 1"),
        blocker("DIMENSION_CONTRACT", "business_code_dimensions_complete", "21",
                total=" + ".join(f"abs({p}_row_count - {size}) + {p}_row_count - {p}_distinct_key_count + "
                                 f"abs({p}_unknown_member_count - 1)" for p, size in (("p", 8), ("r", 8), ("v", 5))),
                payment="p_row_count", rate="r_row_count", vendor="v_row_count"),
        blocker("QUALITY_CONTRACT", "warning_and_eligibility_contracts", "row_count",
                warning="warning_contract_mismatch_count", eligibility="eligibility_contract_mismatch_count",
                metadata="invalid_quality_metadata_count", mandatory_metrics="mandatory_metric_ineligible_count",
                derived="derived_eligibility_mismatch_count",
                business_dimensions="business_dimension_eligibility_mismatch_count"),
        blocker("QUALITY_CONTRACT", "financial_and_reported_tip_contracts", "row_count",
                financial_mismatches="financial_contract_mismatch_count",
                reported_tip_mismatches="reported_tip_contract_mismatch_count"),
        blocker("SILVER_GOLD_PARITY", "record_level_quality_contract_propagation", "row_count",
                missing_silver="fact_without_silver_record_count", warning="warning_propagation_mismatch_count",
                eligibility="eligibility_propagation_mismatch_count",
                flags="eligibility_flag_propagation_mismatch_count", financial="financial_propagation_mismatch_count"),
        blocker("SILVER_GOLD_PARITY", "aggregate_quality_distribution_parity", "s_row_count",
                total=" + ".join(f"abs({m} - s_{m})" for m in SHARED), warnings="records_with_warning",
                review="records_requiring_review", partial="partially_eligible_records",
                review_status="review_required_records", financial_gap="financially_unreconciled_records",
                negative_total="negative_total_amount_records", zero_distance="zero_distance_records",
                cross_year="cross_year_records"),
        monitor("unknown_business_dimensions", "row_count", "unknown_business_dimension_count",
                "'Unknown payment, rate or vendor members remain measurable but restrict categorical analysis'"),
        monitor("financial_reconciliation_gap", "row_count", "financially_unreconciled_records",
                "'excluded_from_financial_breakdown=' || financial_breakdown_ineligible_records || "
                "'; signed total amount remains eligible when allowed by Silver contract'"),
        monitor("negative_total_amount", "row_count", "negative_total_amount_records",
                "'Potential reversals or adjustments; preserve signed amounts and filter by eligibility for each metric'"),
        monitor("zero_distance_and_efficiency_exclusions", "row_count", "zero_distance_records",
                listed({"zero_distance": "zero_distance_records", "efficiency_ineligible": "efficiency_ineligible_records"})),
        monitor("records_requiring_review", "row_count", "records_requiring_review",
                listed({"review_required": "review_required_records", "partially_eligible": "partially_eligible_records",
                        "ml_standard_ineligible": "ml_standard_trip_ineligible_records"})),
        monitor("cross_year_records_are_covered_by_calendar", "row_count", "unknown_date_dimension_count",
                listed({"cross_year_records": "cross_year_records", "unresolved_date_keys": "unknown_date_dimension_count",
                        "fact_dropoff_max": _SPAN.format("maximum_dropoff_date")})),
    ],
)


# -- Expectations ---------------------------------------------------------------
def expected(dataset: str, source: str, **rules: str) -> list[str]:
    """Rows that meet each rule (a rule of unknown value is not met), and the others."""
    return [
        f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, {n('passed_records', rule)}, "
        f"CAST(count(*) FILTER (WHERE ({rule}) IS NOT TRUE) AS BIGINT) AS failed_records FROM {source}"
        for name, rule in rules.items()
    ]


_MANDATORY = ("trip_volume", "recorded_amount", "route")
EXPECTATIONS = {
    "expectations_zones": expected(
        "silver_taxi_zone_lookup_classified", "zones_classified",
        location_id_present="location_id IS NOT NULL", location_id_positive="location_id >= 1",
        location_id_unique="_duplicate_location_id_count < 2", borough_present="trim(borough) <> ''",
        zone_present="trim(zone) <> ''", service_zone_present="trim(service_zone) <> ''",
    ) + expected("silver_taxi_zone_lookup", "silver_zones", only_valid_silver_records="NOT _is_quarantined")
    + expected("quarantine_taxi_zone_lookup", "quarantine_zones", only_quarantined_records="_is_quarantined"),
    "expectations_trips": expected(
        "silver_trip_classified", "trips_classified",
        pickup_timestamp_present="pickup_datetime IS NOT NULL", dropoff_timestamp_present="dropoff_datetime IS NOT NULL",
        valid_trip_period="pickup_datetime < dropoff_datetime", trip_duration_within_limit="trip_duration_minutes <= 360",
        pickup_in_expected_year="year(pickup_datetime) = 1998",
        source_partition_matches_pickup="source_year = 1998 AND source_month = month(pickup_datetime)",
        trip_distance_present="trip_distance IS NOT NULL", trip_distance_non_negative="trip_distance >= 0",
        passenger_count_non_negative_when_reported="coalesce(passenger_count, 0) >= 0",
        total_amount_present="total_amount IS NOT NULL", pickup_location_present="pickup_location_id IS NOT NULL",
        dropoff_location_present="dropoff_location_id IS NOT NULL",
        pickup_location_resolved="pickup_zone_location_id IS NOT NULL",
        dropoff_location_resolved="dropoff_zone_location_id IS NOT NULL", record_not_duplicated="NOT _is_duplicate_record",
    ),
    "expectations_silver": expected(
        "silver_trip", "silver_trips",
        only_valid_silver_records="NOT _is_quarantined", critical_reason_array_empty="len(_dq_reasons) = 0",
        record_hash_present="record_hash IS NOT NULL",
        **{f"{m}_eligible": f"_is_{m}_metric_eligible" for m in _MANDATORY},
        efficiency_eligibility_consistent="_is_efficiency_metric_eligible = "
        "(_is_duration_metric_eligible AND _is_distance_metric_eligible)",
        efficiency_matches_quality_contract="_is_efficiency_kpi_eligible = _is_efficiency_metric_eligible",
        ml_standard_trip_consistent="_is_ml_standard_trip_eligible = (_is_passenger_metric_eligible AND "
        "_is_ml_categorical_feature_eligible AND _is_ml_financial_feature_eligible AND "
        "_is_standard_operational_trip_eligible)",
        eligibility_status_valid="_eligibility_status IN ('REVIEW_REQUIRED', 'PARTIALLY_ELIGIBLE', 'FULLY_ELIGIBLE')",
        eligibility_reason_count_consistent="len(_eligibility_reasons) = _eligibility_restriction_count",
        fully_eligible_has_no_restrictions="NOT (_eligibility_status = 'FULLY_ELIGIBLE' AND _eligibility_restriction_count <> 0)",
        review_status_consistent="_requires_data_review = (_eligibility_status = 'REVIEW_REQUIRED')",
    ),
    "expectations_quarantine": expected(
        "quarantine_trip", "quarantine_trips", only_quarantined_records="_is_quarantined",
        critical_reason_present="len(_dq_reasons) >= 1",
    ),
    "expectations_gold_source": expected(
        "gold_trip_source", "gold_trip_source",
        source_record_hash_present="source_record_hash IS NOT NULL", source_record_is_not_quarantined="NOT is_quarantined",
        source_has_no_critical_reason="len(critical_quality_reasons) = 0",
        **{f"source_{m}_is_eligible": f"is_{m}_metric_eligible" for m in _MANDATORY},
        source_quality_rule_is_supported="quality_rule_version = '2.0'",
    ),
    "expectations_dim_date": expected(
        "dim_date", "dim_date",
        date_member_is_known_or_unknown="CASE WHEN date_key = 0 THEN full_date IS NULL ELSE date_key > 0 AND full_date IS NOT NULL END",
        known_date_key_matches_date="date_key = 0 OR strftime(full_date, '%Y%m%d') = CAST(date_key AS VARCHAR)",
        calendar_year_role_is_valid="calendar_year_role IN ('UNKNOWN', 'SOURCE_YEAR_RANGE', 'PREDECESSOR_YEAR', 'SUCCESSOR_YEAR')",
    ),
    "expectations_fact": expected(
        "fact_trip", "fact_trips", trip_key_present="trip_key IS NOT NULL",
        **{f"{r}_{k}_resolved": f"{r}_{k}_key >= {low}" for r in ("pickup", "dropoff") for k, low in (("date", 1), ("time", 0), ("zone", 1))},
        **{f"{m}_is_eligible": f"is_{m}_metric_eligible" for m in _MANDATORY},
        warning_count_is_consistent="len(dq_warning_reasons) = dq_warning_count",
        eligibility_count_is_consistent="len(eligibility_reasons) = eligibility_restriction_count",
        efficiency_eligibility_is_consistent="is_efficiency_metric_eligible = "
        "(is_duration_metric_eligible AND is_distance_metric_eligible)",
        ml_standard_trip_is_consistent="is_ml_standard_trip_eligible = (is_passenger_metric_eligible AND "
        "is_ml_categorical_feature_eligible AND is_ml_financial_feature_eligible AND is_standard_operational_trip_eligible)",
    ),
}


def _as_text(query: str, *dates: str) -> str:
    replaced = ", ".join(f"strftime({d}, '%Y-%m-%d') AS {d}" for d in dates)
    return f"SELECT * REPLACE ({replaced}) FROM ({query})"


FINAL = {
    "silver_contract_counts": SILVER_COUNTS,
    "quarantine_contract_counts": QUARANTINE_COUNTS,
    "silver_validation": SILVER_VALIDATION,
    "gold_aggregate_parity": _as_text(BASELINE, "minimum_source_date", "maximum_source_date"),
    "gold_fact_counts": _as_text(FACT_COUNTS, *DATE_SPANS),
    "gold_record_parity": RECORD_PARITY,
    "gold_foreign_keys": FOREIGN_KEYS,
    "gold_dimension_stats": DIMENSION_STATS,
    "gold_validation": GOLD_VALIDATION,
    **{key: " UNION ALL ".join(parts) for key, parts in EXPECTATIONS.items()},
}
