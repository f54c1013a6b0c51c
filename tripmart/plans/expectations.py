"""Expectation sets of each published dataset (EX1-EX8) as named SQL predicates.

A critical expectation is the negation of a critical reason, and the sets of
the published layers are derived from the metric contract, the size rules and
the key tables the other layers use; only names are listed here. A NULL
predicate counts as failed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.config import RunConfig
from tripmart.operators.checks import expectation_report
from tripmart.operators.contract import MANDATORY, METRICS, STATUSES, agrees
from tripmart.operators.quality import critical_rules, zone_rules
from tripmart.plans.gold_validation import DIMENSION_MEMBER, FOREIGN_KEYS, YEAR_ROLES
from tripmart.plans.validation import REVIEW, SIZES

# Fixed values of the contract: expectation name -> the reason code it excludes.
ZONE_NAMES = {
    "location_id_present": "LOCATION_ID_MISSING",
    "location_id_positive": "LOCATION_ID_NOT_POSITIVE",
    "location_id_unique": "DUPLICATE_LOCATION_ID",
    "borough_present": "BOROUGH_MISSING",
    "zone_present": "ZONE_MISSING",
    "service_zone_present": "SERVICE_ZONE_MISSING",
}
CRITICAL_NAMES = {
    "pickup_timestamp_present": "PICKUP_TIMESTAMP_MISSING",
    "dropoff_timestamp_present": "DROPOFF_TIMESTAMP_MISSING",
    "valid_trip_period": "INVALID_TRIP_PERIOD",
    "trip_duration_within_limit": "TRIP_DURATION_EXCEEDS_LIMIT",
    "pickup_in_expected_year": "PICKUP_OUTSIDE_EXPECTED_YEAR",
    "source_partition_matches_pickup": "SOURCE_PARTITION_MISMATCH",
    "trip_distance_present": "TRIP_DISTANCE_MISSING",
    "trip_distance_non_negative": "NEGATIVE_TRIP_DISTANCE",
    "passenger_count_non_negative_when_reported": "NEGATIVE_PASSENGER_COUNT",
    "total_amount_present": "TOTAL_AMOUNT_MISSING",
    "pickup_location_present": "PICKUP_LOCATION_MISSING",
    "dropoff_location_present": "DROPOFF_LOCATION_MISSING",
    "pickup_location_resolved": "PICKUP_LOCATION_NOT_RESOLVED",
    "dropoff_location_resolved": "DROPOFF_LOCATION_NOT_RESOLVED",
    "record_not_duplicated": "DUPLICATE_TRIP_RECORD",
}
#: Codes whose reason says nothing about a NULL input: the expectation fails there all the same.
UNKNOWN_FAILS = {
    "LOCATION_ID_NOT_POSITIVE": "location_id",
    "INVALID_TRIP_PERIOD": "dropoff_datetime > pickup_datetime",
    "TRIP_DURATION_EXCEEDS_LIMIT": "trip_duration_minutes",
    "PICKUP_OUTSIDE_EXPECTED_YEAR": "pickup_datetime",
    "SOURCE_PARTITION_MISMATCH": "pickup_datetime",
    "NEGATIVE_TRIP_DISTANCE": "trip_distance",
    "PICKUP_LOCATION_NOT_RESOLVED": "pickup_zone_location_id",
    "DROPOFF_LOCATION_NOT_RESOLVED": "dropoff_zone_location_id",
}


def _excluded(names: dict[str, str], rules: list[tuple[str, str]]) -> dict[str, str]:
    """Each name with the negation of its code's rule, known to be false."""
    text = dict(rules)
    out = {}
    for name, code in names.items():
        known = f"({UNKNOWN_FAILS[code]}) IS NOT NULL AND " if code in UNKNOWN_FAILS else ""
        out[name] = f"{known}NOT coalesce({text[code]}, false)"
    return out


def _eligible(names, prefix: str, suffix: str = "_eligible") -> dict[str, str]:
    return {f"{n}{suffix}": f"{prefix}{METRICS[n].column[1:]} = true" for n in names}


def _stated(prefix: str, size: str) -> str:
    column, formula = SIZES[size]
    return f"{column} = {formula}".replace(" _", f" {prefix}").replace("(_", f"({prefix}").removeprefix("_" if not prefix else "")


def quarantined(value: str) -> str:
    return f"_is_quarantined = {value}"


def zone_expectations(cfg: RunConfig) -> dict[str, str]:
    return _excluded(ZONE_NAMES, zone_rules())


def critical_expectations(cfg: RunConfig) -> dict[str, str]:
    return _excluded(CRITICAL_NAMES, critical_rules(cfg))


def valid_only(cfg: RunConfig) -> dict[str, str]:
    return {"only_valid_silver_records": quarantined("false")}


def quarantined_only(cfg: RunConfig) -> dict[str, str]:
    return {"only_quarantined_records": quarantined("true")}


def silver_expectations(cfg: RunConfig) -> dict[str, str]:
    return valid_only(cfg) | _eligible(MANDATORY, "_") | {
        "critical_reason_array_empty": "size(_dq_reasons) = 0",
        "record_hash_present": "record_hash IS NOT NULL",
        "efficiency_eligibility_consistent": agrees("efficiency"),
        "efficiency_matches_quality_contract": f"{METRICS['efficiency'].column} = _is_efficiency_kpi_eligible",
        "ml_standard_trip_consistent": agrees("ml_standard"),
        "eligibility_status_valid": f"_eligibility_status IN {STATUSES}",
        "eligibility_reason_count_consistent": _stated("_", "eligibility_count"),
        "fully_eligible_has_no_restrictions": "_eligibility_status <> 'FULLY_ELIGIBLE' OR _eligibility_restriction_count = 0",
        "review_status_consistent": f"_requires_data_review = ({REVIEW})",
    }


def quarantine_expectations(cfg: RunConfig) -> dict[str, str]:
    return quarantined_only(cfg) | {"critical_reason_present": "size(_dq_reasons) > 0"}


def gold_source_expectations(cfg: RunConfig) -> dict[str, str]:
    return {
        "source_record_hash_present": "source_record_hash IS NOT NULL",
        "source_record_is_not_quarantined": quarantined("false")[1:],
        "source_has_no_critical_reason": "size(critical_quality_reasons) = 0",
        **{f"source_{n}_is_eligible": f"{METRICS[n].column[1:]} = true" for n in MANDATORY},
        "source_quality_rule_is_supported": f"quality_rule_version = '{cfg.quality_rule_version}'",
    }


def dim_date_expectations(cfg: RunConfig) -> dict[str, str]:
    unknown, dated, keyed = DIMENSION_MEMBER["dim_date"]
    return {
        "date_member_is_known_or_unknown": f"({unknown} AND NOT ({dated})) OR (date_key > 0 AND {dated})",
        "known_date_key_matches_date": f"{unknown} OR {keyed}",
        "calendar_year_role_is_valid": f"calendar_year_role IN {(*YEAR_ROLES, 'UNKNOWN')}",
    }


def fact_expectations(cfg: RunConfig) -> dict[str, str]:
    """Critical keys point to known members; counts, metrics and their combinations agree."""
    keys = {f"{k.fact.removesuffix('_key')}_resolved": f"{k.fact} > {k.unknown}" for k in FOREIGN_KEYS if k.critical}
    return {"trip_key_present": "trip_key IS NOT NULL"} | keys | _eligible(MANDATORY, "", "_is_eligible") | {
        "warning_count_is_consistent": _stated("", "warning_count"),
        "eligibility_count_is_consistent": _stated("", "eligibility_count"),
        "efficiency_eligibility_is_consistent": agrees("efficiency", ""),
        "ml_standard_trip_is_consistent": agrees("ml_standard", ""),
    }


def _report(dataset: str, df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return expectation_report(df, rules).select(F.lit(dataset).alias("dataset"), "*")


#: Registered key -> (dataset name, layer of the lake, expectation set) of each report row group.
Sets = list[tuple[str, str, Callable[[RunConfig], dict[str, str]]]]
SETS: dict[str, Sets] = {
    "expectations_zones": [
        ("silver_taxi_zone_lookup_classified", "zones_classified", zone_expectations),
        ("silver_taxi_zone_lookup", "silver_zones", valid_only),
        ("quarantine_taxi_zone_lookup", "quarantine_zones", quarantined_only),
    ],
    "expectations_trips": [("silver_trip_classified", "trips_classified", critical_expectations)],
    "expectations_silver": [("silver_trip", "silver_trips", silver_expectations)],
    "expectations_quarantine": [("quarantine_trip", "quarantine_trips", quarantine_expectations)],
    "expectations_gold_source": [("gold_trip_source", "gold_trip_source", gold_source_expectations)],
    "expectations_dim_date": [("dim_date", "dim_date", dim_date_expectations)],
    "expectations_fact": [("fact_trip", "fact_trips", fact_expectations)],
}


#: Sets that must hold for a layer to be published, by layer: the rows they hold for, and the rules.
_ENFORCED: dict[str, list[tuple[str, Callable[[RunConfig], dict[str, str]]]]] = {
    "trips_classified": [("NOT _is_quarantined", silver_expectations), ("_is_quarantined", quarantine_expectations)],
    "silver_zones": [("true", valid_only)],
    "quarantine_zones": [("true", quarantined_only)],
    "gold_trip_source": [("true", gold_source_expectations)],
    "dim_date": [("true", dim_date_expectations)],
    "fact_trips": [("true", fact_expectations)],
}


def enforced(layer: str, cfg: RunConfig) -> list[tuple[str, dict[str, str]]]:
    """The rule sets whose failure stops the run at a layer (EX3-EX8)."""
    return [(part, rules(cfg)) for part, rules in _ENFORCED.get(layer, [])]


def report(key: str) -> Callable[[object], DataFrame]:
    """The registered report of one key: passed and failed rows of every expectation."""

    def run(lake) -> DataFrame:
        parts = [_report(name, getattr(lake, layer), rules(lake.cfg)) for name, layer, rules in SETS[key]]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    run.__name__ = key
    return run
