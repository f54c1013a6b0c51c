"""Per-metric eligibility, data statuses and eligibility reasons (EL1-EL21).

The metrics come from :mod:`tripmart.operators.contract`, one projection per
dependency layer; statuses and reasons are tables of (value, predicate) read
over the metric columns and row flags. Warnings are read through their source
flags (a code is present exactly when its flag is true).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.predicates import reason_array
from tripmart.operators.contract import FLAG_OF, METRICS, NEGATIVE_CODES, REVIEW_CODES, classified_rule, layers

# Fixed values of the contract: status values and reason codes.
_NEGATIVE = "(" + " OR ".join(FLAG_OF[c] for c in NEGATIVE_CODES) + ")"
_SIGNED_TOTAL = FLAG_OF["NEGATIVE_TOTAL_AMOUNT"]
_GAP = FLAG_OF["FINANCIAL_RECONCILIATION_GAP"]
REVERSAL = f"{_SIGNED_TOTAL} AND NOT {_GAP}"
ODD_SIGN = f"{_NEGATIVE} AND NOT {_SIGNED_TOTAL}"
STATUS_LADDERS = {
    "_passenger_data_status": [
        ("EXPECTED_FLEX_FARE_MISSING", FLAG_OF["FLEX_FARE_PASSENGER_COUNT_MISSING"]),
        ("MISSING_UNEXPECTED", FLAG_OF["PASSENGER_COUNT_MISSING"]),
        ("NEGATIVE_INVALID", "_is_negative_passenger_count"),
        ("ZERO_REPORTED", "_is_zero_passenger_count"),
        ("REPORTED_VALID", "true"),
    ],
    "_distance_data_status": [
        ("NEGATIVE_INVALID", "trip_distance < 0"),
        ("ZERO_DISTANCE_REVERSAL", f"_is_zero_distance AND {_SIGNED_TOTAL}"),
        ("ZERO_DISTANCE_NO_CHARGE", "_is_zero_distance AND total_amount = 0"),
        ("ZERO_DISTANCE_WITH_CHARGE", "_is_zero_distance"),
        ("POSITIVE_DISTANCE", "true"),
    ],
    "_financial_record_type": [
        ("NEGATIVE_UNRECONCILED", f"{_GAP} AND {_SIGNED_TOTAL}"),
        ("UNRECONCILED", _GAP),
        ("RECONCILED_REVERSAL_OR_ADJUSTMENT", REVERSAL),
        ("NEGATIVE_COMPONENT_REVIEW", ODD_SIGN),
        ("REGULAR_TRANSACTION", "true"),
    ],
}
# Reasons reported for a metric that does not hold, by metric.
METRIC_REASONS = {
    name: f"{name.upper()}_METRICS_INELIGIBLE"
    for name in ("passenger", "distance", "duration", "reported_tip", "rate_code", "vendor", "payment_type", "route")
} | {"financial_breakdown": "FINANCIAL_BREAKDOWN_INELIGIBLE"}
OTHER_REASONS = [
    ("CRITICAL_QUALITY_VIOLATION", "_is_quarantined"),
    ("RECONCILED_REVERSAL_OR_ADJUSTMENT", "_is_reversal_or_adjustment"),
    ("NEGATIVE_COMPONENT_REQUIRES_REVIEW", "_financial_record_type = 'NEGATIVE_COMPONENT_REVIEW'"),
    ("SOURCE_DUPLICATE_CANONICAL_RECORD", FLAG_OF["DUPLICATE_GROUP_CANONICAL_RECORD"]),
    ("GOLD_DATE_EXTENSION_REQUIRED", "_requires_gold_date_extension"),
]


def _ladder(steps: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN '{value}'" for value, when in steps) + " END"


def add_eligibility(df: DataFrame) -> DataFrame:
    """Metrics, statuses, reasons and the overall status as columns."""
    for names in layers():
        df = df.withColumns({METRICS[n].column: F.expr(classified_rule(n)) for n in names})
    review = " OR ".join(["_is_quarantined", *[FLAG_OF[c] for c in REVIEW_CODES], f"({ODD_SIGN})"])
    df = df.withColumns(
        {
            "_is_reversal_or_adjustment": F.expr(REVERSAL),
            "_requires_data_review": F.expr(review),
            "_requires_gold_date_extension": F.expr(FLAG_OF["CROSS_YEAR_TRIP"]),
            **{name: F.expr(_ladder(steps)) for name, steps in STATUS_LADDERS.items()},
        }
    )
    reasons = [(code, f"NOT {METRICS[n].column}") for n, code in METRIC_REASONS.items()] + OTHER_REASONS
    status = [
        ("REVIEW_REQUIRED", "_requires_data_review"),
        ("FULLY_ELIGIBLE", f"{METRICS['ml_standard'].column} AND size(_eligibility_reasons) = 0"),
        ("PARTIALLY_ELIGIBLE", "true"),
    ]
    return df.withColumn("_eligibility_reasons", reason_array(reasons, sort=True)).withColumns(
        {
            "_eligibility_restriction_count": F.expr("size(_eligibility_reasons)"),
            "_eligibility_status": F.expr(_ladder(status)),
        }
    )
