"""The metric contract as data: which warnings block a metric, what it builds on, what it needs.

Every consumer derives its predicates from this one table: the classification
(from row flags), the published-layer counters and expectations (from columns
and warning arrays of the written copy) and the Gold checks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from tripmart.config import TIP_SUPPORTED_PAYMENT_CODES
from tripmart.operators.quality import WARNING_FLAGS

# ---------------------------------------------------------------------------
# Fixed values of the contract: statuses, column names, warning codes.
STATUSES = ("FULLY_ELIGIBLE", "PARTIALLY_ELIGIBLE", "REVIEW_REQUIRED")
NEGATIVE_CODES = (
    "NEGATIVE_TOTAL_AMOUNT",
    "NEGATIVE_FARE_AMOUNT",
    "NEGATIVE_TIP_AMOUNT",
    "NEGATIVE_FINANCIAL_COMPONENT",
)
REVIEW_CODES = (
    "DUPLICATE_GROUP_CANONICAL_RECORD",
    "FINANCIAL_RECONCILIATION_GAP",
    "NON_POSITIVE_PASSENGER_COUNT",
    "PASSENGER_COUNT_MISSING",
    "PAYMENT_TYPE_MISSING_OR_UNMAPPED",
    "RATE_CODE_MISSING_OR_UNMAPPED",
    "TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT",
    "VENDOR_MISSING_OR_UNMAPPED",
)
# ---------------------------------------------------------------------------

FLAG_OF = dict(WARNING_FLAGS)


@dataclass(frozen=True)
class Metric:
    """A metric holds for a valid row without its blocking warnings whose needs hold.

    ``needs`` names other metrics; ``given`` is a condition on row values.
    """

    column: str
    blocked_by: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    given: str = ""


def _metric(name: str, blocked_by=(), needs=(), given="", kind="metric") -> tuple[str, Metric]:
    return name, Metric(f"_is_{name}_{kind}_eligible", tuple(blocked_by), tuple(needs), given)


_TIP_CODES = ", ".join(map(str, TIP_SUPPORTED_PAYMENT_CODES))
METRICS: dict[str, Metric] = dict([
    _metric("trip_volume"),
    _metric("recorded_amount", given="total_amount IS NOT NULL"),
    _metric("route", given="pickup_zone_location_id IS NOT NULL AND dropoff_zone_location_id IS NOT NULL"),
    _metric("distance", ["ZERO_TRIP_DISTANCE"], given="trip_distance > 0"),
    _metric("duration", given="trip_duration_minutes > 0 AND NOT _is_long_trip"),
    _metric(
        "passenger",
        ["FLEX_FARE_PASSENGER_COUNT_MISSING", "PASSENGER_COUNT_MISSING", "NON_POSITIVE_PASSENGER_COUNT"],
    ),
    _metric("rate_code", ["FLEX_FARE_RATE_CODE_MISSING", "RATE_CODE_MISSING_OR_UNMAPPED"]),
    _metric("vendor", ["VENDOR_MISSING_OR_UNMAPPED"]),
    _metric("payment_type", ["PAYMENT_TYPE_MISSING_OR_UNMAPPED"]),
    _metric("financial_breakdown", ["FINANCIAL_RECONCILIATION_GAP"], ["recorded_amount"]),
    _metric("efficiency", needs=["distance", "duration"]),
    _metric(
        "reported_tip",
        ["TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT"],
        ["recorded_amount", "payment_type"],
        f"payment_type IN ({_TIP_CODES})",
    ),
    _metric("ml_distance", needs=["distance"], kind="feature"),
    _metric("ml_passenger", needs=["passenger"], kind="feature"),
    _metric("ml_categorical", needs=["rate_code", "vendor", "payment_type"], kind="feature"),
    _metric("ml_financial", NEGATIVE_CODES, ["financial_breakdown"], kind="feature"),
    _metric(
        "standard_operational",
        ["NEGATIVE_TOTAL_AMOUNT", "DUPLICATE_GROUP_CANONICAL_RECORD"],
        ["efficiency"],
        kind="trip",
    ),
    _metric(
        "ml_standard",
        needs=["standard_operational", "passenger", "ml_financial", "ml_categorical"],
        kind="trip",
    ),
])
#: Metrics every published row must have.
MANDATORY = ("trip_volume", "recorded_amount", "route")


def layers() -> list[list[str]]:
    """Metric names by dependency depth: a layer needs only earlier ones."""
    depth: dict[str, int] = {}

    def of(name: str) -> int:
        if name not in depth:
            depth[name] = 1 + max([of(n) for n in METRICS[name].needs], default=-1)
        return depth[name]

    return [[n for n in METRICS if of(n) == d] for d in range(1 + max(map(of, METRICS)))]


def classified_rule(name: str) -> str:
    """The metric from row flags and the columns of the metrics it needs, never NULL."""
    m = METRICS[name]
    terms = [METRICS[n].column for n in m.needs] or ["NOT _is_quarantined"]
    terms += [f"NOT {FLAG_OF[code]}" for code in m.blocked_by]
    if m.given:
        terms.append(f"coalesce({m.given}, false)")
    return " AND ".join(terms)


def has(codes: Iterable[str], array: str = "_dq_warning_reasons") -> str:
    """Any of the codes is in the array."""
    return f"arrays_overlap({array}, array({', '.join(repr(c) for c in codes)}))"


def published_rule(name: str, prefix: str = "_", values: bool = True) -> str:
    """The metric from published columns: needed metrics, warning codes, and row values if asked."""
    m = METRICS[name]
    terms = [prefix + METRICS[n].column[1:] for n in m.needs]
    if values and m.given:
        terms.append(m.given)
    if m.blocked_by:
        terms.append(f"NOT {has(m.blocked_by, prefix + 'dq_warning_reasons')}")
    return " AND ".join(terms) or "true"


def differs(column: str, formula: str) -> str:
    return f"NOT ({column} <=> ({formula}))"


def breaks(names: Iterable[str], prefix: str = "_") -> str:
    """Some metric of ``names`` is not what the published columns say it should be."""
    return " OR ".join(differs(prefix + METRICS[n].column[1:], published_rule(n, prefix)) for n in names)


def agrees(name: str, prefix: str = "_") -> str:
    """A metric equals the conjunction of what it needs."""
    return f"{prefix}{METRICS[name].column[1:]} = ({published_rule(name, prefix)})"
