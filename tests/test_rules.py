"""One minimal row per rule at its boundary (critical reasons, flags, warnings, eligibility)."""

import datetime as dt

import pytest

from trip_rows import PICKUP, classify, clean


def one(spark, **over):
    rows = classify(spark, [clean(**over)]).collect()
    assert len(rows) == 1
    return rows[0]


def test_clean_trip_is_fully_eligible(spark):
    r = one(spark)
    assert r["_dq_reasons"] == [] and not r["_is_quarantined"]
    assert r["_dq_warning_reasons"] == []
    assert r["_eligibility_status"] == "FULLY_ELIGIBLE"
    assert r["_eligibility_restriction_count"] == 0
    assert r["trip_duration_minutes"] == 20.0
    assert r["pickup_day_of_week"] == 2  # Monday, Sunday = 1


@pytest.mark.parametrize(
    "seconds, reason",
    [(0, "INVALID_TRIP_PERIOD"), (-1, "INVALID_TRIP_PERIOD"), (360 * 60, None),
     (360 * 60 + 1, "TRIP_DURATION_EXCEEDS_LIMIT")],
)
def test_duration_boundaries(spark, seconds, reason):
    r = one(spark, tpep_dropoff_datetime=PICKUP + dt.timedelta(seconds=seconds))
    assert (reason in r["_dq_reasons"]) if reason else r["_dq_reasons"] == []


@pytest.mark.parametrize(
    "distance, critical, warning",
    [(None, "TRIP_DISTANCE_MISSING", None), (-0.001, "NEGATIVE_TRIP_DISTANCE", None),
     (0.0, None, "ZERO_TRIP_DISTANCE"), (0.001, None, None)],
)
def test_distance(spark, distance, critical, warning):
    r = one(spark, trip_distance=distance)
    assert (critical in r["_dq_reasons"]) if critical else r["_dq_reasons"] == []
    assert (warning in r["_dq_warning_reasons"]) if warning else "ZERO_TRIP_DISTANCE" not in r["_dq_warning_reasons"]


def test_passengers(spark):
    flex = one(spark, passenger_count=None, payment_type=0, tip_amount=0.0, total_amount=25.0)
    assert "FLEX_FARE_PASSENGER_COUNT_MISSING" in flex["_dq_warning_reasons"]
    assert flex["_passenger_data_status"] == "EXPECTED_FLEX_FARE_MISSING"
    missing = one(spark, passenger_count=None)
    assert "PASSENGER_COUNT_MISSING" in missing["_dq_warning_reasons"]
    assert missing["_requires_data_review"] and missing["_eligibility_status"] == "REVIEW_REQUIRED"
    neg = one(spark, passenger_count=-1)
    assert "NEGATIVE_PASSENGER_COUNT" in neg["_dq_reasons"] and neg["_is_quarantined"]
    zero = one(spark, passenger_count=0)
    assert "NON_POSITIVE_PASSENGER_COUNT" in zero["_dq_warning_reasons"]
    assert zero["_passenger_data_status"] == "ZERO_REPORTED"


@pytest.mark.parametrize("total, gap", [(29.0, False), (29.01, False), (29.02, True)])
def test_reconciliation_tolerance_is_strict(spark, total, gap):
    r = one(spark, total_amount=total)
    assert r["_is_financially_unreconciled"] is gap
    assert ("FINANCIAL_RECONCILIATION_GAP" in r["_dq_warning_reasons"]) is gap


def test_null_total_is_critical(spark):
    assert "TOTAL_AMOUNT_MISSING" in one(spark, total_amount=None)["_dq_reasons"]


@pytest.mark.parametrize(
    "over, warning",
    [({"VendorID": None}, "VENDOR_MISSING_OR_UNMAPPED"), ({"VendorID": 3}, "VENDOR_MISSING_OR_UNMAPPED"),
     ({"RatecodeID": None}, "RATE_CODE_MISSING_OR_UNMAPPED"), ({"RatecodeID": 7}, "RATE_CODE_MISSING_OR_UNMAPPED"),
     ({"payment_type": 9, "tip_amount": 0.0, "total_amount": 25.0}, "PAYMENT_TYPE_MISSING_OR_UNMAPPED"),
     ({"payment_type": 2}, "TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT"),
     ({"payment_type": None}, "TIP_REPORTED_OUTSIDE_SUPPORTED_PAYMENT"),
     ({"payment_type": 0, "RatecodeID": None}, "FLEX_FARE_RATE_CODE_MISSING")],
)
def test_code_warnings(spark, over, warning):
    assert warning in one(spark, **over)["_dq_warning_reasons"]


def test_valid_codes_raise_nothing(spark):
    assert one(spark, RatecodeID=99, VendorID=7)["_dq_warning_reasons"] == []


def test_cash_is_never_fully_eligible(spark):
    r = one(spark, payment_type=2, tip_amount=0.0, total_amount=25.0)
    assert r["_dq_warning_reasons"] == []
    assert "REPORTED_TIP_METRICS_INELIGIBLE" in r["_eligibility_reasons"]
    assert r["_eligibility_status"] == "PARTIALLY_ELIGIBLE"


def test_year_and_partition(spark):
    cross = one(spark, tpep_pickup_datetime=dt.datetime(2025, 12, 31, 23, 50),
                tpep_dropoff_datetime=dt.datetime(2026, 1, 1, 0, 20), month="12")
    assert cross["_dq_reasons"] == [] and "CROSS_YEAR_TRIP" in cross["_dq_warning_reasons"]
    assert cross["_requires_gold_date_extension"]
    wrong = one(spark, tpep_pickup_datetime=dt.datetime(2024, 3, 10, 8, 0),
                tpep_dropoff_datetime=dt.datetime(2024, 3, 10, 8, 20), year="2025")
    assert "PICKUP_OUTSIDE_EXPECTED_YEAR" in wrong["_dq_reasons"]
    shifted = one(spark, month="4")
    assert shifted["_dq_reasons"] == ["SOURCE_PARTITION_MISMATCH"]


def test_zone_resolution(spark):
    unknown = one(spark, PULocationID=999)
    assert "PICKUP_LOCATION_NOT_RESOLVED" in unknown["_dq_reasons"]
    missing = one(spark, DOLocationID=None)
    assert missing["_dq_reasons"] == ["DROPOFF_LOCATION_MISSING"]


def test_reason_order_is_declaration_order(spark):
    r = one(spark, tpep_pickup_datetime=None, trip_distance=None, total_amount=None)
    assert r["_dq_reasons"] == ["PICKUP_TIMESTAMP_MISSING", "TRIP_DISTANCE_MISSING", "TOTAL_AMOUNT_MISSING"]


def test_duplicates_keep_one(spark):
    rows = classify(spark, [clean(), clean(), clean(), clean(passenger_count=2)]).collect()
    group = [r for r in rows if r["passenger_count"] == 1]
    assert len(group) == 3
    assert sum(not r["_is_duplicate_record"] for r in group) == 1
    assert all(r["_duplicate_record_count"] == 3 and r["_is_duplicate_group"] for r in group)
    canonical = [r for r in group if not r["_is_duplicate_record"]][0]
    assert "DUPLICATE_GROUP_CANONICAL_RECORD" in canonical["_dq_warning_reasons"]
    assert all(r["_dq_reasons"] == ["DUPLICATE_TRIP_RECORD"] for r in group if r["_is_duplicate_record"])
    other = [r for r in rows if r["passenger_count"] == 2][0]
    assert not other["_is_duplicate_group"] and other["_duplicate_record_count"] == 1


def test_store_flag_normalised(spark):
    assert one(spark, store_and_fwd_flag=" y ")["store_and_fwd_flag"] == "Y"
    assert one(spark, store_and_fwd_flag=None)["store_and_fwd_flag"] is None
