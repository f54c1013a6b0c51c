"""Whole-pipeline properties on the sf0.001 binding, a negative control, dedup under skew."""

import datetime as dt

from pyspark.sql import functions as F

from trip_rows import classify, clean
from tripmart.operators.checks import ExpectationError, check_report, combine, count_where, enforce, stats
from tripmart.operators.dedup import duplicate_groups, flag_duplicates, number_duplicates
from tripmart.plans import validation
from tripmart.plans.expectations import silver_expectations


def test_split_is_a_partition(lake):
    bronze = lake.bronze_trips.count()
    silver, quarantine = lake.silver_trips.count(), lake.quarantine_trips.count()
    assert bronze == silver + quarantine and silver > 0 and quarantine > 0
    assert lake.silver_trips.where("size(_dq_reasons) > 0").count() == 0
    assert lake.quarantine_trips.where("size(_dq_reasons) = 0").count() == 0


def test_status_agrees_with_reasons(lake):
    bad = lake.trips_classified.where(
        "(_eligibility_status = 'FULLY_ELIGIBLE' AND _eligibility_restriction_count <> 0)"
        " OR (_requires_data_review <> (_eligibility_status = 'REVIEW_REQUIRED'))"
        " OR _dq_warning_count <> size(_dq_warning_reasons)"
    )
    assert bad.count() == 0


def test_one_survivor_per_duplicate_group(lake):
    survivors = lake.trips_classified.where("_is_duplicate_group AND NOT _is_duplicate_record")
    groups = lake.trips_classified.where("_is_duplicate_group").select("record_hash").distinct()
    assert survivors.count() == groups.count() > 0
    assert lake.silver_trips.groupBy("record_hash").count().where("count > 1").count() == 0


def test_silver_expectations_hold_and_enforce(lake):
    enforce(lake.silver_trips, silver_expectations(lake.cfg))
    try:
        enforce(lake.trips_classified, silver_expectations(lake.cfg))
    except ExpectationError as exc:
        assert "only_valid_silver_records" in str(exc)
    else:
        raise AssertionError("quarantined rows must break the Silver expectations")


def test_silver_report_passes_then_fails_on_corruption(lake):
    report = {r["validation_name"]: r for r in validation.silver_validation(lake).collect()}
    assert len(report) == 21
    assert all(r["status"] != "FAIL" for r in report.values())
    # Negative control: a published row that lost its warning code.
    corrupt = lake.silver_trips.withColumn(
        "_dq_warning_count", F.when(F.col("_dq_warning_count") > 0, F.col("_dq_warning_count") + 1)
        .otherwise(F.col("_dq_warning_count"))
    )
    one = combine(
        count_where(validation.closed(corrupt), "silver_record_count", validation.silver_predicates(lake.cfg)),
        stats(corrupt, [("distinct_record_hash_count", "COUNT(DISTINCT record_hash)")]),
        stats(lake.bronze_trips, [("bronze_record_count", "COUNT(*)")]),
        validation.quarantine_contract_counts(lake),
    )
    broken = {r["validation_name"]: r for r in check_report(one, validation.SILVER_CHECKS).collect()}
    assert broken["warning_array_count_and_flag"]["status"] == "FAIL"
    assert broken["warning_array_count_and_flag"]["exception_record_count"] > 0


def test_hot_duplicate_group_has_one_canonical_row(spark):
    hot = [clean() for _ in range(400)] + [clean(passenger_count=p) for p in range(2, 6)]
    rows = classify(spark, hot).collect()
    group = [r for r in rows if r["passenger_count"] == 1]
    assert len(group) == 400
    assert sum(not r["_is_duplicate_record"] for r in group) == 1
    assert {r["_duplicate_record_count"] for r in group} == {400}


def test_occurrence_numbers_are_exact_under_salting(spark):
    df = spark.range(5000).selectExpr(
        "CASE WHEN id < 3000 THEN 'ff' ELSE lpad(hex(id % 700), 4, '0') END AS k", "id AS _source_row_id"
    )
    numbered = number_duplicates(flag_duplicates(df, duplicate_groups(df, "k"), key="k"), key="k", salt_buckets=16)
    counts = {r["k"]: (r["n"], r["lo"], r["hi"], r["d"]) for r in numbered.groupBy("k").agg(
        F.count("*").alias("n"), F.min("_duplicate_occurrence_number").alias("lo"),
        F.max("_duplicate_occurrence_number").alias("hi"),
        F.count_distinct("_duplicate_occurrence_number").alias("d")).collect()}
    assert counts["ff"] == (3000, 1, 3000, 3000)
    assert all(v[0] == v[2] == v[3] and v[1] == 1 for v in counts.values())
    first = numbered.where("k = 'ff' AND _duplicate_occurrence_number = 1").collect()
    assert len(first) == 1 and first[0]["_source_row_id"] == 0 and not first[0]["_is_duplicate_record"]


def test_classification_plan_has_no_window_on_the_hash(spark):
    plan = classify(spark, [clean()])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_hot_group_cells_grow_with_group_size(spark):
    # With 50 rows per cell the hot key (3000 rows) is cut into about 60 cells,
    # small keys keep the minimum of 2; numbering stays exact and dense.
    df = spark.range(5000).selectExpr(
        "CASE WHEN id < 3000 THEN 'ff' ELSE lpad(hex(id % 700), 4, '0') END AS k", "id AS _source_row_id"
    )
    flagged = flag_duplicates(df, duplicate_groups(df, "k"), key="k")
    numbered = number_duplicates(flagged, key="k", salt_buckets=2, cell_rows=50)
    hot = numbered.where("k = 'ff'")
    assert hot.select(F.count_distinct("_duplicate_occurrence_number")).first()[0] == 3000
    assert hot.agg(F.min("_duplicate_occurrence_number"), F.max("_duplicate_occurrence_number")).first() == (1, 3000)
    cells = (
        flagged.where("k = 'ff' AND _is_duplicate_record")
        .select(F.pmod(F.xxhash64("_source_row_id"), F.lit(60)).alias("c"))
        .groupBy("c").count()
    )
    assert cells.count() == 60 and cells.agg(F.max("count")).first()[0] < 120
