"""Physical-plan properties of the published layers."""

from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_reads_only_its_partition(lake):
    plan = _plan(lake.silver_trips)
    assert "PartitionFilters: [isnotnull(_is_quarantined" in plan and "NOT _is_quarantined" in plan
    quarantine = _plan(lake.quarantine_trips)
    assert "PartitionFilters: [isnotnull(_is_quarantined" in quarantine


def test_fact_consumers_scan_only_projected_columns(lake):
    plan = _plan(lake.fact_trips.groupBy("payment_type_key").agg(F.sum("total_amount")))
    read = plan[plan.index("ReadSchema: ") :].split("\n")[0]
    assert "payment_type_key" in read and "total_amount" in read
    assert "pickup_datetime" not in read


def test_reports_use_no_cross_join(lake):
    from tripmart.plans import gold_validation, validation

    for df in (validation.silver_validation(lake), gold_validation.gold_validation(lake)):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_one_source_year_is_read_by_partition(lake):
    from tripmart.sources.trips import bronze_trips

    plan = _plan(bronze_trips(lake.raw_trips, lake.cfg.expected_pickup_year, "t"))
    assert "PartitionFilters: [isnotnull(year" in plan and "Join" not in plan


def test_duplicate_groups_are_not_sorted(spark):
    df = spark.range(10).selectExpr("sha2(CAST(id % 3 AS STRING), 256) AS _record_hash", "id AS _source_row_id")
    groups = df.groupBy(F.unhex("_record_hash")).agg(F.count("*"), F.min("_source_row_id"))
    assert "SortAggregate" not in _plan(groups) and "HashAggregate" in _plan(groups)


def _scans(plan: str) -> list[list[str]]:
    """Columns read by each file scan."""
    return [line.split("ReadSchema: struct<")[1].split(">")[0].split(",") for line in plan.split("\n") if "ReadSchema: struct<" in line]


def test_gold_report_scans_each_layer_few_times(lake):
    """The wide passes are the fact's counters and the parity of both sides (digests, and rows where they differ)."""
    from tripmart.plans import gold_validation

    wide = [tuple(columns) for columns in _scans(_plan(gold_validation.gold_validation(lake))) if len(columns) > 3]
    fact = {c for c in wide if any(x.startswith("source_record_hash") for x in c)}
    silver = {c for c in wide if any(x.startswith("record_hash") for x in c)}
    assert len(fact) <= 2 and len(silver) <= 1


def _exchanged(df) -> list[int]:
    """Rows that each shuffle of an executed plan wrote."""
    df.collect()
    metrics = []

    def walk(node):
        if "ShuffleExchange" in node.getClass().getSimpleName():
            metrics.append(node.metrics().apply("shuffleRecordsWritten").value())
        for kind in ("AdaptiveSparkPlan", "QueryStage"):
            if kind in node.getClass().getSimpleName():
                walk(node.executedPlan() if kind == "AdaptiveSparkPlan" else node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return metrics


def test_parity_shuffles_no_rows_of_equal_layers(lake, monkeypatch):
    """On equal data one digest a bucket and task crosses a shuffle; rows do only where a bucket differs."""
    from types import SimpleNamespace

    from tripmart.plans import gold_validation
    from tripmart.plans.gold_validation import gold_record_parity

    fact, silver = lake.fact_trips, lake.silver_trips
    assert set(gold_record_parity(lake).first()) == {0}
    victim = fact.first()["source_record_hash"]
    bad = fact.withColumn("dq_warning_count", F.expr(f"IF(source_record_hash = '{victim}', 77, dq_warning_count)"))
    found = gold_record_parity(SimpleNamespace(fact_trips=bad, silver_trips=silver)).first().asDict()
    assert found.pop("warning_propagation_mismatch_count") == 1 and set(found.values()) == {0}
    lost = SimpleNamespace(fact_trips=fact, silver_trips=silver.where("pickup_hour <> 3"))
    missing = gold_record_parity(lost).first()["fact_without_silver_record_count"]
    assert missing == fact.where("pickup_time_key = 3").count() > 0
    monkeypatch.setattr(gold_validation, "PARITY_BUCKETS", 3)
    assert sum(_exchanged(gold_record_parity(lake))) < fact.count() / 3


def test_reports_on_states_read_no_fact(lake):
    """KPIs, the route estimate and the foreign keys read the states by month; reconciliation reads footers."""
    from tripmart.plans import gold_validation, inventory, reports

    for report in (
        inventory.kpi_by_payment_type, inventory.kpi_by_rate_code, inventory.kpi_by_airport, inventory.kpi_by_route,
        inventory.kpi_baseline, inventory.fact_routes_approx, gold_validation.gold_foreign_keys,
    ):
        plan = _plan(report(lake))
        assert "/fact_trips/" not in plan and ("/fact_states/" in plan or "/fact_members/" in plan), report.__name__
    plan = _plan(reports.bronze_reconciliation(lake))
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2, plan


def test_orphans_are_found_in_the_members(spark, lake):
    from types import SimpleNamespace

    from tripmart.plans.gold_validation import FOREIGN_KEYS, gold_foreign_keys
    from tripmart.plans.states import fact_members

    assert set(gold_foreign_keys(lake).first()) == {0}
    bad = lake.fact_trips.withColumn("vendor_key", F.expr("IF(pickup_time_key = 5, 4711, vendor_key)"))
    members = fact_members(bad, [k.fact for k in FOREIGN_KEYS])
    one = SimpleNamespace(fact_members=members, dimension=lake.dimension, dimension_rows=lake.dimension_rows)
    found = gold_foreign_keys(one).first().asDict()
    counter = next(k.counter for k in FOREIGN_KEYS if k.fact == "vendor_key")
    assert found.pop(counter) == lake.fact_trips.where("pickup_time_key = 5").count() > 0 and set(found.values()) == {0}
