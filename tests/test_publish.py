"""Shared folder, refresh and invalidation, checks before publication, contract settings."""

import os
import pathlib
import shutil
import tempfile
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trip_rows import classify, clean
from tripmart.config import FIXTURE_CONFIG, RunConfig
from tripmart.operators.checks import ExpectationError, count_where
from tripmart.operators.dedup import duplicate_groups, flag_duplicates
from tripmart.operators.lookup import materialize
from tripmart.operators.resolve import Field, MissingColumns, resolve
from tripmart.plans import gold_validation, validation
from tripmart.plans.lake import Lake
from tripmart.session import checkpoint_dir, is_one_machine
from tripmart.sources import commits
from tripmart.sources.commits import CommitConflict, Store

SMALL = "/root/testdata/sf0.001"


def test_a_cluster_without_a_shared_folder_is_refused():
    assert is_one_machine("local") and is_one_machine("local[8]")
    assert not is_one_machine("local-cluster[2,1,1024]") and not is_one_machine("spark://host:7077")
    settings = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: settings, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=settings))


def test_layers_go_to_the_folder_of_the_run(spark):
    folder = tempfile.mkdtemp(prefix="lake-", dir="/tmp")
    assert materialize(spark.range(3), folder=folder).inputFiles()[0].startswith(f"file://{folder}/tables/")


def _input(spark, lines=None) -> str:
    """A folder with the small input tables (contents only, not the modes of a read-only folder)."""
    folder = tempfile.mkdtemp(prefix="input-", dir="/tmp")
    for name in os.listdir(SMALL):
        shutil.copyfile(f"{SMALL}/{name}", f"{folder}/{name}")
    if lines is not None:
        _replace_lines(spark, folder, lines)
    return folder


def _replace_lines(spark, folder, lines) -> None:
    aside = tempfile.mkdtemp(prefix="lines-", dir="/tmp")
    lines.coalesce(1).write.mode("overwrite").parquet(aside)
    new = next(p.path for p in os.scandir(aside) if p.name.endswith(".parquet"))
    shutil.copyfile(new, f"{folder}/lineitem.parquet")


def _settings(**changed) -> RunConfig:
    folder = tempfile.mkdtemp(prefix="lake-", dir="/tmp")
    return RunConfig(**{**FIXTURE_CONFIG.__dict__, "shared_folder": folder, **changed})


def test_changed_input_gives_changed_answers(spark):
    folder = _input(spark)
    before = Lake.of_run(spark, folder)
    assert Lake.of_run(spark, folder) is before
    rows = before.raw_trips.count()
    _replace_lines(spark, folder, spark.read.parquet(f"{SMALL}/lineitem.parquet").filter("l_orderkey % 2 = 0"))
    after = Lake.of_run(spark, folder)
    assert after is not before and 0 < after.raw_trips.count() < rows


def test_another_session_reads_what_one_published(spark, monkeypatch):
    cfg = _settings()
    first = Lake(spark, SMALL, cfg).refresh()
    kpi = first.fact_trips.agg(F.sum("total_amount")).first()
    other = Lake(spark.newSession(), SMALL, cfg)
    monkeypatch.setattr(Lake, "publish", lambda *a, **k: pytest.fail("written again"))
    assert other._version == first._version == 1
    assert other.fact_trips.agg(F.sum("total_amount")).first() == kpi
    for name in Lake.PUBLISHED:
        assert sorted(getattr(other, name).inputFiles()) == sorted(getattr(first, name).inputFiles())


def test_a_failed_or_beaten_refresh_leaves_the_version_in_use(spark, monkeypatch):
    cfg = _settings()
    lake = Lake(spark, SMALL, cfg).refresh()
    rows, version = lake.fact_trips.count(), lake._version
    files = set(lake.fact_trips.inputFiles())
    lake.refresh(whole=True)
    assert lake._version == version + 1 and not files & set(lake.fact_trips.inputFiles()) and lake.fact_trips.count() == rows
    on_disk = {str(p) for p in pathlib.Path(cfg.shared_folder).rglob("v=*")}
    from tripmart.plans import expectations

    monkeypatch.setitem(expectations._ENFORCED, "fact_trips", [("true", lambda cfg: {"never": "false"})])
    with pytest.raises(ExpectationError, match="never"):
        lake.refresh(whole=True)
    monkeypatch.undo()
    assert Lake(spark, SMALL, cfg)._version == lake._version and lake.fact_trips.count() == rows
    # Another writer commits between this refresh's start and its end.
    commit = Store.commit

    def beaten(store, content, parent):
        monkeypatch.setattr(Store, "commit", commit)
        commit(store, store.head(), parent)
        return commit(store, content, parent)

    monkeypatch.setattr(Store, "commit", beaten)
    with pytest.raises(CommitConflict):
        lake.refresh(whole=True)
    assert Lake(spark, SMALL, cfg)._version == lake._version + 1
    assert {str(p) for p in pathlib.Path(cfg.shared_folder).rglob("v=*")} == on_disk and lake.fact_trips.count() == rows


def test_a_month_that_arrives_is_the_only_one_rewritten(spark):
    """The year in two parts: lines of other months first; then all; then half of one month more is taken away."""
    from __spark_entry__ import queries
    from oracle_check import compare, duck

    lines, orders = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("lineitem", "orders"))
    late = orders.filter("year(o_orderdate) = 1998 AND month(o_orderdate) = 4").select("o_orderkey")
    early = lines.join(late, lines.l_orderkey == late.o_orderkey, "left_anti")
    folder, cfg = _input(spark, early), _settings()
    lake = Lake(spark, folder, cfg).refresh()
    monthly = ("raw_trips", "bronze_trips", "duplicate_groups", "trips_classified", "fact_trips")
    before = {n: {p["folder"] for p in lake._layers[n]["parts"]} for n in monthly}
    _replace_lines(spark, folder, lines)
    lake.refresh()
    for name in monthly:
        new = [p for p in lake._layers[name]["parts"] if p["folder"] not in before[name]]
        months = {tuple(map(int, list(p["values"].values())[:2])) for p in new}
        # Dirty rows carry a neighbouring month or move to the year's end.
        assert (1998, 4) in months or name == "duplicate_groups"
        assert months <= {(1998, 4), (1998, 5), (1998, 12)}, (name, months)
    anew = Lake(spark, folder, _settings()).refresh()
    for name in ("bronze_trips", "trips_classified", "silver_baseline", "dim_date", "fact_trips"):
        drop = [c for c in getattr(lake, name).columns if c.endswith("_timestamp") or c == "_ingested_at"]
        mine, theirs = (getattr(x, name).drop(*drop) for x in (lake, anew))
        assert mine.count() == theirs.count() and mine.exceptAll(theirs).count() == 0, name
    monkey = pytest.MonkeyPatch()
    monkey.setattr(Lake, "of_run", classmethod(lambda cls, *a: lake))
    try:
        con = duck(folder)
        from __spark_entry__ import oracle_sql

        for key in ("trip_duplicates", "silver_trips", "fact_trips", "bronze_reconciliation", "gold_validation"):
            ok, msg = compare(queries()[key](spark, folder).toPandas(), con.sql(oracle_sql()[key]).df())
            assert ok, (key, msg)
    finally:
        monkey.undo()


def test_publishing_reads_no_written_copy(spark, monkeypatch):
    """Rules are observed while rows are written: no pass over a copy checks them."""
    from tripmart.plans import lake as module

    monkeypatch.setattr(module, "enforce", lambda *a: pytest.fail("a pass over written rows"))
    lake = Lake(spark, SMALL, _settings()).refresh()
    assert set(lake._layers) == set(Lake.PUBLISHED)


@pytest.mark.parametrize(
    "layer, column, value, expectation",
    [
        ("trips_classified", "_eligibility_restriction_count", "99", "eligibility_reason_count_consistent"),
        ("trips_classified", "_dq_reasons", "array('X')", "critical_reason_array_empty"),
        ("gold_trip_source", "quality_rule_version", "'1.0'", "source_quality_rule_is_supported"),
        ("dim_date", "calendar_year_role", "'OTHER'", "calendar_year_role_is_valid"),
        ("fact_trips", "pickup_zone_key", "0", "pickup_zone_resolved"),
        ("silver_zones", "_is_quarantined", "true", "only_valid_silver_records"),
        ("quarantine_zones", "_is_quarantined", "false", "only_quarantined_records"),
    ],
)
def test_corrupted_layers_are_not_published(lake, layer, column, value, expectation):
    good, version = getattr(lake, layer), lake._version
    bad = good.withColumn(column, F.expr(value))
    with pytest.raises(ExpectationError, match=expectation):
        lake.publish(layer, bad)
    assert getattr(lake, layer) is good and lake._version == version == lake.store.head()["version"]


@pytest.mark.parametrize("zones", ["silver_zones", "quarantine_zones"])
def test_zones_are_enforced_on_first_read(spark, monkeypatch, zones):
    from tripmart.plans import expectations

    monkeypatch.setitem(expectations._ENFORCED, zones, [("true", lambda cfg: {"never": "false"})])
    with pytest.raises(ExpectationError, match="never"):
        getattr(Lake(spark, SMALL, _settings()), zones)


def test_the_rules_of_the_gold_source_stop_the_fact(spark, monkeypatch):
    from tripmart.plans import expectations

    lake = Lake(spark, SMALL, _settings())
    lake.dim_dropoff_zone, lake.dim_pickup_zone, lake.dim_date
    monkeypatch.setitem(expectations._ENFORCED, "gold_trip_source", [("true", lambda cfg: {"few": "source_month < 6"})])
    with pytest.raises(ExpectationError, match="few"):
        lake.fact_trips
    with pytest.raises(ExpectationError, match="few"):
        lake.gold_trip_source


def test_quarantine_rows_need_a_reason(lake):
    bad = lake.trips_classified.withColumn("_dq_reasons", F.expr("IF(_is_quarantined, array(), _dq_reasons)"))
    with pytest.raises(ExpectationError, match="critical_reason_present"):
        lake.publish("trips_classified", bad)


def test_null_arrays_count_as_empty_ones(spark):
    """Rows that lost their warning array: no count mismatch at 0, but their missing warnings show."""
    trips = classify(spark, [clean(passenger_count=None) for _ in range(3)] + [clean(trip_distance=2.0)])
    lost = trips.filter("passenger_count IS NULL AND NOT _is_duplicate_record").withColumns(
        {"_dq_warning_reasons": F.lit(None).cast("array<string>"), "_dq_warning_count": F.lit(0), "_has_dq_warnings": F.lit(False)}
    )
    got = count_where(validation.closed(lost), "n", validation.silver_predicates(RunConfig())).first()
    assert got["n"] == 1 and got["warning_count_mismatch_count"] == 0 == got["warning_flag_mismatch_count"]
    assert got["unexpected_passenger_warning_mismatch_count"] == 1
    no_reasons = trips.withColumn("_dq_reasons", F.lit(None).cast("array<string>"))
    got = count_where(validation.closed(no_reasons), "n", validation.silver_predicates(RunConfig())).first()
    assert got["silver_critical_reason_count"] == got["n"] == 4


def test_reports_follow_the_settings(lake):
    strict = RunConfig(**{**FIXTURE_CONFIG.__dict__, "financial_tolerance": "0.00", "quality_rule_version": "3.0"})
    silver = count_where(validation.closed(lake.silver_trips), "n", validation.silver_predicates(strict)).first()
    assert silver["invalid_quality_rule_version_count"] == silver["n"] > 0
    loose = RunConfig(**{**FIXTURE_CONFIG.__dict__, "financial_tolerance": "100.00"})
    fact = count_where(lake.fact_trips, "n", gold_validation.fact_predicates(loose)).first()
    assert fact["financial_contract_mismatch_count"] == fact["financially_unreconciled_records"] > 0


def test_hot_group_without_the_broadcast_of_all_groups(spark):
    """A third of the rows share one hash; only that group is broadcast, the others are shuffled."""
    df = spark.range(3000).selectExpr(
        "sha2(CAST(IF(id % 3 = 0, -1, id % 500) AS STRING), 256) AS _record_hash", "id AS _source_row_id"
    )
    groups = duplicate_groups(df)
    wanted = flag_duplicates(df, groups)
    got = flag_duplicates(df, groups, max_bytes=0, hot_rows=500)
    assert got.columns == wanted.columns and got.count() == 3000
    assert got.exceptAll(wanted).count() == 0
    assert got.filter("_duplicate_record_count = 1000 AND NOT _is_duplicate_record").count() == 1


def test_a_contract_reports_all_absent_columns_at_once():
    contract = [Field(("a", "A2"), "a", "int"), Field(("b",), "b", "int"), Field(("c",), "c", "int", False, "0")]
    assert resolve(["a2", "B", "A"], contract) == {"a": "A", "b": "B", "c": None}
    with pytest.raises(MissingColumns, match="a .any of a, A2.; b"):
        resolve(["x"], contract)


def _tasks_of(layer: dict) -> int:
    """Tasks that wrote a layer, as the names of its files tell."""
    return len({name.split("-")[1] for part in layer["parts"] for name, _ in part["files"]})


def test_tasks_of_a_layer_grow_in_number_with_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "TASK_VALUES", 2000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layer, _ = Store(spark, str(tmp_path)).write("rows", spark.range(20_000).selectExpr("id", "-id AS b").repartition("b"), rows_in=20_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert _tasks_of(layer) == 20 > int(before) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_layers_know_what_they_are_made_from(spark):
    lake = Lake(spark, SMALL, _settings())
    assert lake._read_for("raw_trips")[0] == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    rows, size = lake.raw_trips.count(), sum(os.path.getsize(f.removeprefix("file://")) for f in lake.raw_trips.inputFiles())
    assert lake._read_for("bronze_trips") == (rows, size)


def test_scans_for_a_layer_are_cut_by_rows(spark):
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with commits.sized_tasks(spark, 40 << 20, 1 << 30, 104):
        few = int(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    with commits.sized_tasks(spark, 1000, 100_000, 104):
        small = int(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    assert few * (40 << 20) / (1 << 30) * 104 <= commits.TASK_VALUES
    assert small <= 128 << 20 and spark.conf.get("spark.sql.files.maxPartitionBytes") == held


def test_a_file_of_a_layer_can_be_read_by_many_tasks(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.range(0, 3_000_000, 1, 1).select("id", F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    layer, _ = store.write("wide", rows)
    (file,) = [f"{tmp_path}/{layer['parts'][0]['folder']}/{name}" for name, _ in layer["parts"][0]["files"]]
    assert pq.ParquetFile(file).metadata.num_row_groups > 2


def test_wide_rows_are_made_by_code_that_the_jvm_compiles(spark):
    """The JVM interprets methods of more than 8,000 bytes: stages with such code run operator by operator in a write."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = int(spark.conf.get(limit))
    with commits.sized_tasks(spark, 0, 0, 1):
        assert int(spark.conf.get(limit)) == 8000 < before
    assert int(spark.conf.get(limit)) == before
