"""The commit log (versions, conflicts, split layers, clustered fact) and the triggered Bronze refresh stream."""

import glob
import json
import tempfile
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmart.session import fixed_zone
from tripmart.sources.commits import CommitConflict, Store, rows_of
from tripmart.sources.sinks import clustered
from tripmart.streaming.refresh import refresh_bronze_trips


def _tmp() -> str:
    return tempfile.mkdtemp(prefix="sink-", dir="/tmp")


def _content(**layers):
    return {"inputs": "i", "layers": layers, "stale": {}}


def test_split_layer_round_trip(spark, lake):
    store = Store(spark, _tmp())
    rows = lake.trips_classified.drop("_silver_refresh_timestamp", "_eligibility_refresh_timestamp")
    layer, _ = store.write("silver", rows, ("_is_quarantined",))
    store.commit(_content(silver=layer), 0)
    back = Store(spark, store.path).read(store.head()["layers"]["silver"], "silver")
    assert back.columns == rows.columns and back.exceptAll(rows).count() == 0
    assert back.where("NOT _is_quarantined").count() == lake.silver_trips.count()
    assert back.where("_is_quarantined").count() == lake.quarantine_trips.count()


def test_uncommitted_rows_are_not_published_and_old_versions_go(spark):
    store = Store(spark, _tmp())
    layers = [store.write("t", spark.range(n), bounds=("id",))[0] for n in (4, 9, 6)]
    assert store.head()["version"] == 0
    for version, layer in enumerate(layers):
        store.commit(_content(t=layer), version)
        assert store.read(store.head()["layers"]["t"], "t").count() == rows_of(layer)
    assert layers[1]["parts"][0]["low"] == {"id": "0"} and layers[1]["parts"][0]["high"] == {"id": "8"}
    assert store.read(store.at(1)["layers"]["t"], "t").count() == 4
    store.vacuum(keep=2)
    assert store.versions() == [2, 3] and len(store._names("t")) == 2 + len([n for n in store._names("t") if n[0] in "_."])


def test_two_writers_have_one_winner(spark):
    """Eight writers that start from one version at once: one commit stands, whole; the others are refused."""
    path = _tmp()
    results = []

    def write(i):
        store = Store(spark, path)
        try:
            store.commit({"inputs": str(i) * 100_000, "layers": {}, "stale": {}}, 0)
            results.append(i)
        except CommitConflict:
            results.append(None)

    writers = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    won = [r for r in results if r is not None]
    assert len(results) == 8 and len(won) == 1
    head = Store(spark, path).head()
    assert head["version"] == 1 and head["inputs"] == str(won[0]) * 100_000
    with pytest.raises(CommitConflict):
        Store(spark, path).commit(_content(), 0)
    assert Store(spark, path).commit(_content(), 1)["version"] == 2


def test_observed_rules_and_footer_counts(spark):
    store = Store(spark, _tmp())
    layer, seen = store.write("t", spark.range(50).selectExpr("id", "id % 4 = 0 AS flag", "CAST(id % 3 AS STRING) AS k"), ("k", "flag"), {"bad": F.count_if(F.col("id") > 44)})
    assert seen == {"rows": 50, "bad": 5} and rows_of(layer) == 50 and len(layer["parts"]) == 6
    counts = store.counts(layer, "t")
    assert {(r["k"], r["flag"]): r["rows"] for r in counts.collect()}[("0", True)] == 5
    json.dumps(layer)
    empty, seen = store.write("e", spark.range(0))
    assert seen["rows"] == 0 and empty["parts"] == [] and store.read(empty, "e").count() == 0


def test_counts_read_footers_only(spark):
    store = Store(spark, _tmp())
    layer, _ = store.write("t", spark.range(50).selectExpr("id", "id % 3 AS k"), ("k",))
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        plan = store.counts(layer, "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_clustered_fact_round_trip(spark, lake):
    fact = lake.fact_trips.select("source_record_hash", "pickup_date_key", "pickup_zone_key", "total_amount")
    odd = fact.limit(1).selectExpr("source_record_hash", "CAST(NULL AS INT) AS pickup_date_key", "0 AS pickup_zone_key", "total_amount")
    fact = fact.union(odd)
    store = Store(spark, _tmp())
    layer, _ = store.write("fact", clustered(fact, (19980101, 19981231), (1, 265)))
    back = store.read(layer, "fact")
    assert back.count() == fact.count()
    assert back.exceptAll(fact).count() == 0


def test_one_day_and_one_zone_each_skip_most_files(spark):
    """Days of several years, zones of which one holds a third of all rows, and unknown keys."""
    rows = spark.range(200_000).selectExpr(
        "CAST(date_format(date_add(DATE'2023-11-01', CAST(pmod(xxhash64(id), 500) AS INT)), 'yyyyMMdd') AS INT) AS pickup_date_key",
        "CAST(CASE WHEN id % 3 = 0 THEN 132 WHEN id % 1000 = 1 THEN 0 ELSE 1 + pmod(xxhash64(id, 1), 265) END AS INT) AS pickup_zone_key",
        "sha2(CAST(id AS STRING), 256) AS source_record_hash",
    )
    path = _tmp() + "/fact"
    clustered(rows, (20231101, 20250314), (1, 265), files=128).write.parquet(path)
    footers = [pq.ParquetFile(p).metadata for p in glob.glob(path + "/*.parquet")]
    assert len(footers) >= 64

    def bounds(meta, column):
        stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
        return min(s.min for s in stats), max(s.max for s in stats)

    for column, wanted in ((0, (20231224, 20240315, 20250101)), (1, (7, 100, 132, 265))):
        spans = [bounds(meta, column) for meta in footers]
        for value in wanted:
            assert sum(a <= value <= b for a, b in spans) < (0.25 if value != 132 else 0.5) * len(spans), value


def test_zones_that_turn_clocks_are_refused(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name, fits in (("America/New_York", False), ("Etc/UTC", True), ("+02:00", True), ("Z", True)):
            spark.conf.set("spark.sql.session.timeZone", name)
            if fits:
                assert fixed_zone(spark)
            else:
                with pytest.raises(ValueError, match="fixed offset"):
                    fixed_zone(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_triggered_refresh_takes_each_file_once(spark, lake):
    landing, target, ckpt = _tmp() + "/landing", _tmp() + "/bronze", _tmp() + "/ckpt"
    raw = lake.raw_trips.drop("_source_row_id")
    raw.write.partitionBy("year", "month").parquet(landing)
    schema = spark.read.parquet(landing).schema
    for _ in range(2):
        q = refresh_bronze_trips(spark, landing, schema, target, ckpt, 1998, "test")
        q.awaitTermination(300)
    assert spark.read.parquet(target).count() == lake.bronze_trips.count()
