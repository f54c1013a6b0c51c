"""CSV zone reader (FAILFAST, header check), partition pruning, zone classification."""

import os
import tempfile

import pytest

from tripmart.sources.trips import read_trips
from tripmart.sources.zones import read_zones, stamp_zone_lookup_lineage
from tripmart.operators.zones import classify_zones


def _csv(text: str) -> str:
    d = tempfile.mkdtemp(prefix="zones-", dir="/tmp")
    path = os.path.join(d, "zones.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_csv_reads_with_schema(spark):
    path = _csv('LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n')
    rows = read_zones(spark, path).orderBy("LocationID").collect()
    assert [r["LocationID"] for r in rows] == [1, 2] and rows[0]["Zone"] == "Newark Airport"


def test_csv_renamed_header_fails(spark):
    path = _csv("Location,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n")
    with pytest.raises(Exception):
        read_zones(spark, path).collect()


def test_csv_non_integer_id_fails(spark):
    path = _csv("LocationID,Borough,Zone,service_zone\nabc,EWR,Newark Airport,EWR\n")
    with pytest.raises(Exception):
        read_zones(spark, path).collect()


def test_zone_classification_reject_all_duplicates(spark):
    path = _csv(
        "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n5,A,B,C\n5,A,D,C\n,A,E,C\n,A,F,C\n"
        "0,A,G,C\n7, ,H,C\n8,A,I,\n"
    )
    z = classify_zones(stamp_zone_lookup_lineage(read_zones(spark, path), path))
    got = {(r["location_id"], r["zone"]): r["_dq_reasons"] for r in z.collect()}
    assert got[(1, "Newark")] == []
    assert got[(5, "B")] == ["DUPLICATE_LOCATION_ID"] and got[(5, "D")] == ["DUPLICATE_LOCATION_ID"]
    assert got[(None, "E")] == ["LOCATION_ID_MISSING", "DUPLICATE_LOCATION_ID"]
    assert got[(0, "G")] == ["LOCATION_ID_NOT_POSITIVE"]
    assert got[(7, "H")] == ["BOROUGH_MISSING"]
    assert got[(8, "I")] == ["SERVICE_ZONE_MISSING"]


def test_partition_filter_prunes(spark):
    d = tempfile.mkdtemp(prefix="trips-", dir="/tmp")
    df = spark.range(20).selectExpr(
        "id AS VendorID", "CAST(2024 + id % 2 AS STRING) AS year", "CAST(1 + id % 12 AS STRING) AS month"
    )
    d = d + "/trips"
    df.write.partitionBy("year", "month").parquet(d)
    trips = read_trips(spark, d, 2025)
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert trips.count() == 10
    assert trips.where("_source_row_id IS NULL").count() == 0
