"""Binding of the driver's TPC-H-like tables to the raw trip and zone shapes.

The test data has no taxi trips, so a raw trip table is derived by a pure
column mapping of ``lineitem ⋈ orders ⋈ customer ⋈ supplier`` and a zone
lookup from ``nation ⋈ region``. A deterministic bucket ``h`` of each line
injects dirty values so that every quality rule fires on some rows. The
mapping is documented in FIXTURES.md §3 and mirrored by the SQL oracle.

Everything is a lazy DataFrame: the raw table is as large as ``lineitem``
(plus duplicated lines), so its work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.inline import inline_rows

# ---------------------------------------------------------------------------
# Fixed values of the fixture binding (FIXTURES.md §3).
FIXTURE_VENDORS = (1, 2, 6, 7)
FIXTURE_RATE_CODES = (1, 2, 3, 4, 5, 6, 99)
FIXTURE_AIRPORT_PICKUPS = (132, 138)
# Dirty zone rows appended to the nation-derived lookup:
# (LocationID, Borough, Zone, service_zone)
FIXTURE_DIRTY_ZONES = [
    (300, "EUROPE", "DUPLICATE_A", "Z0"),
    (300, "EUROPE", "DUPLICATE_B", "Z1"),
    (None, "ASIA", "NO_ID_A", "Z2"),
    (None, "ASIA", "NO_ID_B", "Z0"),
    (0, "AFRICA", "ZERO_ID", "Z1"),
    (301, "  ", "BLANK_BOROUGH", "Z2"),
    (302, "AMERICA", "NO_SERVICE_ZONE", None),
]
# ---------------------------------------------------------------------------

RAW_ZONE_DDL = "LocationID int, Borough string, Zone string, service_zone string"


#: Input tables the binding reads.
INPUTS = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files, by the file system the paths name."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            files = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files]
    return "\n".join(sorted(found))


def _pick(values: tuple, index: Column) -> Column:
    """``values[index]`` for a fixed tuple (0-based index)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def _location(nation_key: Column) -> Column:
    return F.when(nation_key == 0, F.lit(1)).otherwise(nation_key + 120)


def raw_lines(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the table that trips are derived from, as its footers say."""
    return _table(spark, sf_dir, "lineitem").count()


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip records (source column names and physical types)."""
    # Spread before the joins: the per-line work (joins, dirty buckets, the
    # wide projection) then runs on every core even for a one-row-group file.
    line = spread(
        _table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
        ),
        "l_orderkey",
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    base = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    h = F.col("h")

    def bucket(lo: int, hi: int) -> Column:
        return h.between(lo, hi)

    hashed = base.withColumn(
        "h",
        (
            7 * F.col("l_orderkey")
            + 13 * F.col("l_partkey")
            + 3 * F.col("l_suppkey")
            + 31 * F.col("l_linenumber")
        )
        % 1000,
    )

    clean_pickup = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0),
        (F.col("l_partkey") % 24).cast("int"),
        F.col("l_quantity").cast("int"),
        F.lit(0),
    )
    year_end = F.make_timestamp_ntz(
        F.year("o_orderdate"), F.lit(12), F.lit(31), F.lit(23), F.lit(50), F.lit(0)
    )
    layer1 = hashed.withColumns(
        {
            "pickup": F.when(bucket(20, 24), F.lit(None))
            .when(bucket(45, 49), year_end)
            .otherwise(clean_pickup),
            "payment": F.when(bucket(135, 139), F.lit(None).cast("bigint"))
            .when(bucket(140, 144), F.lit(9).cast("bigint"))
            .otherwise(F.col("l_partkey") % 7),
            "pu": F.when(bucket(115, 119), F.lit(None).cast("bigint"))
            .when(bucket(120, 124), F.lit(900).cast("bigint"))
            .otherwise(_location(F.col("c_nationkey")).cast("bigint")),
            "sign": F.when(bucket(155, 164), F.lit(-1)).otherwise(F.lit(1)),
            "fare_c": 300 + F.round(F.col("l_extendedprice") * 100).cast("bigint") % 9000,
        }
    )
    dropoff_offset = (
        F.when(bucket(30, 34), F.lit(-5))
        .when(bucket(35, 39), F.lit(400))
        .when(bucket(40, 44), F.lit(0))
        .when(bucket(45, 49), F.lit(30))
        .otherwise(2 + F.col("l_partkey") % 80)
    )
    airport = F.coalesce(F.col("pu").isin(*FIXTURE_AIRPORT_PICKUPS), F.lit(False))
    sign = F.col("sign")
    cents = {
        "fare_amount": F.col("fare_c"),
        "extra": F.lit(100),
        "mta_tax": F.when(bucket(168, 170), F.lit(-50)).otherwise(F.lit(50)),
        "tip_amount": F.when(bucket(145, 149), F.lit(200))
        .when(F.col("payment") == 1, F.floor(F.col("fare_c") / 5))
        .otherwise(F.lit(0)),
        "tolls_amount": F.when(airport, F.lit(694)).otherwise(F.lit(0)),
        "improvement_surcharge": F.lit(100),
        "congestion_surcharge": F.lit(250),
        "Airport_fee": F.when(airport, F.lit(175)).otherwise(F.lit(0)),
        "cbd_congestion_fee": F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(
            F.lit(75)
        ),
    }
    layer2 = layer1.withColumns(
        {
            "dropoff": F.when(bucket(25, 29), F.lit(None)).otherwise(
                F.col("pickup") + _minutes(dropoff_offset)
            ),
            **{f"{k}_c": (v * sign).cast("bigint") for k, v in cents.items()},
        }
    )
    component_sum = sum(F.coalesce(F.col(f"{k}_c"), F.lit(0)) for k in cents)
    total_c = (
        F.when(bucket(165, 167), F.lit(None))
        .when(bucket(150, 154), component_sum + 300)
        .otherwise(component_sum)
    )
    partition_ts = F.coalesce(F.col("pickup"), F.col("o_orderdate"))
    month = F.when(bucket(171, 173), F.month(partition_ts) % 12 + 1).otherwise(
        F.month(partition_ts)
    )

    def money(c: Column) -> Column:
        return (c / 100.0).cast("double")

    trips = layer2.select(
        F.when(bucket(0, 9), F.lit(None).cast("bigint"))
        .when(bucket(10, 19), F.lit(4).cast("bigint"))
        .otherwise(_pick(FIXTURE_VENDORS, F.col("l_suppkey") % 4).cast("bigint"))
        .alias("VendorID"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.col("dropoff").alias("tpep_dropoff_datetime"),
        F.when(bucket(50, 59), F.lit(0).cast("bigint"))
        .when(bucket(60, 64), F.lit(-1).cast("bigint"))
        .when(bucket(65, 79), F.lit(None).cast("bigint"))
        .otherwise((1 + F.col("l_linenumber") % 6).cast("bigint"))
        .alias("passenger_count"),
        F.when(bucket(80, 94), F.lit(0.0))
        .when(bucket(95, 97), F.lit(-1.5))
        .when(bucket(98, 99), F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity") / 4)
        .alias("trip_distance"),
        F.when(bucket(100, 109), F.lit(None).cast("bigint"))
        .when(bucket(110, 114), F.lit(8).cast("bigint"))
        .otherwise(_pick(FIXTURE_RATE_CODES, F.col("l_partkey") % 7).cast("bigint"))
        .alias("RatecodeID"),
        F.when(h % 50 == 0, F.lit(" y "))
        .when(h % 50 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("N"))
        .alias("store_and_fwd_flag"),
        F.col("pu").alias("PULocationID"),
        F.when(bucket(125, 129), F.lit(None).cast("bigint"))
        .when(bucket(130, 134), F.lit(900).cast("bigint"))
        .otherwise(_location(F.col("s_nationkey")).cast("bigint"))
        .alias("DOLocationID"),
        F.col("payment").alias("payment_type"),
        money(F.col("fare_amount_c")).alias("fare_amount"),
        money(F.col("extra_c")).alias("extra"),
        money(F.col("mta_tax_c")).alias("mta_tax"),
        money(F.col("tip_amount_c")).alias("tip_amount"),
        money(F.col("tolls_amount_c")).alias("tolls_amount"),
        money(F.col("improvement_surcharge_c")).alias("improvement_surcharge"),
        money(total_c).alias("total_amount"),
        money(F.col("congestion_surcharge_c")).alias("congestion_surcharge"),
        money(F.col("Airport_fee_c")).alias("Airport_fee"),
        money(F.col("cbd_congestion_fee_c")).alias("cbd_congestion_fee"),
        F.year(partition_ts).cast("string").alias("year"),
        month.cast("string").alias("month"),
        # Stable identity of the source line (a file reader uses file + row index).
        (F.col("l_orderkey") * 16 + F.col("l_linenumber") * 2).alias("_line_id"),
        F.when(bucket(174, 183), F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
        .alias("_copies"),
    )
    # Duplicated lines are emitted twice by a generator: one pass, no re-scan.
    return trips.select("*", F.explode("_copies").alias("_copy")).select(
        *[c for c in trips.columns if c not in ("_line_id", "_copies")],
        (F.col("_line_id") + F.col("_copy")).alias("_source_row_id"),
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a derived table that arrives in fewer partitions than cores.

    A small single-file input (one Parquet row group) is read by one task;
    every row-local operator downstream would then run on one core. Large
    inputs already have at least one partition per core and are left as is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zone lookup: one zone per nation plus fixed dirty rows."""
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    clean = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _location(F.col("n_nationkey")).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Z"), (F.col("n_nationkey") % 3).cast("string")).alias("service_zone"),
    )
    dirty = inline_rows(spark, FIXTURE_DIRTY_ZONES, RAW_ZONE_DDL)
    return clean.unionByName(dirty)
