import duckdb
import pytest

from tripmart.llm import urls

URLS = [
    None, "", "no scheme", "http://A.Com/x", "http://x.com", "https://example.com/en/1", "http://www.example.com/en/2?q=1#f",
    "http://a.www.example.com/en/", "http://b.net/es/1", "http://b.net/esp", "http://b.net/fr/", "http://b.org/1/?utm_source=a&page=2",
    "https://www.b.org/1?page=2", "http://m.b.org/1", "x://y://z.com/a", "http://notexample.com/en/", "http://b.org:80/1", "ftp://b.org?x", "http://b.org/1/", "http://É.org/À",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "<p>") for i, u in enumerate(URLS * 3)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_matches_sql(spark, pages, tmp_path):
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, urls.op10_url_filters(spark, str(tmp_path)).collect()), key=lambda r: r[0])
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"select page_id, host, path, rule, verdict, listed from ({urls.OP10_SQL}) order by page_id").fetchall()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_list_blocks_exactly_its_pages(spark, pages, limit):
    listed = spark.createDataFrame([("http://b.org/1/",), (None,), ("http://b.org/1",)], "url string")
    got = urls.url_filter(pages, listed, broadcast_bytes=limit).collect()
    assert len(got) == pages.count()
    blocked = {URLS[r["page_id"] % len(URLS)] for r in got if r["listed"]}
    assert blocked == {"http://m.b.org/1", "http://b.org/1/"}


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_one_url_on_a_third_of_the_pages(spark, limit):
    rows = [(i, "http://www.hot.org/a?ref=x" if i % 3 == 0 else None if i % 3 == 1 else f"http://b.org/{i}") for i in range(900)]
    rows += [(None, "http://hot.org/a"), (None, None), (7, "http://b.org/" + "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    listed = spark.createDataFrame([("http://hot.org/a",), ("http://b.org/5",), (rows[-1][1],)], "url string")
    got = urls.url_filter(pages, listed, broadcast_bytes=limit).collect()
    assert len(got) == len(rows)
    assert sum(r["listed"] for r in got) == 300 + 1 + 1 + 1
    assert sorted(r["path"] for r in got if r["listed"])[-1] == "/" + "x" * 200_000


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_columns_of_the_same_names(spark, pages, limit):
    listed = pages.select("url")
    want = sorted(map(str, urls.url_filter(pages, listed, broadcast_bytes=limit).collect()))
    for name in ("key", "block", "probe", "salt", "found", "listed", "lane0", "id", "rule", "sure", "wanted"):
        pages = pages.selectExpr("*", f"'x' AS {name}")
    assert sorted(map(str, urls.url_filter(pages, listed, broadcast_bytes=limit).collect())) == want


def test_pages_are_read_once_and_not_shuffled(spark, pages, tmp_path):
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    found = urls.op10_url_filters(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("url#") and plan.count("Relation") == 3  # pages, the keys, and the keys again for the filter
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_bloom_never_misses(spark):
    listed = spark.range(5000).selectExpr("concat('b.org/', id) AS key")
    bloom, n_blocks = urls.blocked_bloom(listed, "key")
    block, masks = urls._bits(urls.F.col("key"), n_blocks)
    probe = spark.range(10000).selectExpr("concat('b.org/', id) AS key", "id < 5000 AS member")
    tested = probe.withColumn("block", block).join(bloom, "block", "left")
    hit = urls.F.lit(True)
    for i, m in enumerate(masks):
        hit = hit & (urls.F.col(f"lane{i}").bitwiseAND(m) == m)
    counts = {r["member"]: r["n"] for r in tested.filter(hit).groupBy("member").agg(urls.F.count("*").alias("n")).collect()}
    assert counts[True] == 5000 and counts.get(False, 0) < 500


def test_empty_tables(spark, pages):
    none = pages.limit(0)
    assert urls.url_filter(none, none.select("url")).count() == 0
    assert urls.url_filter(pages, none.select("url")).filter("listed").count() == 0


def test_main_path_is_native(spark, pages):
    plan = urls.url_filter(pages, pages.select("url"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
