"""URL filters: a blocked Bloom filter in front of an exact join, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import read_table
from tripmart.operators.lookup import discard, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the contract: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LANES = 4
#: Copies of a block of a filter that is joined by shuffle; the share (one in so many) and the
#: length from and up to which a URL among the possible hits is looked up by broadcast.
SALTS, HOT, HOT_BYTES = 16, 1024, 4096


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without trailing slashes, query without tracking.

    Scheme and fragment do not count; null and texts without ``://`` give the empty string.
    """
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[^&=]*|ref)=[^&]*", ""), r"^&", "")
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.concat(host, path, F.when(F.coalesce(query, F.lit("")) != "", F.concat(F.lit("?"), query)).otherwise(""))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    h, p, _ = rule
    return ((host == h) | host.endswith(f".{h}")) & path.startswith(p)


def _first_rule(host: Column, path: Column, rules: tuple, value) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is tested first
        out = F.when(_fits(host, path, rule), F.lit(value(rule))).otherwise(out)
    return out


def _bits(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and one bit mask for each of the block's 64-bit lanes."""
    second = F.xxhash64(key, F.lit("lane"))
    masks = []
    for i in range(LANES):
        at = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        masks.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)), masks


def blocked_bloom(listed: DataFrame, key: str, bits_per_key: int = 16, n_keys: int | None = None) -> tuple[DataFrame, int]:
    """The filter as a table ``(block, lane0..lane3)`` of 256-bit blocks, and its number of blocks.

    The number of blocks follows the exact count of distinct keys (``n_keys``
    where it is known), so the share of false hits does not change with the
    size of the list.
    """
    n = listed.select(key).distinct().count() if n_keys is None else n_keys
    n_blocks = max(1, math.ceil(n * bits_per_key / (64 * LANES)))
    block, masks = _bits(F.col(key), n_blocks)
    rows = listed.select(block.alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"lane{i}") for i in range(LANES)]), n_blocks


def _possible_hits(judged: DataFrame, bloom: DataFrame, n_blocks: int, small: bool) -> DataFrame:
    """``judged`` with ``probe``: the key of a row without a rule that passes the filter, else null.

    A filter too large to broadcast is joined by block, each block in
    ``SALTS`` copies among which the rows are dealt, so that a URL on many
    pages is spread; rows that are not tested carry blocks of no key.
    """
    block, masks = _bits(F.col("key"), n_blocks)
    asked = F.col("rule").isNull() & (F.col("key") != "")
    if small:
        rows = judged.withColumn("block", F.when(asked, block))
        tested = rows.join(F.broadcast(bloom), "block", "left")
    else:
        spread = F.xxhash64("id", "host", "path")
        rows = judged.withColumn("block", F.when(asked, block).otherwise(-1 - F.pmod(spread, F.lit(n_blocks))))
        rows = rows.withColumn("salt", F.pmod(spread, F.lit(SALTS)).cast("int"))
        copies = bloom.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        tested = rows.join(copies, ["block", "salt"], "left")
    hit = asked
    for i, m in enumerate(masks):
        hit = hit & (F.col(f"lane{i}").bitwiseAND(m) == m)
    return tested.withColumn("probe", F.when(hit, F.col("key"))).select("id", "host", "path", "rule", "said", "probe")


def _exactly_listed(tested: DataFrame, keys: DataFrame, small: bool) -> DataFrame:
    """``tested`` with ``listed``, by an exact hash join of the probes with the listed keys.

    Keys too many to broadcast are shuffled. Then the probes that make up at
    least one in ``HOT`` of all (so there are at most ``HOT`` of them, of at
    most ``HOT_BYTES`` each) are looked up by broadcast, and all other rows
    without a probe are dealt by a salt that no key carries.
    """
    found = keys.select(F.col("key").alias("probe"), F.lit(True).alias("found"))
    if small:
        joined = tested.join(F.broadcast(found), "probe", "left")
        return joined.withColumn("listed", F.coalesce("found", F.lit(False)))
    short = tested.filter("probe IS NOT NULL").groupBy("probe").agg(F.count("*").alias("n"))
    short = materialize(short)
    total = short.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = short.filter((F.col("n") * HOT >= total) & (F.octet_length("probe") <= HOT_BYTES)).select("probe")
    verdicts = materialize(hot.join(found, "probe", "left").select("probe", F.coalesce("found", F.lit(False)).alias("sure")))
    discard(short)
    known = tested.join(F.broadcast(verdicts), "probe", "left")
    open_ = F.col("probe").isNotNull() & F.col("sure").isNull()
    salt = F.when(open_, F.lit(-1)).otherwise(F.pmod(F.xxhash64("id", "host", "path"), F.lit(1 << 20)).cast("int"))
    known = known.withColumn("salt", salt).withColumn("wanted", F.when(open_, F.col("probe")))
    right = found.select(F.col("probe").alias("wanted"), F.lit(-1).alias("salt"), "found")
    joined = known.join(right, ["wanted", "salt"], "left")
    return joined.withColumn("listed", F.coalesce("sure", "found", F.lit(False)))


def url_filter(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple = RULES,
    url: str = "url",
    id_col: str = "page_id",
    bits_per_key: int = 16,
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Judge every page: the longest fitting rule decides, else the list of canonical URLs.

    ``listed`` has a column ``url``. Its distinct canonical keys are written
    once and counted; pages without a rule are tested against the blocked
    Bloom filter of these keys, and only possible hits take part in the exact
    join, which removes false positives. Filter and keys are each broadcast
    when their counted bytes are under ``broadcast_bytes``, else joined by
    shuffle with hot URLs spread; in the first case ``pages`` is read once
    and nothing of it is shuffled. Returns ``(id, host, path, rule, verdict,
    listed)``, one row per page, repeated pages included. A null URL has empty
    host and path, no rule, and is allowed (an empty canonical URL is never
    listed); a null id is kept; an empty list blocks nothing; a very long URL
    is handled whole; columns of ``pages`` other than the two named are not
    read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = (
        pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"))
        .select("id", "url", host.alias("host"), path.alias("path"), canonical_url(F.col("url")).alias("key"))
        .select(
            "id", "host", "path", "key",
            _first_rule(F.col("host"), F.col("path"), rules, lambda r: r[0] + r[1]).alias("rule"),
            _first_rule(F.col("host"), F.col("path"), rules, lambda r: r[2]).alias("said"),
        )
    )
    keys = materialize(listed.select(canonical_url(F.col("url")).alias("key")).filter("key != ''").distinct())
    size = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("key") + 16), F.lit(0)).alias("bytes")).first()
    bloom, n_blocks = blocked_bloom(keys, "key", bits_per_key, size["n"])
    tested = _possible_hits(judged, bloom, n_blocks, n_blocks * 8 * (LANES + 1) <= broadcast_bytes)
    return _exactly_listed(tested, keys, size["bytes"] <= broadcast_bytes).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("said", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "listed",
    )


#: Every so many-th page stands in for an outside list of blocked pages.
LIST_EVERY = 50


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all ``pages``; the list is the URLs of pages with an id divisible by 50."""
    pages = read_table(spark, sf_dir, "pages")
    listed = pages.filter(F.col("page_id") % LIST_EVERY == 0).select("url")
    return url_filter(pages, listed)


_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
OP10_SQL = rf"""
WITH r AS (SELECT page_id, coalesce({_REST}, '') AS rest FROM pages),
p AS (SELECT page_id,
  translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1),
    '(^|&)(utm_[^&=]*|ref)=[^&]*', '', 'g'), '^&', '') AS query FROM r),
k AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS key,
  '.' || host AS dotted FROM p),
l AS (SELECT DISTINCT key FROM k WHERE page_id % 50 = 0 AND key <> ''),
j AS (SELECT k.*, CASE
  WHEN dotted LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
  WHEN dotted LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
  WHEN dotted LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
  WHEN dotted LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
  WHEN dotted LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM k)
SELECT page_id, host, path, rule,
  CASE rule WHEN 'www.example.com/en/' THEN 'allow' WHEN 'com/' THEN 'allow'
    WHEN 'example.com/en/' THEN 'block' WHEN 'net/fr/' THEN 'block' WHEN 'net/es/' THEN 'block'
    ELSE CASE WHEN key IN (SELECT key FROM l) THEN 'block' ELSE 'allow' END END AS verdict,
  rule IS NULL AND key IN (SELECT key FROM l) AS listed
FROM j
"""
