"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are linked and linked fingerprints form
components. Every bit position is given a nonzero vector of ``radius + 1``
bits; table ``v`` keeps the positions whose vector has an odd product with
``v``. At most ``radius`` differing positions span less than the whole space,
so some ``v`` is orthogonal to all of them: that table drops every differing
bit and the pair collides in it, always.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import map_rows, read_table, slices
from tripmart.operators.lookup import discard, materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Distinct fingerprints up to which a bucket is compared pair by pair.
BUCKET = 32


def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> list[int]:
    """Unsigned 64-bit SimHash of each text (zero for a text without words)."""
    out, digest = [], xxhash.xxh64_digest
    for text in texts:
        words = (text or "").encode().lower().split()
        if not words:
            out.append(0)
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        span = min(shingle, len(words))
        stops = ends[span - 1 :].tolist()
        starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
        # Half a million shingles at a time bound the bit matrix of very long texts.
        ones = np.zeros(64, dtype=np.int64)
        for i in range(0, len(stops), 1 << 16):
            raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i : i + (1 << 16)], stops[i : i + (1 << 16)])])
            ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        bits = 2 * ones > len(stops)
        out.append(int.from_bytes(np.packbits(bits).tobytes(), "big"))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int = RADIUS) -> list[int]:
    """``2**(radius + 1) - 1`` masks; any ``radius`` positions are all dropped by some mask."""
    size = radius + 1
    vectors = [1 + i % ((1 << size) - 1) for i in range(64)]
    return [
        sum(1 << i for i, a in enumerate(vectors) if bin(a & v).count("1") % 2) for v in range(1, 1 << size)
    ]


def simhash_table(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` per row, ``fp`` as a signed long."""

    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "fp": [_signed(x) for x in fingerprints(cols["text"], shingle)]}

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, fp bigint", run)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect exactly the pairs within ``radius``.

    ``fps`` has distinct values ``fp``. Buckets of up to ``bucket``
    fingerprints are compared in a self-join on the bucket. A fingerprint that
    lies in a larger bucket is linked through its neighbourhood instead: all
    words within ``radius // 2`` flips (and, for an odd radius, one more flip
    on one side) are listed, and members that share a word are starred on the
    smallest; sharing one means lying within ``radius``, and any two members
    of one large bucket within ``radius`` share one. No group lists its pairs.
    """
    tables = F.array(*[
        F.struct(F.lit(v).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for v, m in enumerate(covering_masks(radius))
    ])
    keyed = materialize(fps.select("fp", F.explode(tables).alias("k")).select("k.t", "k.key", "fp"))
    sizes = keyed.groupBy("t", "key").count().filter("count > 1")
    small = keyed.join(sizes.filter(F.col("count") <= bucket).select("t", "key"), ["t", "key"])
    large = keyed.join(sizes.filter(F.col("count") > bucket).select("t", "key"), ["t", "key"])
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius
    pairs = (
        small.alias("x").join(small.alias("y"), ["t", "key"])
        .filter((F.col("x.fp") < F.col("y.fp")) & near)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    return pairs.unionAll(_star_links(large.select("fp").distinct(), radius)).distinct()


def _star_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links through shared words: each member to the smallest member of the word's group."""
    flips = [0, *[1 << i for i in range(64)]]
    reach = radius // 2
    words = {0}
    for _ in range(reach):
        words = {w ^ f for w in words for f in flips}
    near = F.transform(F.array(*[F.lit(_signed(w)) for w in sorted(words)]), lambda w: w.bitwiseXOR(F.col("fp")))
    if radius % 2 == 0:
        listed = fps.select("fp", F.explode(near).alias("word"))
        lowest = listed.groupBy("word").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
        return listed.join(lowest, "word").filter("a < fp").select("a", F.col("fp").alias("b"))
    # Odd: one side stays within reach of the word, the other goes one flip further.
    further = sorted({w ^ f for w in words for f in flips})
    wide = F.transform(F.array(*[F.lit(_signed(w)) for w in further]), lambda w: w.bitwiseXOR(F.col("fp")))
    inner = fps.select("fp", F.explode(near).alias("word"))
    centre = inner.groupBy("word").agg(F.min("fp").alias("a"))
    outer = fps.select("fp", F.explode(wide).alias("word")).join(centre, "word").filter("a <> fp")
    return outer.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= radius).select(
        F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b")
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links``; ``root`` is the component's smallest node.

    Alternates large stars and small stars on the edge list until it stops
    changing: O(log n) rounds, each written to the shared folder and deleted
    when the next one stands, so a lost executor costs one round and neither
    lineage nor copies build up. Only minima per node are gathered, never
    neighbour lists.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    total = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large)
        before = edges
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.filter("u <> v").distinct())
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(large)
        discard(before)
        if state == total:
            break
        total = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Fingerprint and component of every row: ``(doc_id, fp, component_id, root)``.

    Equal texts collapse to one fingerprint before anything is compared.
    ``component_id`` is the smallest ``doc_id`` reachable over links (null
    only if no reachable row has an id), ``root`` the component's smallest
    fingerprint, which tells components apart where ids are repeated. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows come back
    repeated; an empty table gives an empty one. Only ``doc_id`` and ``text``
    are read.
    """
    rows = materialize(simhash_table(docs, shingle))
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(fingerprint_links(fps.select("fp"), radius))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialize(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id", "root")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def hex_of(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are.

    The row of the smallest ``doc_id`` stays (a null id only where the
    component has no other). Where that id is repeated in ``docs``, only rows
    with the winning fingerprint count, and one of them stays.
    """
    cols = docs.columns
    found = materialize(near_duplicates(docs, shingle, radius))
    winners = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "fp")).alias("w")
    )
    winners = winners.select(F.col("w.doc_id").alias("__id"), F.col("w.fp").alias("__fp"))
    again = materialize(found.groupBy(F.col("doc_id").alias("__id")).count().filter("count > 1").select("__id"))
    if again.isEmpty():
        return docs.join(winners, docs["doc_id"].eqNullSafe(winners["__id"]), "left_semi")
    same = winners["__id"].eqNullSafe(again["__id"])
    once = winners.join(again, same, "left_anti")
    more = winners.join(again, same, "left_semi").distinct()
    plain = docs.join(once, docs["doc_id"].eqNullSafe(once["__id"]), "left_semi")
    name = "__print"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    marked = _with_fingerprint(docs, shingle, name)
    marked = marked.join(more, marked["doc_id"].eqNullSafe(more["__id"]) & (marked[name] == more["__fp"]), "left_semi")
    return plain.select(cols).unionAll(marked.dropDuplicates(["doc_id", name]).select(cols))


def _with_fingerprint(docs: DataFrame, shingle: int, name: str) -> DataFrame:
    at, schema = docs.columns.index("text"), T.StructType([*docs.schema.fields]).add(name, T.LongType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 4 << 20):
            fps = [_signed(x) for x in fingerprints(piece.column(at).to_pylist(), shingle)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(fps, type=pa.int64())], names=names)

    return docs.mapInArrow(run, schema)
