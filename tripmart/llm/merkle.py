"""Merkle manifest of a data set, proved with octopus multiproofs.

Every row is a leaf; the leaves of one group (a language) form a binary tree
in the order of their ids, and the group roots form a tree of their own. The
sorted leaves are cut into leaf partitions: runs of consecutive leaves of one
tree, at most ``LEAVES`` long, one row each.

* Build: a leaf partition emits its maximal complete subtrees (at most two a
  level); the nodes that span several partitions are folded from those, ten
  levels a round. Only these nodes are stored.
* Prove: a leaf partition computes the minimal union of the node coordinates
  that the paths of all its leaves miss, fetches them in one join, derives the
  interiors its leaves share, and expands one proof per leaf from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import read_table
from tripmart.operators.lookup import broadcast_bounded, discard, materialize

#: Leaves of one leaf partition, and levels folded in one round above them.
LEAVES, LEVELS = 4096, 10
#: Nodes from this level on have so many leaves below that they are few: one each 2**23 leaves at most.
HIGH = 24


def node(children: bytes) -> bytes:
    """H over hexadecimal digests laid one after another, as hexadecimal text."""
    return sha256(children).hexdigest().encode()


def height(total: int) -> int:
    """Levels above the leaves of a tree of so many leaves."""
    return (total - 1).bit_length()


def width(total: int, level: int) -> int:
    """Nodes of a level."""
    return -(-total >> level)


def missing(held: np.ndarray, total: int) -> list[tuple[int, int]]:
    """The smallest set of nodes ``(level, index)`` that completes the paths of the held leaves to the root."""
    out: list[tuple[int, int]] = []
    at = np.unique(held)
    for level in range(height(total)):
        need = np.setdiff1d(at ^ 1, at)
        out += [(level, i) for i in need[need < width(total, level)].tolist()]
        at = np.unique(at >> 1)
    return out


def derive(leaves: dict[int, bytes], fetched: dict[int, dict[int, bytes]], total: int) -> list[dict[int, bytes]]:
    """All nodes on the held leaves' paths and beside them, by level; the last holds the root."""
    levels, here = [], dict(leaves)
    for level in range(height(total)):
        here.update(fetched.get(level, {}))
        levels.append(here)
        here = {i: node(here[2 * i] + here.get(2 * i + 1, b"")) for i in {j >> 1 for j in here}}
    return [*levels, here]


def frontier(start: int, leaves: list[bytes], total: int) -> Iterator[tuple[int, int, bytes]]:
    """Maximal complete subtrees over a run of leaves: ``(level, index, digest)``."""
    lo, hi, here, level = start, start + len(leaves), leaves, 0
    while lo < hi:
        wide = width(total, level)
        if wide == 1:
            yield level, 0, here[0]
            return
        if lo & 1:
            yield level, lo, here[0]
            here, lo = here[1:], lo + 1
        if lo < hi and hi & 1 and hi < wide:
            yield level, hi - 1, here[-1]
            here, hi = here[:-1], hi - 1
        here = [node(b"".join(here[k : k + 2])) for k in range(0, len(here), 2)]
        lo, hi, level = lo >> 1, (hi + 1) >> 1, level + 1


def fold_block(nodes: list[tuple[int, int, bytes]], to: int) -> Iterator[tuple[int, int, bytes]]:
    """Nodes up to level ``to`` over disjoint nodes that cover one node of that level."""
    given: dict[int, dict[int, bytes]] = {}
    for level, index, digest in nodes:
        given.setdefault(level, {})[index] = digest
    here: dict[int, bytes] = {}
    for level in range(min(given, default=to), to):
        here = here | given.get(level, {})
        here = {i: node(here.get(2 * i, b"") + here.get(2 * i + 1, b"")) for i in {j >> 1 for j in here}}
        yield from ((level + 1, i, digest) for i, digest in here.items())


def proof_of(levels: list[dict[int, bytes]], index: int) -> list[tuple[bool, bytes]]:
    """Siblings of a leaf from its level upwards: whether each stands on the left, and its digest (empty: none)."""
    out = []
    for nodes in levels[:-1]:
        out.append((bool(index & 1), nodes.get(index ^ 1, b"")))
        index >>= 1
    return out


def fold(leaf: bytes, proof: list[tuple[bool, bytes]]) -> bytes:
    for left, sibling in proof:
        leaf = node(sibling + leaf if left else leaf + sibling)
    return leaf


# -- rows ------------------------------------------------------------------------


def leaf_hash(values: list[Column]) -> Column:
    """H over the values, each as its byte count and text, ``-`` for a null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(grp, doc_id, digest, changed)``: leaves as bytes, and the leaf after tampering where the row is tampered with."""
    c = F.col
    fields = [c("doc_id"), c("source"), c("lang"), c("n_chars"), c("text")]
    more = [*fields[:3], c("n_chars").cast("decimal(38,0)") + 1, c("text")]
    hit = F.crc32(c("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        c("lang").alias("grp"), "doc_id", F.unhex(leaf_hash(fields)).alias("digest"),
        F.when(hit, F.unhex(leaf_hash(more))).alias("changed"),
    )


def leaf_partitions(leaves: DataFrame, order: list[str], size: int = LEAVES) -> DataFrame:
    """Runs of consecutive leaves of one group: ``(part, seq, grp, n, rows)``, in order of ``(part, seq)``.

    Range partitions of ``(grp, order..., digest)``: a large group spreads over
    many of them, and a running number ends the key, so equal rows spread too.
    """
    payload = [f for f in leaves.schema.fields if f.name != "grp"]
    written = materialize(leaves.withColumn("__tie", F.monotonically_increasing_id()))
    key = [F.col(k).asc_nulls_first() for k in ("grp", *order, "digest", "__tie")]
    sorted_rows = written.repartitionByRange(*key).sortWithinPartitions(*key).drop("__tie")
    inner = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in payload)
    schema = f"part int, seq int, grp {leaves.schema['grp'].dataType.simpleString()}, n int, rows array<struct<{inner}>>"
    names = [f.name for f in payload]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        group, held, count = None, [], 0

        def row() -> pa.RecordBatch:
            whole = pa.concat_arrays(held)
            lists = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
            head = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), group, pa.array([count], pa.int32())]
            return pa.RecordBatch.from_arrays([*head, lists], names=["part", "seq", "grp", "n", "rows"])

        for batch in batches:
            grp = batch.column(batch.schema.names.index("grp"))
            codes = grp.dictionary_encode(null_encoding="encode").indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            columns = [batch.column(batch.schema.names.index(n)) for n in names]
            rows = pa.StructArray.from_arrays(columns, names=names)
            for a, b in zip(cuts, cuts[1:]):
                if count and grp[a].as_py() != group[0].as_py():
                    yield row()
                    held, count, seq = [], 0, seq + 1
                while a < b:
                    take = min(b - a, size - count)
                    held.append(rows.slice(a, take))
                    group, count, a = grp.slice(a, 1), count + take, a + take
                    if count == size:
                        yield row()
                        held, count, seq = [], 0, seq + 1
        if count:
            yield row()

    cut_rows = materialize(sorted_rows.mapInArrow(cut, schema))
    discard(written)
    return cut_rows


def placed(parts: DataFrame) -> DataFrame:
    """Each leaf partition with its first position and its tree's size, from counts alone: ``(part, seq, first, total)``."""
    by = parts.groupBy("grp", "part").agg(F.sum("n").alias("rows"))
    base = by.select(
        F.col("grp").alias("b_grp"), F.col("part").alias("b_part"),
        F.coalesce(F.sum("rows").over(_before("grp", "part")), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("total"),
    )
    inside = F.coalesce(F.sum("n").over(_before("grp", "part", "seq")), F.lit(0))
    runs = parts.select("part", "seq", "grp", inside.alias("inside"))
    whose = F.col("grp").eqNullSafe(F.col("b_grp")) & (F.col("part") == F.col("b_part"))
    return runs.join(base, whose).select("part", "seq", (F.col("base") + F.col("inside")).alias("first"), "total")


def _before(*keys: str):
    return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)


NODE = "level int, index bigint, digest binary"


class Forest:
    """Leaf partitions, their places and the stored nodes of one tree per group."""

    def __init__(self, leaves: DataFrame, order: list[str], size: int = LEAVES, levels: int = LEVELS):
        self.parts = leaf_partitions(leaves, order, size)
        self.grp = self.parts.schema["grp"].dataType.simpleString()
        self.places = materialize(placed(self.parts.select("part", "seq", "grp", "n")))
        self.placed_parts = self.join_parts(self.places)
        self.nodes = self._nodes(levels)

    def join_parts(self, small: DataFrame) -> DataFrame:
        """Leaf partitions with columns of a narrow table with one row for each of them."""
        return self.parts.join(broadcast_bounded(small, small.count()), ["part", "seq"])

    def _nodes(self, levels: int) -> DataFrame:
        """Frontiers of all leaf partitions and every node above them: ``(grp, total, level, index, digest)``."""

        def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for grp, total, first, rows in _each(batches, "grp", "total", "first", "rows"):
                found = list(frontier(first, [d.hex().encode() for d in rows.field("digest").to_pylist()], total))
                yield _node_rows(grp, total, found)

        schema = f"grp {self.grp}, total bigint, {NODE}"
        rounds = [materialize(self.placed_parts.mapInArrow(seeds, schema))]
        tallest = height(self.places.agg(F.max("total")).first()[0] or 1)
        top = F.length(F.bin(F.col("total") - 1))
        top = F.when(F.col("total") > 1, top).otherwise(0).cast("int")
        open_nodes = rounds[0]
        for to in range(levels, tallest + levels, levels):
            low = open_nodes.where(F.col("level") < F.least(F.lit(to), top))
            block = F.expr(f"shiftright(index, {to} - level)").alias("block")
            groups = low.groupBy("grp", "total", block, F.least(F.lit(to), top).alias("to")).agg(
                F.collect_list(F.struct("level", "index", "digest")).alias("nodes")
            )

            def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for grp, total, to, nodes in _each(batches, "grp", "total", "to", "nodes"):
                    given = [(n["level"], n["index"], n["digest"].hex().encode()) for n in nodes.to_pylist()]
                    yield _node_rows(grp, total, list(fold_block(given, to)))

            made = materialize(groups.mapInArrow(folded, schema))
            rounds.append(made)
            open_nodes = open_nodes.unionByName(made).where(F.col("level") >= F.least(F.lit(to), top))
        store = rounds[0]
        for made in rounds[1:]:
            store = store.unionByName(made)
        store = materialize(store)
        for made in rounds:
            discard(made)
        return store

    def roots(self) -> DataFrame:
        """``(grp, digest)`` of every tree."""
        top = F.when(F.col("total") > 1, F.length(F.bin(F.col("total") - 1))).otherwise(0)
        return self.nodes.where(F.col("level") == top).select("grp", "digest")

    def fetched(self, max_bytes: int = 64 << 20) -> DataFrame:
        """The nodes each leaf partition misses, fetched in one join: ``(part, seq, fetched)``.

        Few nodes stand high and many partitions ask for each of them: beyond
        the size of a broadcast those still go to every task, the others are
        joined by their coordinates.
        """

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, seq, grp, n, first, total in _each(batches, "part", "seq", "grp", "n", "first", "total"):
                need = missing(np.arange(first, first + n), total)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(need), pa.int32()), pa.array([seq] * len(need), pa.int32()),
                        pa.array([grp[0].as_py()] * len(need), grp.type),
                        pa.array([x[0] for x in need], pa.int32()), pa.array([x[1] for x in need], pa.int64()),
                    ],
                    names=["part", "seq", "grp", "level", "index"],
                )

        narrow = self.parts.select("part", "seq", "grp", "n").join(self.places, ["part", "seq"])
        requests = narrow.mapInArrow(asked, f"part int, seq int, grp {self.grp}, level int, index bigint")
        same = F.expr("q.grp <=> s.grp AND q.level = s.level AND q.index = s.index")
        stored = self.nodes.select("grp", "level", "index", "digest")
        rows = stored.count()

        def answer(nodes: DataFrame, which: Column) -> DataFrame:
            found = requests.where(which).alias("q").join(nodes.alias("s"), same)
            return found.select("q.part", "q.seq", "q.level", "q.index", "s.digest")

        if broadcast_bounded(stored, rows, max_bytes) is not stored:
            got = answer(F.broadcast(stored), F.lit(True))
        else:
            high = stored.where(F.col("level") >= HIGH)
            got = answer(stored.where(F.col("level") < HIGH), F.col("level") < HIGH).unionByName(
                answer(broadcast_bounded(high, high.count(), max_bytes), F.col("level") >= HIGH)
            )
        return got.groupBy("part", "seq").agg(F.collect_list(F.struct("level", "index", "digest")).alias("fetched"))

    def proofs(self) -> DataFrame:
        """Leaf partitions with everything their proofs need: ``(part, seq, grp, n, rows, first, total, fetched)``."""
        return self.join_parts(materialize(self.places.join(self.fetched(), ["part", "seq"], "left")))


def _node_rows(grp: pa.Array, total: int, nodes: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    n = len(nodes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([grp[0].as_py()] * n, grp.type), pa.array([total] * n, pa.int64()),
            pa.array([x[0] for x in nodes], pa.int32()), pa.array([x[1] for x in nodes], pa.int64()),
            pa.array([bytes.fromhex(x[2].decode()) for x in nodes], pa.binary()),
        ],
        names=["grp", "total", "level", "index", "digest"],
    )


def _each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns: lists as arrays, groups as arrays of one value, numbers as such."""
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(n)) for n in names]
        for i in range(batch.num_rows):
            out = []
            for name, col in zip(names, columns):
                if name == "grp":
                    out.append(col.slice(i, 1))
                elif pa.types.is_list(col.type):
                    out.append(col[i].values)
                else:
                    out.append(col[i].as_py())
            yield tuple(out)


def expand(first: int, total: int, leaves: list[bytes], fetched: pa.Array | None) -> tuple[list[dict[int, bytes]], bytes]:
    """Levels of nodes on the paths of a leaf partition, and its tree's root."""
    got: dict[int, dict[int, bytes]] = {}
    for n in fetched.to_pylist() if fetched is not None else ():
        got.setdefault(n["level"], {})[n["index"]] = n["digest"].hex().encode()
    levels = derive(dict(enumerate(leaves, first)), got, total)
    return levels, levels[-1][0]


PROOFS = (
    "doc_id bigint, leaf string, subroot string, root string, proof array<struct<left: boolean, sibling: string>>, "
    "proof_sha256 string, folded_root string, verified boolean"
)


def _group_paths(roots: DataFrame, size: int) -> DataFrame:
    """Path of every group's root to the root of all: ``(grp, root, above)``."""
    forest = Forest(roots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest"), ["name"], size)

    kind = roots.schema["grp"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, total, rows, fetched in _each(batches, "first", "total", "rows", "fetched"):
            leaves = [d.hex().encode() for d in rows.field("digest").to_pylist()]
            levels, root = expand(first, total, leaves, fetched)
            above = [[{"left": a, "sibling": s} for a, s in proof_of(levels, first + i)] for i in range(len(leaves))]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.field("name"), pa.array([root] * len(leaves), pa.binary()),
                    pa.array(above, pa.list_(pa.struct([("left", pa.bool_()), ("sibling", pa.binary())]))),
                ],
                names=["grp", "root", "above"],
            )

    return forest.proofs().mapInArrow(run, f"grp {kind}, root binary, above array<struct<left: boolean, sibling: binary>>")


def manifest(docs: DataFrame, size: int = LEAVES, listed: bool = True) -> DataFrame:
    """Leaf, roots, proof and check of every document: the columns of ``PROOFS``.

    ``proof`` lists the siblings up to the root, an empty one where a node
    stood alone (``listed=False`` leaves it null). A null in any column counts as ``-``
    in the leaf; a null language is a group of its own and comes first; a null
    ``doc_id`` comes first in its group and is never tampered with; equal ids
    are ordered by their leaf, equal rows are leaves of their own; empty texts
    count 0 bytes; a text is hashed whole inside the JVM however long; an
    empty table has no rows. Only ``doc_id, source, lang, n_chars, text`` are
    read, so further columns cannot clash.
    """
    forest = Forest(document_leaves(docs), ["doc_id"], size)
    paths = materialize(_group_paths(forest.roots(), size))
    ready = forest.proofs().alias("p").join(
        broadcast_bounded(paths, paths.count()).alias("t"), F.expr("p.grp <=> t.grp")
    ).select("first", "total", "rows", "fetched", "root", "above")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, total, rows, fetched, root, above in _each(batches, "first", "total", "rows", "fetched", "root", "above"):
            leaves = [d.hex().encode() for d in rows.field("digest").to_pylist()]
            changed = rows.field("changed").to_pylist()
            levels, subroot = expand(first, total, leaves, fetched)
            upper = [(x["left"], x["sibling"]) for x in above.to_pylist()]
            proofs, digests, folded = [], [], []
            for i, leaf in enumerate(leaves):
                proof = proof_of(levels, first + i) + upper
                proofs.append([{"left": a, "sibling": s.decode()} for a, s in proof] if listed else None)
                digests.append(sha256(b"".join([s for _, s in proof])).hexdigest())
                folded.append(fold(leaf if changed[i] is None else changed[i].hex().encode(), proof).decode())
            n, top = len(leaves), root.decode()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.field("doc_id"), pa.array([x.decode() for x in leaves]),
                    pa.array([subroot.decode()] * n), pa.array([top] * n),
                    pa.array(proofs, pa.list_(pa.struct([("left", pa.bool_()), ("sibling", pa.string())]))),
                    pa.array(digests), pa.array(folded), pa.array([f == top for f in folded]),
                ],
                names=["doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"],
            )

    return ready.mapInArrow(run, PROOFS)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"), listed=False).drop("proof")


#: The contract as SQL: levels and folds by recursion, crc32 bit by bit over the digits of the id.
OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, lang,
    list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text],
      lambda x: coalesce(CAST(strlen(x) AS VARCHAR) || ':' || x, '-')) AS f,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') AS more,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295) AS crc
  FROM documents),
leaves AS (SELECT row, doc_id, lang, crc % 7 = 0 AS hit,
    sha256(concat(f[1], f[2], f[3], f[4], f[5])) AS leaf, sha256(concat(f[1], f[2], f[3], more, f[5])) AS other FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS total FROM leaves),
trees AS (SELECT lang, total, 0 AS level, CAST(pos AS BIGINT) AS i, leaf AS h FROM placed
  UNION ALL SELECT lang, ANY_VALUE((total + 1) // 2), ANY_VALUE(level + 1), i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM trees
    WHERE total > 1 GROUP BY lang, i // 2),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS total FROM trees WHERE total = 1),
tops AS (SELECT total, 0 AS level, CAST(pos AS BIGINT) AS i, h FROM subroots
  UNION ALL SELECT ANY_VALUE((total + 1) // 2), ANY_VALUE(level + 1), i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops
    WHERE total > 1 GROUP BY i // 2),
steps AS (
  SELECT row, t.level, (pos >> t.level) % 2 = 1 AS behind, coalesce(s.h, '') AS h
  FROM placed p JOIN trees t ON t.lang IS NOT DISTINCT FROM p.lang AND t.i = p.pos >> t.level AND t.total > 1
  LEFT JOIN trees s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = t.level AND s.i = xor(t.i, 1)
  UNION ALL
  SELECT row, 100 + t.level, (r.pos >> t.level) % 2 = 1, coalesce(s.h, '')
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN tops t ON t.i = r.pos >> t.level AND t.total > 1
  LEFT JOIN tops s ON s.level = t.level AND s.i = xor(t.i, 1)),
paths AS (SELECT row, string_agg(h, '' ORDER BY level) AS whole, list({'behind': behind, 'h': h} ORDER BY level) AS path FROM steps GROUP BY row),
folds AS (SELECT p.row, CASE WHEN hit THEN other ELSE leaf END AS h, coalesce(path, []) AS path, 1 AS k FROM placed p LEFT JOIN paths USING (row)
  UNION ALL SELECT row, sha256(CASE WHEN path[k].behind THEN path[k].h || h ELSE h || path[k].h END), path, k + 1 FROM folds WHERE k <= len(path))
SELECT p.doc_id, p.leaf, r.h AS subroot, t.h AS root, sha256(coalesce(paths.whole, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN tops t ON t.total = 1 LEFT JOIN paths USING (row)
JOIN folds f ON f.row = p.row AND f.k = len(f.path) + 1
"""
