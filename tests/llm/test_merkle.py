import random
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from odd_texts import ODD
from tripmart.llm import merkle

R = random.Random(11)


def digest(x: str) -> str:
    return sha256(x.encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root and, for every leaf, its (side, sibling) steps."""
    steps, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            steps[i].append((p % 2 == 1, level[p ^ 1] if p ^ 1 < len(level) else ""))
            at[i] = p // 2
        level = [digest("".join(level[k : k + 2])) for k in range(0, len(level), 2)]
    return level[0], steps


def brute_force(rows):
    """The contract read literally: ``doc_id -> (leaf, subroot, root, proof, folded, verified)`` in row order."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in groups[g]])
    root, above = tree([trees[g][0] for g in order])
    out = []
    for g, up in zip(order, above):
        for row, steps in zip(groups[g], trees[g][1]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf_of(row, 1 if hit else 0)
            for left, sibling in steps + up:
                folded = digest(sibling + folded if left else folded + sibling)
            proof = digest("".join(s for _, s in steps + up))
            out.append((row[0], leaf_of(row), trees[g][0], root, proof, folded, folded == root))
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def key(row):
    return tuple(str(x) for x in row)


def rows_of(n, langs):
    return [(i, R.choice(["a", "é b", "", None]), R.choice(langs), R.choice(["s", None]), R.choice([None, 0, i])) for i in range(n)]


@pytest.mark.parametrize(
    "rows, size",
    [
        (rows_of(1, ["x"]), 4),
        (rows_of(97, ["de", "é", "", None, "zz"]), 3),
        (rows_of(130, ["one"]), 8),
        ([(None, "a", None, "s", 1), (None, "a", None, "s", 1), (7, "b", None, None, None), (7, "c", None, None, 2)] * 3, 5),
        ([(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)], 2),
        ([(i, str(i), f"l{i:03}", "s", 1) for i in range(70)], 4),
        ([(1, "same", "en", "s", 4)] * 60 + rows_of(20, ["en", "fr"]), 4096),
    ],
)
def test_matches_brute_force(spark, rows, size):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("grp", "digest", "rows", "part", "leaf", "total", "__n"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    got = merkle.manifest(docs.repartition(3), size)
    assert sorted(map(key, got.select(*COLUMNS).collect())) == sorted(map(key, brute_force(rows)))
    for r in got.collect():
        steps = [(p["left"], p["sibling"].encode()) for p in r["proof"]]
        assert merkle.fold(r["leaf"].encode(), steps).decode() == r["root"]


def test_empty_table(spark):
    got = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0


def test_multiproof_is_minimal_and_enough():
    for total in (1, 2, 3, 7, 31, 100, 257):
        leaves = [digest(str(i)).encode() for i in range(total)]
        levels = merkle.derive(dict(enumerate(leaves)), {}, total)
        for _ in range(20):
            held = sorted(R.sample(range(total), R.randint(1, total)))
            need = merkle.missing(np.array(held), total)
            below = {(k, i): {j for j in range(i << k, min(total, (i + 1) << k))} for k, i in need}
            assert not any(below[x] & set(held) for x in below), "a node above a held leaf can be derived"
            # Minimal: no two fetched nodes are siblings under a node that could be fetched instead.
            assert not {(k, i ^ 1) for k, i in need} & set(need)
            fetched = {}
            for k, i in need:
                fetched.setdefault(k, {})[i] = levels[k][i]
            own = merkle.derive({i: leaves[i] for i in held}, fetched, total)
            assert own[-1][0] == levels[-1][0]
            for i in held:
                assert merkle.proof_of(own, i) == merkle.proof_of(levels, i)


def test_frontier_and_blocks_rebuild_every_size():
    for total in [*range(1, 40), 100, 129]:
        leaves = [digest(str(i)).encode() for i in range(total)]
        cuts = sorted({0, total, *R.sample(range(total), min(total, 4))})
        nodes = [n for a, b in zip(cuts, cuts[1:]) for n in merkle.frontier(a, leaves[a:b], total)]
        covered = sum(min(total, (i + 1) << k) - (i << k) for k, i, _ in nodes)
        assert covered == total
        top = merkle.height(total)
        found = {(k, i): d for k, i, d in [*nodes, *merkle.fold_block(nodes, top)]}
        assert found[(top, 0)] == merkle.derive(dict(enumerate(leaves)), {}, total)[-1][0]


def test_nodes_beyond_a_broadcast_are_joined(spark):
    rows = rows_of(60, ["a", None])
    forest = merkle.Forest(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)), ["doc_id"], 3)
    few, many = (sorted(str(sorted(map(str, r["fetched"]))) for r in forest.fetched(b).collect()) for b in (0, 64 << 20))
    assert few == many


def test_sql(spark, tmp_path):
    import pandas as pd

    rows = rows_of(90, ["de", "é", None])
    path = str(tmp_path / "documents.parquet")
    pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"n_chars": "Int64"}).to_parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    got = merkle.op11_merkle_manifest(spark, str(tmp_path)).select(*COLUMNS).collect()
    expected = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.OP11_SQL})").fetchall()
    assert sorted(map(key, got)) == sorted(map(key, expected)) == sorted(map(key, brute_force(rows)))
