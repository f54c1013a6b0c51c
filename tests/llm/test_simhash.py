import random
import re

import pytest
import xxhash

from odd_texts import ODD
from tripmart.llm import simhash

R = random.Random(5)


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, radius):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    u = sorted(parent)
    for i, a in enumerate(u):
        for b in u[:i]:
            if bin(a ^ b).count("1") <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in u}


def _near_copies():
    base = [" ".join(f"w{R.randint(0, 400)}" for _ in range(R.randint(30, 200))) for _ in range(12)]
    out = list(base)
    for _ in range(60):
        w = R.choice(base).split()
        for _ in range(R.randint(0, 2)):
            w[R.randrange(len(w))] = "x"
        out.append(" ".join(w))
    return out


def test_fingerprints_and_components(docs_of):
    texts = [*ODD, *_near_copies(), *ODD]
    fps = [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprints(texts) == fps
    roots = plain_components(set(fps), 2)
    least = {}
    for i, f in enumerate(fps):
        least.setdefault(roots[f], i)
    for r in simhash.near_duplicates(docs_of(texts, extra=True)).collect():
        assert r["fp"] % (1 << 64) == fps[r["doc_id"]]
        assert r["component_id"] == least[roots[fps[r["doc_id"]]]]


def test_masks_cover():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            flips = sum(1 << b for b in R.sample(range(64), radius))
            assert any(not flips & m for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
@pytest.mark.parametrize("bucket", [1, 32])
def test_links_join_exactly_what_is_near(spark, radius, bucket):
    """With buckets of one, every fingerprint that shares a bucket goes the other way."""
    centres = [R.getrandbits(64) for _ in range(6)]
    fps = set(centres)
    for _ in range(120):
        f = R.choice(sorted(fps))
        for _ in range(R.randint(1, 4)):
            f ^= 1 << R.randrange(64)
        fps.add(f)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    links = simhash.fingerprint_links(df, radius, bucket)
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()]
    assert all(0 < bin(a ^ b).count("1") <= radius for a, b in pairs)
    want = plain_components(fps, radius)
    linked = {f: f for f in fps}
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.components(links).collect()}
    linked |= got
    groups = lambda m: sorted(sorted(f for f in m if m[f] == r) for r in set(m.values()))
    assert groups(linked) == groups(want)


def test_long_chain_and_empty(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    got = simhash.components(links).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}
    assert simhash.components(links.limit(0)).count() == 0


def test_one_of_each_group(spark, docs_of):
    texts = ["alpha beta gamma delta", "ALPHA beta gamma delta", "other text entirely here", None, ""]
    docs = docs_of(texts, extra=True)
    assert sorted(r["doc_id"] for r in simhash.one_of_each_group(docs).collect()) == [0, 2, 3]
    # A repeated id, rows without an id, and fully repeated rows.
    rows = [(1, "alpha beta gamma delta"), (1, "other text entirely here"), (1, "alpha beta gamma delta"), (None, "quite alone it stands"), (None, "quite alone it stands"), (2, "alpha beta gamma delta")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each_group(df).collect()), key=str)
    assert kept == sorted([(1, "alpha beta gamma delta"), (1, "other text entirely here"), (None, "quite alone it stands")], key=str)
    assert simhash.one_of_each_group(docs.limit(0)).count() == 0


def test_repeated_ids_beside_a_column_of_the_helper_name(docs_of):
    docs = docs_of(["one two three four", "other words stand here", "one two three four"]).selectExpr(
        "IF(doc_id = 2, 0, doc_id) AS doc_id", "text", "lang", "source", "n_chars", "'x' AS __print", "'y' AS __PRINT_"
    )
    kept = simhash.one_of_each_group(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [0, 1]
