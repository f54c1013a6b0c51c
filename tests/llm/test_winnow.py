import random

import pytest

from odd_texts import ODD
from tripmart.llm import winnow

R = random.Random(3)
VOCAB = ["alpha", "b", "c3", "délta", "É", "the", "of"]


def _texts(n, low, high):
    return [" ".join(R.choice(VOCAB) for _ in range(R.randint(low, high))) for _ in range(n)]


def _case():
    items = [(str(i), t) for i, t in enumerate(_texts(12, 1, 30) + [None, "", "one two", "One, TWO!"])]
    docs = _texts(40, 0, 120) + ODD
    for _ in range(30):
        t = R.choice(items)[1] or "x"
        w = t.split()
        a = R.randint(0, len(w))
        docs.append(" ".join(_texts(1, 0, 20) + w[a:] + _texts(1, 0, 20)).upper().replace(" ", R.choice([" ", ", ", "-"])))
    return docs, items


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_matches_brute_force(spark, docs_of, broadcast_bytes):
    docs, items = _case()
    bench = spark.createDataFrame([(int(i), t) for i, t in items], "item_id bigint, text string")
    got = winnow.decontaminate(docs_of(docs, extra=True), bench, broadcast_bytes).collect()
    for r in got:
        n, hit, found, _ = winnow.brute_force(docs[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, found), docs[r["doc_id"]]


def test_every_shared_window_shares_a_kept_gram():
    import numpy as np

    for span in range(1, 14):
        words = [bytes([97 + R.randint(0, 3)]) for _ in range(200)]
        hashes, _, _ = winnow.hash_words([b" ".join(words)])
        at, _ = winnow.kept_grams(hashes, np.zeros(len(hashes), np.int64), span)
        k, w = winnow.gram_sizes(span)
        assert k + w - 1 == span
        for p in range(len(words) - span + 1):
            alone, _ = winnow.kept_grams(hashes[p : p + span], np.zeros(span, np.int64), span)
            assert len(alone) == 1 and p + alone[0] in at


def test_empty_and_equal_ids(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert winnow.decontaminate(docs_of(ODD), none).filter("n_hit > 0").count() == 0
    assert winnow.decontaminate(docs_of([]), none).count() == 0
    twice = spark.createDataFrame([(None, "one two"), (None, "one two"), (1, "two three")], "item_id bigint, text string")
    row = winnow.decontaminate(docs_of(["zero one two three"]), twice).first()
    assert (row["n_hit"], row["n_items"], row["items"]) == (3, 2, ["", "1"])


def test_filter_keeps_columns_and_clean_rows(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = docs_of([item, f"{item} " + "clean word here " * 300, "clean", None, ""], extra=True)
    kept = winnow.drop_contaminated(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]


def test_texts_of_one_word_cost_no_product_of_lengths(spark, docs_of):
    """Equal contexts are one row on both sides, however often a text repeats itself."""
    bench = spark.createDataFrame([(1, "a " * 5000), (2, "a " * 4000 + "b")], "item_id bigint, text string")
    docs = docs_of(["a " * 20_000 + "b", "a " * 6000, "a " * 12, None])
    got = {r["doc_id"]: r for r in winnow.decontaminate(docs, bench).collect()}
    assert [(got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) for i in range(4)] == [
        (20_001, 20_001, ["1", "2"]), (6000, 6000, ["1", "2"]), (12, 0, []), (0, 0, []),
    ]


def test_repeated_ids_and_columns_of_helper_names(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = docs_of([item, "clean", item]).selectExpr("CASE WHEN doc_id < 2 THEN 7 END AS doc_id", "text", "'x' AS text_key", "1 AS n_hit", "2 AS spots")
    got = winnow.decontaminate(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in got) == [(0, 20), (7, 0), (7, 20)]
    kept = winnow.drop_contaminated(docs, bench)
    assert kept.schema == docs.schema and [r["text"] for r in kept.collect()] == ["clean"]
