import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_texts import ODD
from tripmart.llm import toxicity
from tripmart.llm.common import read_table

SF = "/root/testdata/sf0.1"
RNG = np.random.default_rng(4)


@pytest.fixture(scope="module")
def tables(spark):
    return read_table(spark, SF, "documents"), read_table(spark, SF, "labels")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables, ~toxicity.held_out())


def test_held_out_quality(tables, model):
    docs, labels = tables
    rows = toxicity.toxicity(docs.filter(toxicity.held_out()), model).join(labels, "doc_id").select("score", "toxic").collect()
    score, toxic = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    said = score >= toxicity.THRESHOLD
    assert toxic[said].mean() > 0.9 and said[toxic == 1].mean() > 0.8


def test_labels_of_held_out_rows_are_not_used(tables, model):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, turned, ~toxicity.held_out())
    assert again.weights == model.weights and np.array_equal(again.trees.value, model.trees.value)


def test_odd_texts(docs_of, model):
    got = toxicity.toxicity(docs_of(ODD, extra=True), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity(docs_of([]), model).count() == 0


def test_filter_keeps_columns(docs_of, model):
    docs = docs_of(["Be thwhat moron pathetic trash clown you scum", "the thing was there", None], extra=True)
    kept = toxicity.keep_civil(docs, model)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_without_labels(docs_of, tables):
    docs = docs_of(["a b", None])
    model = toxicity.fit(docs, tables[1].limit(0), F.lit(True))
    assert toxicity.toxicity(docs, model).filter("score < 0.5").count() == 2


def test_isotonic_is_the_best_increasing_fit():
    x, y = np.arange(60.0), (RNG.random(60) < np.linspace(0.1, 0.9, 60)).astype(float)
    at, p = toxicity.isotonic(x, y)
    fit = np.interp(x, at, p)
    assert (np.diff(fit) >= -1e-12).all()
    # Max-min formula of isotonic regression.
    want = [max(min(y[a : b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert np.allclose(fit, want)


def test_boosting_learns_an_interaction():
    x = RNG.random((2000, len(toxicity.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = toxicity.boost(x[:1500], y[:1500], np.ones(1500))
    assert ((trees.margin(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.9


@pytest.mark.parametrize("word, core", [("M0ron!", "moron"), ("tr@sh", "trash"), ("(Clown)", "clown"), ("***", ""), ("12", "12"), ("s.c.u.m", "scum")])
def test_obfuscated_words_fold(word, core):
    assert toxicity.fold(word) == core
