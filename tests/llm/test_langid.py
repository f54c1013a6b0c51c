import pytest
from pyspark.sql import functions as F

from odd_texts import ODD
from tripmart.llm import langid
from tripmart.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(read_table(spark, SF, "documents"), ~langid.held_out())


def test_held_out_accuracy(spark):
    found = langid.op7_language_id(spark, SF).join(read_table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    got = found.filter("held_out AND lang_pred <> 'und'").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.min("score"), F.max("score")).first()
    assert got[0] > 0.99 and 0 <= got[1] <= got[2] <= 1


def test_wrong_labels_do_not_win(spark):
    """A tenth of the English sample carries another language's label; English texts keep theirs."""
    docs = read_table(spark, SF, "documents")
    wrong = (F.col("lang") == "en") & (F.xxhash64("doc_id") % 10 == 0)
    noisy = docs.withColumn("lang", F.when(wrong, "fr").otherwise(F.col("lang")))
    model = langid.fit(noisy, ~langid.held_out())
    found = langid.identify(docs.filter(langid.held_out()), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98


def test_odd_texts(docs_of, model):
    got = {r["doc_id"]: r for r in langid.identify(docs_of(ODD, extra=True), model).collect()}
    assert len(got) == len(ODD)
    for i, text in enumerate(ODD):
        lettered = any(c.isalpha() for c in text or "")
        assert (got[i]["lang_pred"] != "und") == lettered
        assert got[i]["rejected"] or lettered


def test_rejects_only_what_is_far(model):
    far = ["Съешь же ещё этих мягких французских булок да выпей чаю " * 5, "日本語の文章をここに書きます" * 20, "12345 67890"]
    assert model.predict(far)[2] == [True] * 3
    assert model.predict(["The and of the thing was in the end", "la de los que el", "Osrañ."])[2] == [False] * 3


def test_one_text_answers_as_in_a_batch(model):
    texts = ["the and of", "la que de los", "und der die", "x" * 3000] * 50
    together = model.cosines(texts)
    alone = model.cosines(texts[1:2])
    assert abs(together[1] - alone[0]).max() < 1e-5


def test_no_training_rows_and_empty_table(spark, docs_of, model):
    docs = docs_of(["the and of", None])
    blank = langid.fit(docs, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(docs, blank).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_filter_keeps_columns(docs_of, model):
    docs = docs_of(["the and of the thing", "12 34", None], extra=True)
    kept = langid.keep_identified(docs, model)
    assert kept.schema == docs.schema and [r["doc_id"] for r in kept.collect()] == [0]


def test_labelled_texts_without_letters_do_not_stop_rejection(spark, docs_of, model):
    """Null, empty and digits-only training texts with a language; texts of unlearned languages are still rejected."""
    docs = read_table(spark, SF, "documents")
    odd = docs_of([t for t in (None, "", "12 345", " \n") for _ in range(30)], first=10**9).select(*docs.columns)
    spoiled = langid.fit(docs.unionByName(odd), ~langid.held_out())
    unlearned = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. " * 2,
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. " * 2,
        "Съешь же ещё этих мягких французских булок да выпей чаю " * 5,
    ]
    assert spoiled.predict(unlearned)[2] == [True] * 3
    assert spoiled.languages == model.languages and (spoiled.floors == model.floors).all()
    known = langid.identify(docs.filter(langid.held_out()), spoiled).filter("lang_pred <> 'und'")
    assert known.agg(F.avg(F.col("rejected").cast("int"))).first()[0] < 0.01


def test_every_language_is_learned_however_many(spark):
    """300 languages, each with words of its own: no most frequent ones, and a few texts of each."""
    rows = []
    for lang in range(300):
        words = [f"{chr(97 + lang % 26)}{chr(97 + lang // 26)}{v}" for v in ("aq", "ez", "ix", "ow", "uk")]
        rows += [(lang * 20 + i, " ".join(words[(i + k) % 5] for k in range(12)), f"l{lang:03}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    assert len(set(model.languages)) == 300


def test_one_language_needs_no_window(spark, docs_of):
    docs = docs_of([f"the words of text number {i} are plain" for i in range(50)])
    model = langid.fit(docs, F.lit(True), sample_rows=10)
    assert set(model.languages) == {"en"}


def test_repeated_ids_give_one_model(spark):
    rows = [(i % 7, f"text {i} of some words", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    one, two = langid.fit(docs, F.lit(True)), langid.fit(docs.orderBy(F.desc("text")), F.lit(True))
    assert (one.centroids == two.centroids).all() and (one.idf == two.idf).all()
