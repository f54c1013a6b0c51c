"""Each stage of the corpus pipeline against what its own operator says of its input."""

import corpus_pipeline
from tripmart.llm import langid, toxicity, winnow
from tripmart.llm.common import read_table
from tripmart.operators.lookup import materialize

SF = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = read_table(spark, SF, "documents")
    benchmark = [(str(r["item_id"]), r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF))
        before, after = {r["doc_id"]: r["text"] for r in docs.collect()}, [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(set(after)) == len(after) and set(after) <= set(before)
        if name != "bpe":
            assert out.schema == docs.schema
        if name == "language_id":
            gone = langid.identify(docs, langid.fit(docs, ~langid.held_out())).filter("rejected")
            assert set(before) - set(after) == {r["doc_id"] for r in gone.collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, read_table(spark, SF, "labels"), ~toxicity.held_out())
            high = toxicity.toxicity(docs, model).filter(f"score >= {toxicity.THRESHOLD}")
            assert set(before) - set(after) == {r["doc_id"] for r in high.collect()} != set()
        if name == "near_dedup":
            from test_simhash import plain_components, plain_fingerprint

            fps = {i: plain_fingerprint(t) for i, t in before.items()}
            roots, least = plain_components(set(fps.values()), 2), {}
            for i in sorted(before):
                least.setdefault(roots[fps[i]], i)
            assert sorted(after) == sorted(least.values())
        if name == "decontamination":
            said = {i: winnow.brute_force(t, benchmark) for i, t in before.items()}
            assert set(after) == {i for i, (n, hit, _, _) in said.items() if not winnow.is_contaminated(n, hit)}
        if name == "bpe":
            assert set(after) == set(before)
        docs = out


def test_registered_and_rows_agree(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *[n for n in names if n.startswith("op")]} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
