import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd_texts import LONG, ODD
from tripmart.llm import lm

R = random.Random(8)
WORDS = ["the", "of", "and", "river", "stone", "walking", "é", "x" * 80]


def _texts(n):
    return [" ".join(R.choices(WORDS, weights=[9, 7, 5, 3, 3, 2, 1, 1], k=R.randint(0, 60))) for _ in range(n)]


#: Tests need no large tables, and most words should take the way of the rare ones.
SMALL = {"table_bits": 18, "frequent_words": 4}


def test_base_scores_are_exact(spark, docs_of):
    texts = _texts(60) + ODD + ["neverseen words here", None]
    train = F.col("doc_id") % 3 != 1
    got = {r["doc_id"]: r for r in lm.score(docs_of(texts, extra=True), train, **SMALL).collect()}
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in enumerate(texts)}
    count = Counter(w for i, ws in tokens.items() if i % 3 != 1 for w in ws)
    n, v = count.total(), len(count)
    assert len(got) == len(texts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0 and r["bits_per_byte"] > 0


def test_model_beats_the_base_on_new_texts(docs_of):
    """Texts of two kinds: a word tells which words may follow, which the unigram base cannot use."""
    kinds = (["the", "river", "of", "stone"], ["la", "rio", "de", "piedra"])
    texts = [" ".join(R.choices(kinds[i % 2], weights=[6, 2, 5, 2], k=R.randint(5, 60))) for i in range(900)]
    got = lm.score(docs_of(texts), F.col("doc_id") % 3 != 1, **SMALL).filter("NOT trained").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def _model(texts):
    streams = [lm.stream_of(lm.words_of(t)) for t in texts]
    singles, pairs = {}, {}
    for s in streams:
        padded = b"\n\n" + s
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            for table, key in ((singles, b), (pairs, a * 256 + b)):
                of = table.setdefault(key, {})
                of[c] = of.get(c, 0) + 1
    codes = lm.build_codes(singles, pairs, 18)
    counts = [np.zeros(2 << 18, np.uint32) for _ in range(lm.CONTEXTS)]
    _, bit, slots = lm.decisions(codes, streams)
    for t, s in zip(counts, slots):
        np.add.at(t, (s.astype(np.int64) << 1) | bit, np.uint32(1))
    return lm.Model(codes, [lm.pack(t[0::2], t[1::2]) for t in counts], lm.first_weights())


def test_a_text_scores_alone_as_in_any_batch():
    texts = _texts(50) + [LONG, ""]
    model = _model(_texts(200))
    streams = [lm.stream_of(lm.words_of(t)) for t in texts]
    together, _ = lm.score_streams(model, streams)
    for i in (0, 7, 49, 50, 51):
        assert lm.score_streams(model, [streams[i]])[0][0] == pytest.approx(together[i], rel=1e-5)


def test_next_byte_probabilities_add_up():
    """Over all 256 continuations of a prefix, the chances of the next byte sum to one at most."""
    model = _model(_texts(100))
    for prefix in (b"", b"the ri", b"walk", b"the of z"):
        whole = [prefix + bytes([b]) for b in range(256)]
        ends, bit, slots = lm.decisions(model.codes, whole)
        heads = np.concatenate(([0], ends[:-1]))
        x, gate = lm.inputs_of(model, slots)
        # With even weights at every decision the mixture depends on nothing but the context.
        log2 = np.zeros(len(bit))
        dot = sum(c.astype(float) / lm.ODDS * 0.4 for c in x)
        p = 1 / (1 + np.exp(-dot))
        log2 = np.log2(np.where(bit == 1, p, 1 - p))
        known = lm.decisions(model.codes, [prefix])[0][0] if prefix else 0
        chance = [2 ** log2[h + known : e].sum() for h, e in zip(heads, ends)]
        assert 0.8 < sum(chance) <= 1 + 1e-9


def test_without_training_rows_and_empty(docs_of):
    docs = docs_of(["a b", None])
    got = lm.score(docs, F.lit(False), **SMALL).collect()
    assert len(got) == 2 and all(r["train_tokens"] == 0 and r["base_score"] == 0.0 for r in got)
    assert lm.score(docs.limit(0), F.lit(True), **SMALL).count() == 0


def test_every_training_text_teaches_tables_and_weights(docs_of, monkeypatch):
    """The share that fits the weights is as large as it is, and the tables count it afterwards."""
    monkeypatch.setattr(lm, "WEIGHT_SHARE", 2, raising=True)
    texts, fitted = _texts(1200), []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda sample, model: fitted.append(sample.count()) or learn(sample, model))
    docs = docs_of(texts)
    model = lm.train_model(docs, F.lit(True), lm.gather_counts(docs), 18)
    counts = [np.zeros(2 << 18, np.uint32) for _ in range(lm.CONTEXTS)]
    _, bit, slots = lm.decisions(model.codes, [lm.stream_of(lm.words_of(t)) for t in texts])
    for t, s, found in zip(counts, slots, model.tables):
        np.add.at(t, (s.astype(np.int64) << 1) | bit, np.uint32(1))
        assert (found == lm.pack(t[0::2], t[1::2])).all()
    assert fitted == [docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).count()] and fitted[0] > 400


def test_weights_are_carried_through_a_whole_text():
    """A long text, among many others and alone, scores as one sequence in which every decision learns from all before."""
    texts = _texts(60) + [" ".join(_texts(400))]
    model = _model(_texts(200))
    streams = [lm.stream_of(lm.words_of(t)) for t in texts]
    together, _ = lm.score_streams(model, streams)
    ends, bit, slots = lm.decisions(model.codes, streams)
    x, gate = lm.inputs_of(model, slots)
    for i in (3, 60):
        w, log2 = model.weights.astype(float).copy(), 0.0
        for t in range(ends[i - 1], ends[i]):
            s = np.array([*(c[t] / lm.ODDS for c in x), 0.5])
            p = 1 / (1 + math.exp(-(w[gate[t]] @ s)))
            log2 += math.log2(max(1 - abs(p - bit[t]), 1e-7))
            w[gate[t]] -= lm.RATE * (p - bit[t]) * s
        assert together[i] == pytest.approx(log2, rel=1e-4)
        assert lm.score_streams(model, [streams[i]])[0][0] == pytest.approx(log2, rel=1e-4)


def test_lanes_hold_every_decision_once_and_in_order(monkeypatch):
    """Decisions of one text with one gate lie one after another, so that a step needs no look-up of weights; tables count the same ones."""
    texts = _texts(40) + [LONG, ""]
    model = _model(_texts(200))
    streams = [lm.stream_of(lm.words_of(t)) for t in texts]
    ends, bit, slots = lm.decisions(model.codes, streams)
    x, gate = lm.inputs_of(model, slots)
    signed = np.stack([*x, np.ones(len(bit), np.int8)], axis=1) * np.where(bit == 1, 1, -1)[:, None]
    for cut in (500, 1 << 20):
        monkeypatch.setattr(lm, "CUT_BYTES", cut)
        packed, first, size, text, of = lm.lanes_of(model, streams)
        assert size.sum() == len(bit) and len(packed) >= len(bit) + lm.STEPS
        for p, n, t, g in zip(first.tolist(), size.tolist(), text.tolist(), of.tolist()):
            inside = np.arange(ends[t - 1] if t else 0, ends[t])
            assert (packed[p : p + n].view(np.int8).reshape(-1, 4) == signed[inside[gate[inside] == g]]).all()
    counts = [np.zeros(2 << 18, np.uint32) for _ in range(lm.CONTEXTS)]
    lm.count_streams(model.codes, streams, counts)
    for table, s in zip(counts, slots):
        assert (table == np.bincount((s.astype(np.int64) << 1) | bit, minlength=2 << 18)).all()


def test_bytes_that_recur_in_a_context_are_spelled_once(monkeypatch):
    """Counting takes the path of a byte once for all its places with the same context, and counts each place."""
    streams = [lm.stream_of(lm.words_of(t)) for t in _texts(300) + [LONG]]
    model, spelled = _model(_texts(200)), []
    spell = lm._spell
    monkeypatch.setattr(lm, "_spell", lambda codes, at: spelled.append(len(at)) or spell(codes, at))
    counts = [np.zeros(2 << 18, np.uint32) for _ in range(lm.CONTEXTS)]
    lm.count_streams(model.codes, streams, counts)
    assert sum(spelled) < sum(map(len, streams))
    _, bit, slots = lm.decisions(model.codes, streams)
    for table, s in zip(counts, slots):
        assert (table == np.bincount((s.astype(np.int64) << 1) | bit, minlength=2 << 18)).all()
    lm.count_streams(model.codes, [], counts)


def test_words_are_found_and_counted_without_python_objects():
    texts = _texts(40) + ODD + [LONG, "", None, " \t\n\x0b\x0c\r", " aB\x1cc  d\u0085e\u00a0f ", "\u0130K"]
    words = lm.words_in(pa.array(texts, pa.string()))
    expected = [lm.words_of(t) for t in texts]
    assert words.to_pylist() == expected
    assert lm.streams_in(words) == [lm.stream_of(w) for w in expected]
    for known in ({b"the": 1.5, b"": 0.25}, {}):
        got = lm.count_words(words, pa.array(list(known), pa.binary()), np.array(list(known.values())))
        for i, w in enumerate(expected):
            tokens = Counter([*w, b""])
            assert got["n_tokens"][i] == tokens.total() and got["n_near"][i] == sum(tokens[k] for k in known)
            assert got["near"][i] == pytest.approx(sum(tokens[k] * v for k, v in known.items()))
            rare = dict(zip(got["rare"][i].as_py(), got["times"][i].as_py()))
            assert rare == {k: n for k, n in tokens.items() if k not in known}
