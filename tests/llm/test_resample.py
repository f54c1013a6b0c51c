import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from odd_texts import ODD
from tripmart.llm import resample
from tripmart.operators.lookup import materialize

R = random.Random(12)
WORDS = ["Alpha", "b", "c3", "Délta", "É", "the", "of", "x" * 70, "y" * 200]


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute_force(docs, target, percent=5):
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in features(text)[1]:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    rows, ranked = [], []
    for i, (doc_id, text) in enumerate(docs):
        n, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in found)
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None])
        if n >= 20:
            ranked.append((-score, doc_id is not None, doc_id or 0, i))
    for rank, x in enumerate(sorted(ranked)[: percent * len(ranked) // 100], 1):
        rows[x[-1]][4] = rank
    return rows


def texts(n):
    return [" ".join(R.choices(WORDS, k=R.randint(0, 60))) for _ in range(n)]


def as_sorted(rows):
    return sorted([tuple(r) for r in rows], key=str)


@pytest.mark.parametrize("percent, segments, n", [(5, 7, 400), (100, 5, 150), (33, 1, 90), (0, 4, 30)])
def test_matches_brute_force(spark, docs_of, percent, segments, n):
    docs, target = ODD + texts(n), texts(9) + [None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = resample.resample(docs_of(docs, extra=True).repartition(4), bench, percent, segments)
    expected = brute_force(list(enumerate(docs)), target, percent)
    assert as_sorted(got.collect()) == as_sorted(expected)


def test_ties_repeats_and_null_ids(spark):
    same = " ".join(["one two three"] * 10)
    rows = [(None, same)] * 3 + [(5, same)] * 60 + [(i, t) for i, t in enumerate(texts(40))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = docs.limit(0)
    got = resample.resample(docs, bench, 50, 6)
    assert as_sorted(got.collect()) == as_sorted(brute_force(rows, [], 50))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert resample.resample(none, none).collect() == []


def test_short_runs_and_merged_samples_give_the_same_ranks(spark, docs_of):
    docs = docs_of(texts(300)).repartition(5)
    gain = resample.gains(resample.bucket_counts(docs), np.zeros(10000, np.int64))
    want = as_sorted(resample.ranked(materialize(resample.scored_runs(docs, gain)), 60, 3).collect())
    for run_rows, samples, gathered in [(1, 4, 1 << 20), (20, 3, 10), (50, 2, 1)]:
        runs = materialize(resample.scored_runs(docs, gain, run_rows=run_rows, samples=samples))
        assert as_sorted(resample.ranked(runs, 60, 9, samples, gathered).collect()) == want


def test_features_do_not_depend_on_the_chunk():
    docs = [*ODD, *texts(20)]
    for chunk in (1, 7, 64, 1 << 20):
        got = [[] for _ in docs]
        words = np.zeros(len(docs), np.int64)
        for buckets, whose, owners in resample.feature_parts(docs, chunk):
            words += np.bincount(owners, minlength=len(docs))
            for b, d in zip(buckets.tolist(), whose.tolist()):
                got[d].append(b)
        assert [(w, sorted(g)) for w, g in zip(words.tolist(), got)] == [(n, sorted(f)) for n, f in map(features, docs)]


def test_segments_are_about_equal(spark, docs_of):
    docs = docs_of([f"{' '.join(WORDS)} " * 3 + str(i) for i in range(2000)]).repartition(6)
    gain = resample.gains(resample.bucket_counts(docs), np.zeros(10000, np.int64))
    runs = materialize(resample.scored_runs(docs, gain, samples=64))
    cuts = resample.splitters(runs, 8, 64)
    rows = sorted((-r["score"], r["doc_id"], r["run"], r["place"]) for r in runs.collect())
    places = [0, *[sum(x <= c for x in rows) for c in cuts], len(rows)]
    assert len(cuts) == 7 and max(b - a for a, b in zip(places, places[1:])) <= 2000 / 8 + 2000 / 64 * 2
