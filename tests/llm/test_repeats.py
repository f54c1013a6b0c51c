import os
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from odd_texts import ODD
from tripmart.llm import repeats
from tripmart.llm.induced import Buckets, Shard, sorted_order

R = random.Random(13)


def brute_force(texts, length):
    """Removed bytes of each text by counting every string of ``length`` bytes."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def answer(docs, length, **limits):
    rows = repeats.remove_repeats(docs, length, **limits).collect()
    return sorted((r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), sha256(bytes(r["kept"])).hexdigest()) for r in rows)


def prose(n):
    words = ["alpha", "beta", "gamma", "délta", "of", "the", "Ω", "\x00", "x", "epsilon", "zeta"]
    return " ".join(R.choices(words, k=n))


def shared_texts():
    passages = [prose(R.randint(20, 90)) for _ in range(5)]
    texts = [prose(R.randint(0, 60)) + R.choice(passages)[R.randint(0, 40) :] + prose(R.randint(0, 60)) for _ in range(40)]
    return texts + texts[:5] * 3 + [passages[0]] * 30 + ["ab" * 300, "a" * 700, "a" * 199, "a" * 200]


@pytest.mark.parametrize(
    "length, limits",
    [
        (200, {}),
        (64, {"gram": 16}),
        # Several small shards, grams dealt over many of them, and queues in scratch files.
        (200, {"shard_bytes": 3000, "memory": 4000}),
        (40, {"gram": 8, "shard_bytes": 500}),
    ],
)
def test_matches_brute_force(spark, docs_of, length, limits):
    texts = ODD + shared_texts()
    docs = docs_of(texts, extra=True).selectExpr("*", "1 AS k1", "2 AS runs", "3 AS starts").repartition(5)
    assert answer(docs, length, **limits) == sorted(brute_force(texts, length))


def test_one_passage_in_every_text_is_split(spark, docs_of):
    """A passage on every row: its inner pieces are one, its edges are dealt over shards."""
    passage = prose(60)
    texts = [f"{i} {prose(12)} {passage} {prose(12)} {i * 7919}" for i in range(150)]
    assert answer(docs_of(texts), 200, shard_bytes=2000) == sorted(brute_force(texts, 200))


def test_repeated_rows_and_null_ids(spark):
    text, other = prose(80), prose(80)
    rows = [(None, text), (None, text), (1, other), (1, other), (1, prose(90)), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answer(docs, 200) == sorted(brute_force([t for _, t in rows], 200))


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_digests(spark, docs_of, tmp_path):
    texts = shared_texts()
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = repeats.op13_suffix_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == brute_force(texts, 200)


def test_pieces_hold_every_start_once_and_equal_strings_choose_alike():
    texts = [t.encode() for t in shared_texts()]
    texts.append((prose(30) * 9000).encode())  # several chunks
    seen, gram_of = Counter(), {}
    for text, start, starts, gram, digest in repeats.pieces(texts, 200, 32):
        for t, a, n, g in zip(text.tolist(), start.tolist(), starts.tolist(), gram.tolist()):
            for i in range(a, a + n):
                if t < len(texts) - 1 or i % 997 == 0:
                    string = texts[t][i : i + 200]
                    assert gram_of.setdefault(string, g) == g
            seen[t] += n
    assert [seen[t] for t in range(len(texts))] == [max(0, len(b) - 199) for b in texts]


@pytest.mark.parametrize("memory", [1 << 30, 5000, 200])
def test_suffix_order_and_shared_prefixes(memory):
    for _ in range(60):
        limit = R.choice([3, 20, 200])
        alphabet = R.choice([b"a", b"ab", b"abc\x00\xff", bytes(range(256))])
        words = [bytes(R.choices(alphabet, k=R.randint(1, 25))) for _ in range(4)]
        bodies = [b"".join(R.choices(words, k=R.randint(1, 9))) for _ in range(R.randint(1, 20))]
        shard = Shard(bodies, limit, memory)
        rest = {int(a) + i: b[i:] for a, b in zip(shard.starts, bodies) for i in range(len(b))}
        found = [(int(p), int(x)) for pos, lcp in shard.suffixes() for p, x in zip(pos, lcp)]
        assert sorted(p for p, _ in found) == sorted(rest)
        for (p, _), (q, shared) in zip(found, found[1:]):
            a, b = rest[p][:limit], rest[q][:limit]
            assert a >= b
            assert shared == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_queue_and_sort_beyond_memory():
    import numpy as np

    queue, told = Buckets(1000), []
    for i in range(300):
        block = np.arange(i, i + 7), np.arange(7, dtype=np.uint64), np.full(7, i % 200, np.uint8)
        queue.push(5, block)
        told.append(block)
    assert queue.file is not None
    assert np.concatenate([p for p, _, _ in queue.forward(5)]).tolist() == np.concatenate([b[0] for b in told]).tolist()
    assert np.concatenate([p for p, _, _ in queue.backward(5)]).tolist() == np.concatenate([b[0] for b in told])[::-1].tolist()
    for n, top in [(50_000, 10), (50_000, 1 << 40), (3, 5)]:
        key = np.array([R.randrange(top) for _ in range(n)], dtype=np.uint64)
        order = sorted_order(key, 1000)
        assert sorted(order.tolist()) == list(range(n)) and (np.diff(key[order].astype(np.int64)) >= 0).all()


def test_shared_prefixes_are_those_of_the_bytes():
    """Any byte, prefixes of any length up to the limit, ends of bodies."""
    bodies = [b"\xff\x00" * 90, b"\xff\x00" * 60 + b"\xfe" * 30, b"\xff" * 33, b"\x00" * 8, b"\x00" * 9 + b"\xff", b""]
    shard = Shard(bodies, 50)
    rest = {a + k: body[k : k + 50] for a, body in zip(shard.starts.tolist(), bodies) for k in range(len(body))}
    order = np.array(sorted(rest, key=lambda at: (rest[at], at)))
    found = shard._shared(order)
    want = [len(os.path.commonprefix([rest[p], rest[q]])) for p, q in zip(order[:-1].tolist(), order[1:].tolist())]
    assert found[1:].tolist() == want


def test_only_what_whole_suffixes_need_is_induced():
    """Classes are those of the strings, and most shorter suffixes are left out."""
    for limit in (20, 60):
        tail = prose(9).encode()
        bodies = [prose(R.randint(2, 30)).encode()[: limit + R.randint(-5, 25)] + R.choice([b"", tail]) for _ in range(300)] + [b"ab" * 70, b"a" * 90] * 2
        shard = Shard(bodies, limit)
        string = {int(a) + i: b[i : i + limit] for a, b in zip(shard.starts, bodies) for i in range(len(b) - limit + 1)}
        found = [(p, c) for pos, number in shard.classes() for p, c in zip(pos.tolist(), number.tolist())]
        assert sorted(p for p, _ in found) == sorted(string)
        assert len({c for _, c in found}) == len(set(string.values())) == len({(c, string[p]) for p, c in found})
    shard = Shard([prose(300).encode()[:260] for _ in range(50)], 200)
    assert sum(len(pos) for pos, _ in shard.suffixes(whole=True)) < shard.n // 2


def test_pieces_that_share_no_side_are_not_compared(spark, docs_of):
    """Texts that have a gram in common and nothing else: their pieces meet no other."""
    gram = "gram of thirty-two bytes in all."
    texts = [f"{prose(40)}{gram}{prose(40)}" for _ in range(400)]
    copied = prose(25) + texts[0][200:500]
    _, distinct, _ = repeats.distinct_pieces(docs_of([*texts, copied]), 200, 32)
    kept = repeats.comparable(distinct)
    assert 0 < kept.count() < distinct.count()
    assert answer(docs_of([*texts, copied]), 200) == sorted(brute_force([*texts, copied], 200))


def test_runs_of_many_rows_become_spans():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
    rows = [[(0, 1)], None, [(50, 3), (0, 5), (14, 1)], [], [(15, 1), (0, 5)], [(0, 30), (2, 1)]]
    runs = pa.array([None if x is None else [{"start": a, "size": n} for a, n in x] for x in rows], kind)
    want = [[(0, 10)], [], [(0, 24), (50, 62)], [], [(0, 14), (15, 25)], [(0, 39)]]
    assert repeats.cut_spans(runs, 10) == want
    assert repeats.cut_spans(runs.slice(2, 3), 10) == want[2:5]
    assert repeats.cut_spans(runs.slice(1, 1), 10) == [[]] and repeats.cut_spans(runs.slice(0, 0), 10) == []
