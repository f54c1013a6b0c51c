"""Target-distribution importance resampling.

Hashed n-gram features of the corpus and of a target set give each bucket a
gain; a text's weight is the sum of the gains of its features, and a fixed
draw per document added to it makes the highest scores a weighted sample
without replacement.

Weights are scored over arrays: CRC-32 is linear, so the checksum of a run of
words follows from those of its words by table look-ups over whole columns.
The ranking is a parallel sort by regular sampling: runs sorted inside tasks
give regular samples, these give splitters, rows are exchanged by splitter and
merged where they arrive, and prefix counts of the segments make local places
exact ranks. Only segments that a drawn rank can lie in are exchanged.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import read_table, slices
from tripmart.llm.winnow import FOLD
from tripmart.operators.lookup import discard, materialize

BUCKETS, NGRAM = 10_000, 3
MIN_WORDS, DRAWN_PERCENT, SEED = 20, 5, 42
#: Bytes of text whose features are held at a time; rows of a locally sorted run; regular samples it gives.
CHUNK, RUN_ROWS, SAMPLES = 1 << 20, 1 << 17, 256
#: Samples up to which they are put in order in one place; above, groups of runs merge theirs first.
GATHERED = 1 << 20


# -- features ----------------------------------------------------------------------


def _shift_tables(longest: int) -> np.ndarray:
    """``tables[n, k, byte]``: what n further bytes make of a checksum byte at place k (zlib's polynomial)."""
    step = np.zeros((4, 256), dtype=np.uint32)
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    step[0] = crc
    for k in range(1, 4):
        step[k] = np.arange(256, dtype=np.uint32) << (8 * (k - 1))
    tables = np.zeros((longest + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << (8 * k)
    for n in range(1, longest + 1):
        before = tables[n - 1]
        tables[n] = step[0][before & 255] ^ (before >> 8)
    return tables


LONGEST = 64
_TABLES = _shift_tables(LONGEST)


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums after so many zero bytes more: ``crc32(a + b) == shifted(crc32(a), len(b)) ^ crc32(b)``."""
    out = crc
    while True:
        now = np.minimum(n, LONGEST)
        flat, base = _TABLES.reshape(-1), now.astype(np.int64) * 1024
        out = (
            flat[base + (out & 255)] ^ flat[base + 256 + ((out >> 8) & 255)]
            ^ flat[base + 512 + ((out >> 16) & 255)] ^ flat[base + 768 + (out >> 24)]
        )
        n = n - now
        if not n.any():
            return out


def _word_parts(texts: list[str | None], chunk: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """Words of folded texts and the text each is from, about ``chunk`` bytes at a time.

    A part that ends inside a text is followed by one that starts with that
    text's last words again (marked by owner ``-1 - text``), so no run of
    words is lost and none is counted twice.
    """
    words: list[bytes] = []
    owner: list[int] = []
    room = chunk
    for d, text in enumerate(texts):
        folded = (text or "").encode().translate(FOLD)
        a = 0
        while a < len(folded):
            b = a + room
            if b < len(folded):
                b = folded.find(b" ", b)
                b = len(folded) if b < 0 else b
            else:
                b = len(folded)
            more = folded[a:b].split()
            words += more
            owner += [d] * len(more)
            room -= b - a
            a = b
            if room <= 0:
                yield words, owner
                same = [i for i in range(max(0, len(words) - NGRAM + 1), len(words)) if owner[i] in (d, -1 - d)]
                words, owner, room = [words[i] for i in same], [-1 - d] * len(same), chunk
    if words:
        yield words, owner


def feature_parts(texts: list[str | None], chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of features, the text each is from, and the texts of the words, part by part."""
    for words, marked in _word_parts(texts, chunk):
        crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        mark = np.asarray(marked, dtype=np.int64)
        again = mark < 0
        owner = np.where(again, -1 - mark, mark)
        spaced = shifted(np.full(len(words), zlib.crc32(b" "), dtype=np.uint32), size) ^ crc
        run, found, whose = crc, [crc[~again]], [owner[~again]]
        for k in range(1, NGRAM):
            if len(words) <= k:
                break
            run = shifted(run[:-1], size[k:] + 1) ^ spaced[k:]
            # A run counts in the part in which its last word is new.
            keep = (owner[:-k] == owner[k:]) & ~again[k:]
            found.append(run[keep])
            whose.append(owner[k:][keep])
        buckets = np.concatenate(found) % np.uint32(BUCKETS)
        yield buckets.astype(np.int64), np.concatenate(whose), owner[~again]


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of every feature bucket in all texts: one row per task and bucket is summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for piece in slices(batches, CHUNK):
            for buckets, _, _ in feature_parts(piece.column(0).to_pylist()):
                total += np.bincount(buckets, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.collect():  # at most BUCKETS rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from the counts of the corpus and of the target set."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def draw(doc_id: int | None, seed: int = SEED) -> int:
    """The document's fixed share of chance, in thousandths."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


# -- sorted runs ---------------------------------------------------------------------

NULL_ID = -(1 << 63)
RUN = "doc_id bigint, n_features bigint, weight bigint, score bigint, eligible boolean, run bigint, place int, step bigint"


def scored_runs(docs: DataFrame, gain: np.ndarray, min_words: int = MIN_WORDS, run_rows: int = RUN_ROWS, samples: int = SAMPLES) -> DataFrame:
    """Scored documents in locally sorted runs; ``step`` marks regular samples with the rows each stands for."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket, first = sent.value, TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        n = 0
        for piece in slices(batches, CHUNK):
            ids, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            weight, features, words = (np.zeros(len(ids), dtype=np.int64) for _ in range(3))
            for buckets, whose, owners in feature_parts(texts):
                # A part's sums are far below 2**53, so doubles hold them exactly.
                weight += np.bincount(whose, by_bucket[buckets], len(ids)).astype(np.int64)
                features += np.bincount(whose, minlength=len(ids))
                words += np.bincount(owners, minlength=len(ids))
            score = weight + np.array([draw(i) for i in ids], dtype=np.int64)
            null = np.array([i is None for i in ids])
            doc = np.array([NULL_ID if i is None else i for i in ids], dtype=np.int64)
            held.append(np.stack([doc, null, features, weight, score, words >= min_words]))
            n += len(ids)
            if n >= run_rows:
                yield _sorted_run(held, first, samples)
                held, n, first = [], 0, first + 1
        if n:
            yield _sorted_run(held, first, samples)

    return docs.select("doc_id", "text").mapInArrow(run, RUN)


def _sorted_run(held: list[np.ndarray], run: int, samples: int) -> pa.RecordBatch:
    doc, null, features, weight, score, eligible = np.concatenate(held, axis=1)
    order = np.lexsort((doc, -score, eligible == 0))
    n, ranked = len(order), int(eligible.sum())
    at = np.unique(np.arange(1, min(samples, ranked) + 1) * ranked // min(samples, ranked) - 1) if ranked else np.empty(0, np.int64)
    step = np.zeros(n, dtype=np.int64)
    step[at] = np.diff(at, prepend=-1)
    pick = lambda x: x[order]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(pick(doc), mask=pick(null) == 1), pa.array(pick(features)), pa.array(pick(weight)),
            pa.array(pick(score)), pa.array(pick(eligible) == 1), pa.array(np.full(n, run)),
            pa.array(np.arange(n, dtype=np.int32)), pa.array(step, mask=step == 0),
        ],
        names=["doc_id", "n_features", "weight", "score", "eligible", "run", "place", "step"],
    )


SAMPLE = "down bigint, doc bigint, run bigint, place int, step bigint"


def _sample_key(samples: DataFrame) -> DataFrame:
    return samples.select((-F.col("score")).alias("down"), F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "run", "place", "step")


def _regular(rows: np.ndarray, count: int) -> np.ndarray:
    """Of samples in order, those that end equal shares of the rows they stand for, with these shares."""
    ends = np.cumsum(rows["step"])
    at = np.unique(np.searchsorted(ends, np.arange(1, count + 1) * (ends[-1] / count) - 0.5).clip(max=len(rows) - 1))
    out = rows[at].copy()
    out["step"] = np.diff(ends[at], prepend=0)
    return out


_FIELDS = [("down", np.int64), ("doc", np.int64), ("run", np.int64), ("place", np.int64), ("step", np.int64)]


def splitters(runs: DataFrame, segments: int, samples: int = SAMPLES, gathered: int = GATHERED) -> list[tuple]:
    """Keys that cut all ranked rows into about equal segments, from the runs' regular samples.

    Each run's samples stand for equal shares of it. While there are more than
    ``gathered``, groups of about 64 runs merge theirs and draw regular samples
    anew; a segment then holds at most its share and the rows between two
    samples of every merge.
    """
    found = materialize(_sample_key(runs.where(F.col("step").isNotNull())))

    def merge(table: pa.Table) -> pa.Table:
        kept = _regular(_ordered(table), samples)
        return pa.table({n: pa.array(kept[n], pa.int32() if n == "place" else pa.int64()) for n, _ in _FIELDS})

    while (count := found.count()) > max(gathered, samples):
        group = F.pmod(F.xxhash64("run", "place"), F.lit(-(-count // (64 * samples))))
        merged = found.withColumn("grp", group).groupBy("grp").applyInArrow(merge, SAMPLE)
        found, old = materialize(merged), found
        discard(old)
    rows = _ordered(found.toArrow())
    discard(found)
    if not len(rows):
        return []
    cuts = _regular(rows, segments)[:-1]
    return [tuple(int(r[n]) for n in ("down", "doc", "run", "place")) for r in cuts]


def _ordered(table: pa.Table) -> np.ndarray:
    rows = np.empty(table.num_rows, dtype=_FIELDS)
    for name, _ in _FIELDS:
        rows[name] = table.column(name).to_numpy()
    return rows[np.lexsort((rows["place"], rows["run"], rows["doc"], rows["down"]))]


def ranked(runs: DataFrame, percent: int = DRAWN_PERCENT, segments: int | None = None, samples: int = SAMPLES, gathered: int = GATHERED) -> DataFrame:
    """``runs`` with ``rank``: exact places of the drawn rows by falling score, ties to the smaller id; else null."""
    spark = runs.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(runs, segments, samples, gathered)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            seg = [
                bisect_right(cuts, (-s, NULL_ID if d is None else d, r, p)) if e else None
                for s, d, r, p, e in zip(*(cols[n] for n in ("score", "doc_id", "run", "place", "eligible")))
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seg, pa.int32())], names=[*b.schema.names, "segment"])

    fields = "doc_id bigint, n_features bigint, weight bigint, score bigint, eligible boolean, run bigint, place int"
    dealt = runs.drop("step").mapInArrow(place, f"{fields}, segment int")
    counted = dealt.where(F.col("segment").isNotNull()).groupBy("segment").count().collect()  # one row per segment
    sizes = dict(sorted((r["segment"], r["count"]) for r in counted))
    wanted = percent * sum(sizes.values()) // 100
    offsets, before = {}, 0
    for segment, size in sizes.items():
        if before < wanted:
            offsets[segment] = before
        before += size
    last = max(offsets, default=-1)
    drawable = F.coalesce(F.col("segment") <= last, F.lit(False))
    exchanged = dealt.where(drawable).repartition(max(1, len(offsets)), "segment")
    merged = exchanged.sortWithinPartitions(
        "segment", F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "run", "place"
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at = None, 0
        for b in batches:
            seg = b.column(b.schema.names.index("segment")).to_numpy()
            ranks = np.empty(len(seg), dtype=np.int64)
            cuts_at = [0, *(np.flatnonzero(np.diff(seg)) + 1).tolist(), len(seg)]
            for x, y in zip(cuts_at, cuts_at[1:]):
                if x == y:
                    continue
                if seg[x] != current:
                    current, at = seg[x], offsets[int(seg[x])]
                ranks[x:y] = np.arange(at + 1, at + 1 + y - x)
                at += y - x
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(ranks, mask=ranks > wanted)], names=[*b.schema.names[:4], "rank"]
            )

    out = ["doc_id", "n_features", "weight", "score"]
    drawn = merged.mapInArrow(number, "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint")
    return drawn.unionByName(dealt.where(~drawable).select(*out, F.lit(None).cast("bigint").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, segments: int | None = None) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` is null where it is not drawn.

    Null and empty texts have no features and weight 0 and are never drawn
    (they have too few words); an empty target set or corpus gives finite
    gains, since every bucket counts one more; a null ``doc_id`` draws as the
    empty id and comes before others in a tie; rows equal in score and id are
    ranked in the order they were read. A text of any length is handled about a
    megabyte of words at a time. Only ``doc_id`` and ``text`` are read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return ranked(materialize(scored_runs(docs, gain)), percent, segments)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
