"""Suffix-array removal of repeated byte strings, over shards of any corpus.

A start is a place where ``length`` bytes follow inside a text. The starts
whose string occurs elsewhere are found by suffix order, so equal strings have
to meet in one shard:

1. Every start chooses the smallest k-gram inside its string (the first of
   equal ones), so equal strings choose the same gram at the same place. The
   starts that follow one another with the same choice form a piece: they and
   the bytes their strings cover. Each start is in exactly one piece.
2. Grams that occur once belong to no repeated string. The other pieces are
   reduced to distinct ones with their number of copies, so a text copied any
   number of times is sorted once. A string holds its gram and half of its other
   bytes on one side, so a piece without copies that shares neither side with
   any other piece has no repeated string either. The rest go into shards by
   their gram. A gram with more bytes of pieces than a shard holds is dealt
   over several.
3. A shard is suffix-sorted by external induced sorting with shared prefixes
   (:mod:`tripmart.llm.induced`): strings that share ``length`` bytes stand
   side by side, and a string of two or more copies or members is repeated. For
   a gram dealt over several shards, the classes of equal strings of each
   shard meet by their digest.
4. The repeated starts return to all copies of a piece, and texts lose the
   bytes they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import mix64, read_table, slices, span_hashes
from tripmart.llm.induced import Shard
from tripmart.operators.lookup import broadcast_bounded, discard, materialize

LENGTH, GRAM = 200, 32
#: Bytes of a shard's pieces, and of an induced sort's queues and arrays before they go to scratch files.
SHARD_BYTES, MEMORY = 2 << 20, 96 << 20
#: A key with one row in so many is hot: there are no more such keys than this.
HOT = 4096
CHUNK, PLACE = 1 << 20, 21
#: Bytes whose windows are searched at a time, so that they lie in the caches.
WINDOWS = 1 << 16


def text_key() -> tuple[Column, Column]:
    """128 bits that tell rows apart by id and text; rows alike in both are answered alike."""
    return F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("second"), "text", "doc_id").alias("k2")


# -- pieces ------------------------------------------------------------------------


def pieces(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, start, starts, gram, digest)`` of all pieces."""
    for *found, _, _ in sided_pieces(texts, length, gram):
        yield tuple(found)


def sided_pieces(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, start, starts, gram, digest, left, right)`` of all pieces, ``WINDOWS`` bytes at a time.

    ``left`` and ``right`` are hashes of the gram with half of a string's other
    bytes before or behind it; 0 where no string of the piece holds as many there.
    """
    side = (length - gram + 1) // 2
    joined = b"".join(texts)
    heads = np.cumsum([0, *map(len, texts)])
    for a in range(0, len(joined), WINDOWS):
        buf = np.frombuffer(joined, dtype=np.uint8, offset=a, count=min(WINDOWS + length - 1, len(joined) - a))
        n = min(WINDOWS, len(buf) - length + 1)
        if n <= 0:
            continue
        at = np.arange(len(buf) - gram + 1)
        grams = span_hashes(buf, at, at + gram)
        key = (mix64(grams) & np.uint64((1 << 64) - (1 << PLACE))) | at.astype(np.uint64)
        window, width = key, 1
        while 2 * width <= length - gram + 1:
            window, width = np.minimum(window[:-width], window[width:]), 2 * width
        rest = length - gram + 1 - width
        window = np.minimum(window[: len(window) - rest], window[rest:]) if rest else window
        chosen = (window[:n] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        first = int(np.searchsorted(heads, a, "right")) - 1
        last = int(np.searchsorted(heads, a + n, "left"))
        inside = np.minimum(np.diff(np.clip(heads[first : last + 1] - a, 0, n)), n)
        text = np.repeat(np.arange(first, first + len(inside)), inside)
        fits = np.arange(a, a + n) + length <= heads[text + 1]
        new = fits.copy()
        new[1:] &= (chosen[1:] != chosen[:-1]) | ~fits[:-1] | (text[1:] != text[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            continue
        # A piece ends where the next one or a place without a whole string begins.
        stop = np.flatnonzero(fits & np.append(new[1:] | ~fits[1:], True))
        view, digest = memoryview(joined), xxhash.xxh3_128_digest
        found = [digest(view[x:y]) for x, y in zip((starts + a).tolist(), (stop + a + length).tolist())]
        at = chosen[starts]
        left = np.where(at - starts >= side, _hash_of_grams(grams, at - side, side, gram), 0)
        right = np.where(stop + length - gram - at >= side, _hash_of_grams(grams, at, side, gram), 0)
        yield text[starts], starts + a - heads[text[starts]], stop - starts + 1, grams[at].view(np.int64), found, left, right


def _hash_of_grams(grams: np.ndarray, at: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Hashes of ``size`` bytes and a gram behind them, from the grams that cover them (places outside give anything)."""
    out = np.zeros(len(at), dtype=np.uint64)
    for offset in [*range(0, size, gram), size]:
        out = mix64(out + grams.take(at + offset, mode="clip"))
    return out.view(np.int64)


PIECE = "k1 bigint, k2 bigint, start bigint, starts int, gram bigint, piece binary, left bigint, right bigint"


def all_pieces(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, CHUNK):
            texts = [t.encode() for t in part.column(2).to_pylist()]
            k1, k2 = part.column(0).to_numpy(), part.column(1).to_numpy()
            for text, start, starts, grams, found, left, right in sided_pieces(texts, length, gram):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[text]), pa.array(k2[text]), pa.array(start), pa.array(starts, pa.int32()),
                        pa.array(grams), pa.array(found, pa.binary()), pa.array(left), pa.array(right),
                    ],
                    names=["k1", "k2", "start", "starts", "gram", "piece", "left", "right"],
                )

    rows = docs.select(*text_key(), F.col("text").alias("text")).where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, PIECE)


def join_unique(rows: DataFrame, found: DataFrame, on: list[str], total: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``found``, which has one row a key and the key's ``copies`` among ``rows``.

    Keys with one row in ``HOT`` or more go to every task: there are at most
    ``HOT`` of them, and their rows are not shuffled. The others are joined by key.
    """
    hot = F.col("copies") * HOT >= total
    many, few = found.where(hot), found.where(~hot)
    here = broadcast_bounded(many.drop("copies"), HOT)
    common = rows.join(F.broadcast(many.select(*on)), on, "left_anti")
    return rows.join(here, on, how).unionByName(common.join(few.drop("copies"), on, how))


def distinct_pieces(docs: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame, int]:
    """Pieces whose gram occurs again, their distinct ones with copies and one place each, and how many there are."""
    every = materialize(all_pieces(docs, length, gram))
    total = every.count()
    again = materialize(every.groupBy("gram").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    kept = materialize(join_unique(every, again, ["gram"], total))
    # The row with the least hash of its place; pieces alike have like sides.
    numbered = kept.withColumn("order", F.xxhash64("k1", "k2", "start"))
    one = [F.min_by(c, "order").alias(c) for c in ("k1", "k2", "start", "left", "right")]
    distinct = numbered.groupBy("gram", "piece", "starts").agg(F.count(F.lit(1)).alias("copies"), *one)
    distinct = materialize(distinct.select("*", F.array("left", "right").alias("sides")).drop("left", "right"))
    discard(every)
    discard(again)
    return kept, distinct, kept.count()


def comparable(distinct: DataFrame) -> DataFrame:
    """Distinct pieces that can hold a repeated string: those with copies, and those that share a side with another."""
    found = distinct.select("*", F.explode(F.array_remove("sides", 0)).alias("side"))
    shared = materialize(found.groupBy("side").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    single = found.where("copies = 1").drop("copies", "sides")
    met = join_unique(single, shared, ["side"], max(1, found.count())).dropDuplicates(["gram", "piece", "starts"])
    columns = distinct.drop("sides").columns
    return distinct.where("copies > 1").select(*columns).unionByName(met.withColumn("copies", F.lit(1).cast("bigint")).select(*columns))


def dealt(distinct: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Distinct pieces with their shard, and whether their gram is dealt over several."""
    size = F.col("starts") + F.lit(length - 1)
    by_gram = distinct.groupBy("gram").agg(F.sum(size).alias("bytes"))
    large = materialize(by_gram.where(F.col("bytes") > shard_bytes))
    whole = distinct.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-whole // shard_bytes))
    # A large gram has a shard's bytes at least, so there are no more of them than shards.
    joined = distinct.join(broadcast_bounded(large, shards), "gram", "left")
    parts = F.ceil(F.col("bytes") / F.lit(shard_bytes))
    split = F.col("bytes").isNotNull()
    own = F.xxhash64("gram", F.pmod(F.xxhash64("piece"), parts))
    return joined.select(
        *distinct.columns, split.alias("split"), F.when(split, own).otherwise(F.pmod(F.xxhash64("gram"), F.lit(shards))).alias("shard")
    )


# -- shards ------------------------------------------------------------------------

BODY = "shard bigint, split boolean, gram bigint, piece binary, copies bigint, body binary"
FOUND = "gram bigint, piece binary, offset int, size int, class binary, members bigint"


def packed(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, k1, k2, packed)`` of the texts of ``length`` bytes or more, compressed for the way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, CHUNK):
            small = pa.array([press(t.as_buffer()) for t in part.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], small], names=["doc_id", "k1", "k2", "packed"])

    rows = docs.select("doc_id", *text_key(), "text").where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, "doc_id bigint, k1 bigint, k2 bigint, packed binary")


def bodies(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of each wanted piece, cut from the one text named as its place."""
    by_text = materialize(
        wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "starts", "shard", "split", "gram", "piece", "copies")).alias("cuts"))
    )
    # Rows alike in id and text are one place.
    joined = packed(docs, length).join(by_text, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("packed", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, CHUNK):
            rows, cut = part.column(1).flatten(), []
            places = zip(rows.field("start").to_pylist(), rows.field("starts").to_pylist())
            for text, count in zip(part.column(0), part.column(1).value_lengths().to_pylist()):
                raw = zstandard.decompress(text.as_buffer())
                cut += [raw[a : a + n + length - 1] for a, n in islice(places, count)]
            yield pa.RecordBatch.from_arrays(
                [*(rows.field(n) for n in ("shard", "split", "gram", "piece", "copies")), pa.array(cut, pa.binary())],
                names=["shard", "split", "gram", "piece", "copies", "body"],
            )

    return joined.mapInArrow(run, BODY)


def sort_shard(rows: list[pa.RecordBatch], length: int, memory: int) -> Iterator[pa.RecordBatch]:
    """Repeated runs of starts of each piece of one shard; for split grams, all starts with their class."""
    table = pa.Table.from_batches(rows)
    raw = table.column("body").to_pylist()
    shard = Shard(raw, length, memory)
    copies, split = table.column("copies").to_numpy(), table.column("split").to_numpy(zero_copy_only=False)
    mark = np.zeros(shard.n, dtype=np.int8)
    crossing = []
    for pos, number in shard.classes():
        owner = np.searchsorted(shard.starts, pos, "right") - 1
        number = number - number[0]
        members = np.bincount(number, np.minimum(copies[owner], 2)).astype(np.int64)[number]
        mark[pos[members > 1]] = 1
        if split[owner].any():
            at = np.flatnonzero(split[owner] & (members < 2))
            crossing.append((pos[at], owner[at]))
            # One member speaks for a class that is repeated already, in case another shard holds one more.
            one = np.unique(number[members > 1], return_index=True)[1]
            seen = np.flatnonzero(members > 1)[one]
            crossing.append((pos[seen[split[owner[seen]]]], owner[seen[split[owner[seen]]]]))
    edge = np.diff(mark, prepend=np.int8(0), append=np.int8(0))
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(shard.starts, first, "right") - 1
    none = pa.nulls(len(first), pa.binary()), pa.nulls(len(first), pa.int64())
    yield _found(table, owner, first - shard.starts[owner], stop - first, *none)
    for pos, owner in crossing:
        for a in range(0, len(pos), 1 << 14):
            p, o = pos[a : a + (1 << 14)], owner[a : a + (1 << 14)]
            offset = p - shard.starts[o]
            digest = [xxhash.xxh3_128_digest(raw[i][k : k + length]) for i, k in zip(o.tolist(), offset.tolist())]
            two = np.where(mark[p] == 1, 2, 1)
            yield _found(table, o, offset, np.ones(len(p), np.int64), pa.array(digest, pa.binary()), pa.array(two))


def _found(table: pa.Table, owner: np.ndarray, offset: np.ndarray, size: np.ndarray, digest: pa.Array, members: pa.Array) -> pa.RecordBatch:
    rows = table.select(["gram", "piece"]).take(pa.array(owner)).combine_chunks()
    columns = [rows.column(i).combine_chunks() if rows.column(i).num_chunks != 1 else rows.column(i).chunk(0) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(offset, pa.int32()), pa.array(size, pa.int32()), digest, members],
        names=["gram", "piece", "offset", "size", "class", "members"],
    )


def repeated_starts(docs: DataFrame, wanted: DataFrame, length: int, shard_bytes: int, memory: int) -> DataFrame:
    """``(gram, piece, runs)``: the runs of repeated starts of every distinct piece that has any."""
    parts = max(1, wanted.select("shard").distinct().count())
    rows = bodies(docs, wanted, length).repartition(parts, "shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for part in slices(batches, CHUNK):
            at = part.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if held and at[a] != current:
                    yield from sort_shard(held, length, memory)
                    held = []
                current = at[a]
                held.append(part.slice(a, b - a))
        if held:
            yield from sort_shard(held, length, memory)

    found = materialize(rows.mapInArrow(run, FOUND))
    inside = found.where(F.col("class").isNull())
    # Classes of grams that several shards hold meet by digest; those of one shard are settled already.
    classes = found.where(F.col("class").isNotNull())
    sums = classes.groupBy("class").agg(F.sum("members").alias("all"), F.count(F.lit(1)).alias("copies"))
    across = materialize(sums.where(F.col("all") > 1).drop("all"))
    met = join_unique(classes.select("class", "gram", "piece", "offset", "size"), across, ["class"], max(1, classes.count()))
    runs = inside.select("gram", "piece", "offset", "size").unionByName(met.select("gram", "piece", "offset", "size"))
    out = materialize(runs.groupBy("gram", "piece").agg(F.collect_set(F.struct("offset", "size")).alias("runs")))
    discard(found)
    discard(across)
    return out


# -- texts -------------------------------------------------------------------------


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, memory: int = MEMORY) -> DataFrame:
    """``(k1, k2, runs)``: for every text with repeated strings, the runs ``(start, size)`` of their starts."""
    kept, distinct, total = distinct_pieces(docs, length, gram)
    wanted = materialize(dealt(materialize(comparable(distinct)), length, shard_bytes))
    found = repeated_starts(docs, wanted, length, shard_bytes, memory)
    counted = found.join(distinct.select("gram", "piece", "copies"), ["gram", "piece"])
    rows = join_unique(kept.select("k1", "k2", "start", "gram", "piece"), counted, ["gram", "piece"], total)
    absolute = rows.select("k1", "k2", "start", F.explode("runs").alias("run")).select(
        "k1", "k2", F.struct((F.col("start") + F.col("run.offset")).alias("start"), F.col("run.size").alias("size")).alias("run")
    )
    out = materialize(absolute.groupBy("k1", "k2").agg(F.collect_set("run").alias("runs")))
    for copy in (kept, distinct, wanted, found):
        discard(copy)
    return out


SCHEMA = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"


def cut_spans(runs: pa.ListArray, length: int) -> list[list[tuple[int, int]]]:
    """Maximal removed runs ``(start, stop)`` of each row: of the bytes that its runs of starts cover."""
    flat, counts = runs.flatten(), runs.value_lengths().fill_null(0).to_numpy()
    start, row = flat.field("start").to_numpy(), np.repeat(np.arange(len(runs)), counts)
    stop = start + flat.field("size").to_numpy() - 1 + length
    order = np.lexsort((start, row))  # rows stay where they are
    # One row's bytes lie behind those of all rows before it.
    behind = row * (stop.max(initial=0) + 1)
    start, reach = start[order] + behind, np.maximum.accumulate(stop[order] + behind)
    first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1]))[: len(start)])
    last = np.append(first[1:], len(start))[: len(first)] - 1
    spans = iter(zip((start - behind)[first].tolist(), (reach - behind)[last].tolist()))
    return [list(islice(spans, n)) for n in np.bincount(row[first], minlength=len(runs)).tolist()]


def with_runs(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, text, packed, runs)`` of every row: short texts as they are, long ones compressed."""
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) < length)
    none = [F.lit(None).cast("binary").alias("packed"), F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")]
    long = packed(docs, length).join(runs, ["k1", "k2"], "left")
    return long.select("doc_id", F.lit(None).cast("string").alias("text"), "packed", "runs").unionByName(
        short.select("doc_id", "text", *none)
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, memory: int = MEMORY
) -> DataFrame:
    """Every document without its repeated bytes: ``(doc_id, n_bytes, spans, kept)``.

    A byte goes if a string of ``length`` (at most 254) bytes that covers it
    starts anywhere else too, in the same or another row; ``spans`` are the removed runs, ``kept`` the other
    bytes (a cut may part a character). Null texts are empty; texts shorter
    than ``length`` keep everything; rows equal in id and text are rows of their
    own and repeat each other; null ids are ids like others; a text of any
    length goes a megabyte at a time, and only its own bytes are held whole.
    Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    return _described(docs, repeated_runs(docs, length, gram, shard_bytes, memory), length, True)


def _described(docs: DataFrame, runs: DataFrame, length: int, texts: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, CHUNK):
            raw = [
                zstandard.decompress(z.as_buffer()) if z.is_valid else (t.as_py() or "").encode()
                for t, z in zip(part.column(1), part.column(2))
            ]
            spans = cut_spans(part.column(3), length)
            left = []
            for body, cuts in zip(raw, spans):
                edges = [0, *(x for cut in cuts for x in cut), len(body)]
                left.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
            head = [part.column(0), pa.array([len(x) for x in raw], pa.int64())]
            if texts:
                rows = pa.array([[{"start": a, "stop": b} for a, b in x] for x in spans], _SPANS)
                yield pa.RecordBatch.from_arrays([*head, rows, pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])
            else:
                removed = pa.array([sum(b - a for a, b in x) for x in spans], pa.int64())
                digests = pa.array([sha256(x).hexdigest() for x in left])
                counts = pa.array([len(x) for x in spans], pa.int64())
                yield pa.RecordBatch.from_arrays([*head, removed, counts, digests], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    digest = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return with_runs(docs, runs, length).mapInArrow(run, SCHEMA if texts else digest)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _described(docs, repeated_runs(docs), LENGTH, False)
