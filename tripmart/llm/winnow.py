"""Benchmark decontamination by winnowing.

Texts become word sequences; every run of ``w`` consecutive ``k``-grams keeps
its k-gram of minimum hash, on both sides by the same rule, so a shared span
of ``w + k - 1`` words shares a kept hash at the same place. The kept hashes of
documents and benchmark are joined; a shared one is then extended word by word
in both directions, as far as a window that keeps it can reach, and only runs
as long as a window count. Windows have 13 words (``k = w = 7``); an item of ``L < 13``
words is one window of ``L`` words with its own ``k`` and ``w``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, mix64, read_table, slices, span_hashes, word_spans
from tripmart.operators.lookup import BROADCAST_BYTES, broadcast_bounded, discard, materialize

WINDOW = 13
#: ASCII other than letters and digits parts words; A-Z fold to a-z.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of text that a task works on at a time, and what one shared place is taken to weigh in a broadcast.
SLICE, HIT_BYTES = 1 << 20, 64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def gram_sizes(span: int) -> tuple[int, int]:
    """``k`` and ``w`` with ``k + w - 1 == span``."""
    k = (span + 1) // 2
    return k, span - k + 1


def kept_grams(hashes: np.ndarray, owner: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept k-grams of sequences laid one after another."""
    k, w = gram_sizes(span)
    n = len(hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for i in range(k):
        grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(grams)])
    inside = owner[:n] == owner[span - 1 : span - 1 + n]
    best = sliding_window_view(grams, w)[:n].argmin(axis=1) + np.arange(n)
    at = np.unique(best[inside])
    return at, grams[at]


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Hashes of all words of folded texts, the text each is from, and their spans in the joined buffer."""
    joined = b" ".join(texts)
    buf = np.frombuffer(joined, dtype=np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.empty(0, np.int64), (joined, np.empty(0, np.int64), np.empty(0, np.int64))
    starts, ends = word_spans(buf)
    heads = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return span_hashes(buf, starts, ends), np.searchsorted(heads, starts, "right") - 1, (joined, starts, ends)


def context(words: list[bytes], p: int, span: int) -> tuple[bytes, bytes]:
    """Words before the k-gram at ``p``, and words from it on, that windows of ``span`` words around it can hold."""
    k, w = gram_sizes(span)
    return b" ".join(words[max(0, p - w + 1) : p]), b" ".join(words[p : p + k + w - 1])


def extent(before: str, after: str, item_before: str, item_after: str) -> tuple[int, int]:
    """How many words before the shared place and from it on are equal in both contexts."""
    sides = (before.split()[::-1], item_before.split()[::-1]), (after.split(), item_after.split())
    return tuple(next((i for i, (x, y) in enumerate(zip(*s)) if x != y), min(map(len, s))) for s in sides)


def kept_places(texts: list[str | None], spans: list[int], own: bool = False) -> Iterator[tuple]:
    """``(span, text numbers, places, k-grams)`` of the winnowed texts; with ``own`` each text has its own span only."""
    hashes, owner, _ = hash_words([(t or "").encode().translate(FOLD) for t in texts])
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    size = np.minimum(np.diff(first), WINDOW)
    for span in spans:
        at, grams = kept_grams(hashes, owner, span)
        if own:
            chosen = size[owner[at]] == span
            at, grams = at[chosen], grams[chosen]
        yield span, owner[at], at - first[owner[at]], grams.view(np.int64)


def document_prints(docs: DataFrame, spans: list[int]) -> DataFrame:
    """``(text_key, span, gram, at)``: every kept k-gram of every text, for each size of window in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, SLICE):
            for span, text, at, grams in kept_places(piece.column(1).to_pylist(), spans):
                columns = piece.column(0).take(pa.array(text)), pa.array(np.full(len(at), span, np.int32)), pa.array(grams), pa.array(at)
                yield pa.RecordBatch.from_arrays(list(columns), names=["text_key", "span", "gram", "at"])

    return _keyed(docs).mapInArrow(run, "text_key binary, span int, gram bigint, at bigint")


def item_prints(benchmark: DataFrame) -> DataFrame:
    """``(item, span, gram, before, after)``: the kept k-grams of every item in its own size of window, with their context."""

    def run(cols: dict) -> dict:
        words = [words_of(t) for t in cols["text"]]
        out = {n: [] for n in ("item", "span", "gram", "before", "after")}
        for span, text, at, grams in kept_places(cols["text"], list(range(1, WINDOW + 1)), own=True):
            for i, p, gram in zip(text.tolist(), at.tolist(), grams.tolist()):
                row = (cols["item"][i], span, gram, *(c.decode() for c in context(words[i], p, span)))
                for column, value in zip(out.values(), row):
                    column.append(value)
        return out

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return map_rows(items, "item string, span int, gram bigint, before string, after string", run, max_bytes=SLICE)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under their digest: what is found holds for every row with that text."""
    return docs.where(F.col("text").isNotNull()).select(_text_key(docs["text"]).alias("text_key"), docs["text"])


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _context_key(side: str) -> Column:
    return F.unhex(F.md5(F.concat_ws("\0", "span", "gram", "before", "after"))).alias(side)


def _places(docs: DataFrame, hits: DataFrame, max_bytes: int) -> DataFrame:
    """``(text_key, n_words, span, gram, at, before, after)``: the context of every shared fingerprint of a text."""
    schema = "text_key binary, n_words bigint, span int, gram bigint, at bigint, before string, after string"

    def run(cols: dict) -> dict:
        out = {n: [] for n in ("text_key", "n_words", "span", "gram", "at", "before", "after")}
        for key, text, spots in zip(cols["text_key"], cols["text"], cols["spots"]):
            words = words_of(text)
            for spot in spots:
                sides = (c.decode() for c in context(words, spot["at"], spot["span"]))
                row = (key, len(words), spot["span"], spot["gram"], spot["at"], *sides)
                for column, value in zip(out.values(), row):
                    column.append(value)
        return out

    # As many entries as the winnowed text itself has places.
    spots = hits.groupBy("text_key").agg(F.collect_list(F.struct("span", "gram", "at")).alias("spots"))
    small = hits.count() * HIT_BYTES <= max_bytes
    texts = _keyed(docs).join(F.broadcast(spots) if small else spots, "text_key").select("text_key", "text", "spots")
    return map_rows(texts, schema, run, max_bytes=SLICE).distinct()


def shared_spans(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Texts that share a window with the benchmark: ``(text_key, n_words, n_hit, items)``, written once.

    The fingerprints of both sides are joined, the distinct ones of the
    benchmark by broadcast where their counted size allows. Only places of a
    shared fingerprint get their context, the words that a window around it
    can hold; equal contexts are one row on either side, and pairs of contexts
    that share a fingerprint are extended word by word.
    """
    items = materialize(item_prints(benchmark).distinct().select("*", _context_key("item_context")))
    spans = sorted(r[0] for r in items.select("span").distinct().collect())  # 13 at most
    known = items.select("span", "gram").distinct()
    known = broadcast_bounded(known, items.count(), broadcast_bytes)
    hits = materialize(document_prints(docs, spans).join(known, ["span", "gram"], "left_semi").distinct())
    places = materialize(_places(docs, hits, broadcast_bytes).select("*", _context_key("context")))

    sides = places.select("context", "span", "gram", "before", "after").distinct()
    theirs = items.select("item_context", "span", "gram", F.col("before").alias("item_before"), F.col("after").alias("item_after"))
    pairs = sides.join(broadcast_bounded(theirs.distinct(), items.count() * 4, broadcast_bytes), ["span", "gram"])

    def run(cols: dict) -> dict:
        found = [extent(*c) for c in zip(cols["before"], cols["after"], cols["item_before"], cols["item_after"])]
        return {n: cols[n] for n in ("context", "item_context", "span")} | {"back": [a for a, _ in found], "ahead": [b for _, b in found]}

    extended = map_rows(pairs, "context binary, item_context binary, span int, back bigint, ahead bigint", run, max_bytes=SLICE)
    whole = materialize(extended.where("back + ahead >= span").drop("span"))
    # Every extent of a place holds the place itself, so their union is one run of words.
    reach = whole.groupBy("context").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead"))
    n = whole.count()
    runs = places.join(broadcast_bounded(reach, n, broadcast_bytes), "context").select(
        "text_key", "n_words", (F.col("at") - F.col("back")).alias("a"), (F.col("at") + F.col("ahead")).alias("b")
    )
    earlier = Window.partitionBy("text_key").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(F.max("b").over(earlier), F.lit(0))))
    words = runs.distinct().select("text_key", "n_words", fresh.alias("new")).groupBy("text_key")
    words = words.agg(F.first("n_words").alias("n_words"), F.sum("new").alias("n_hit"))
    of_items = whole.select("context", "item_context").join(
        broadcast_bounded(items.select("item_context", "item").distinct(), items.count(), broadcast_bytes), "item_context"
    )
    found = places.select("text_key", "context").distinct().join(of_items.select("context", "item").distinct(), "context")
    found = found.groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    answers = materialize(words.join(found, "text_key"))
    for copy in (items, hits, places, whole):
        discard(copy)
    return answers


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Benchmark hits of every document: ``(doc_id, n_words, n_hit, n_items, items)``.

    Null and empty texts have no words and no hits; rows with equal
    ``item_id`` are one item, a null id is the empty id; an item without words
    occurs nowhere; repeated documents are answered row by row; an empty
    benchmark hits nothing. A very long text is one row of its task, and its
    places travel as rows of their own. Only ``doc_id`` and ``text``
    (``item_id`` and ``text``) are read, so other columns cannot clash.
    """
    answers = shared_spans(docs, benchmark, broadcast_bytes)

    def run(cols: dict) -> dict:
        return {n: cols[n] for n in ("doc_id", "text_key")} | {"n_words": [len(words_of(t)) for t in cols["text"]]}

    rows = docs.select("doc_id", "text", _text_key(docs["text"]).alias("text_key"))
    counted = map_rows(rows, "doc_id bigint, text_key binary, n_words bigint", run, max_bytes=SLICE)
    found = broadcast_bounded(answers.drop("n_words"), _weight(answers), broadcast_bytes)
    none = F.array().cast("array<string>")
    return counted.join(found, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.greatest(F.size(F.coalesce("items", none)), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )


def _weight(answers: DataFrame) -> int:
    """Rows of the answers with their items counted as rows too."""
    return answers.agg(F.coalesce(F.sum(1 + F.size("items")), F.lit(0))).first()[0]


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without contaminated rows, all columns as they are; null and empty texts stay."""
    answers = shared_spans(docs, benchmark, broadcast_bytes)
    bad = answers.where(is_contaminated(F.col("n_words"), F.col("n_hit"))).select("text_key")
    bad = broadcast_bounded(bad, bad.count(), broadcast_bytes)
    return docs.join(bad, _text_key(docs["text"]) == bad["text_key"], "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple[str, str | None]]) -> tuple[int, int, int, str]:
    """The contract read literally, for tests: every window against every place."""
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        seq = words_of(item)
        span = min(WINDOW, len(seq))
        if not span:
            continue
        windows = {tuple(seq[i : i + span]) for i in range(len(seq) - span + 1)}
        for p in range(len(words) - span + 1):
            if tuple(words[p : p + span]) in windows:
                hit.update(range(p, p + span))
                found.add(item_id)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
#: Windows as text, joined by equality: no hash, no winnowing.
OP5_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
items AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS size,
  array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS span
  FROM b, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
windows AS (SELECT row, i, size, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
hits AS (SELECT row, i, windows.size, item FROM windows JOIN items USING (size, span)),
words AS (SELECT row, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, size)) AS u(k) GROUP BY row),
found AS (SELECT row, list_sort(list(DISTINCT item)) AS ids FROM hits GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN found USING (row)
"""
