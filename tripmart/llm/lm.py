"""Language-model scores by online logistic context mixing.

A text is the sequence of its lower-cased words and one end. It is written as
bytes (words parted by one blank, closed by a line feed), and every byte as
binary decisions along a prefix code that depends on the two bytes before it.
Hashed contexts predict each decision from counts over the training texts;
their log odds are combined by weights that are chosen by a gate (how much is
known of the two most specific contexts) and updated after every decision.
The probability of a text is the product over its decisions.

Training is a Spark aggregation: tasks count into tables of hashed slots, the
tables are cut into chunks, and chunks are summed by key. The word counts of
the unigram base are exact for every word.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import _arrow_schema, _powers, crc_mod, map_rows, read_table, slices
from tripmart.operators.lookup import discard, materialize

#: Slots of each context's table (as a power of two) and of one chunk that is summed at a time.
TABLE_BITS, CHUNK_BITS = 22, 16
#: Byte pairs with a code of their own; other pairs use the code of the last byte.
PAIR_CODES = 2048
#: Tasks hold the counts of words that make up at least one in so many tokens (so there are no more
#: such words than that) and are at most so long; the counts of all other words are joined.
FREQUENT, LONGEST = 1 << 20, 64
#: One training text in so many fits the first weights before the tables count it.
WEIGHT_SHARE, WEIGHT_ROUNDS = 64, 3
CONTEXTS, GATES, SHORT_WORD = 3, 16, 3
#: ``LANES`` sequences of decisions advance together, up to ``STEPS`` at a time (fewer of many, for the caches); they go on one by one once fewer than ``NARROW`` last.
LANES, NARROW, STEPS, RATE, ODDS = 4096, 8, 256, 0.015, 15.5
SCALE = RATE**0.5
#: What the four signed bytes of a packed decision are multiplied with.
FACTORS, EACH = np.array([SCALE / ODDS] * CONTEXTS + [SCALE * 0.5], dtype=np.float32), np.ones(CONTEXTS + 1, dtype=np.float32)
#: Bytes of text whose triples, decisions and words are counted at a time, scored side by side, and hashed at a time.
BATCH_BYTES, COUNT_BYTES, WORD_BYTES, SCORE_BYTES, CUT_BYTES = 1 << 18, 1 << 20, 2 << 20, 8 << 20, 1 << 15
RAW_NODE = 255
END = b"\n"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def stream_of(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def words_in(texts: pa.Array) -> pa.ListArray:
    """The words of every text, as ``words_of`` finds them."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null(""))).cast(pa.list_(pa.binary()))
    flat, offsets = split.values, split.offsets.to_numpy()
    whole = pc.binary_length(flat).to_numpy() > 0  # white space at an end of a text parts off an empty one
    if not whole.all():
        offsets = np.concatenate(([0], np.cumsum(whole)))[offsets].astype(np.int32)
        flat = flat.filter(pa.array(whole))
    return pa.ListArray.from_arrays(offsets, flat)


def streams_in(words: pa.ListArray) -> list[bytes]:
    return [w + END for w in pc.binary_join(words, b" ").to_pylist()]


@dataclass
class Codes:
    """Prefix codes by context: paths of nodes and bits laid one after another, found by (code, byte).

    ``table_bits`` is the size of the tables that go with them.
    """

    code_of_pair: np.ndarray  # of the two bytes before
    start: np.ndarray  # of (code, byte) in step
    length: np.ndarray
    step: np.ndarray  # uint16: twice the node, and the bit
    table_bits: int = TABLE_BITS


def huffman(counts: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
    """Paths of the symbols and of the escape (256); inner nodes are numbered from 0."""
    heap = [(1, 256, (256, None, None))] + [(1 + c, s, (s, None, None)) for s, c in counts.items()]
    heapq.heapify(heap)
    n = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], 1000 + n, (n, a[2], b[2])))
        n += 1
    paths, todo = {}, [(heap[0][2], [])]
    while todo:
        (at, left, right), path = todo.pop()
        if left is None:
            paths[at] = path
        else:
            todo += [(left, [*path, (at, 0)]), (right, [*path, (at, 1)])]
    return paths


def build_codes(singles: dict[int, dict[int, int]], pairs: dict[int, dict[int, int]], table_bits: int = TABLE_BITS) -> Codes:
    """Codes 0-255 follow the last byte, further ones the byte pairs of ``pairs``.

    A byte unseen after its context takes the escape and eight plain bits (the
    chance of an escape to a byte that has a code is given away, so chances
    add up to one at most).
    """
    code_of_pair = np.tile(np.arange(256, dtype=np.int32), 256)
    tables = [singles.get(b, {}) for b in range(256)]
    for pair in sorted(pairs):
        code_of_pair[pair] = len(tables)
        tables.append(pairs[pair])
    start, length, steps = [], [], []
    for counts in tables:
        paths = huffman(counts)
        for s in range(256):
            path = paths.get(s) or paths[256] + [(RAW_NODE, s >> i & 1) for i in range(7, -1, -1)]
            start.append(len(steps))
            length.append(len(path))
            steps += [node << 1 | bit for node, bit in path]
    return Codes(code_of_pair, np.array(start, np.int32), np.array(length, np.uint8), np.array(steps, np.uint16), table_bits)


@dataclass
class Model:
    codes: Codes
    tables: list = field(default_factory=list)  # uint16 per slot: log odds (high byte), evidence (low byte)
    weights: np.ndarray | None = None


def _before(buf: np.ndarray, heads: np.ndarray, back: int) -> np.ndarray:
    """The byte ``back`` places before each; a line feed before the start of a text."""
    out = np.full(len(buf), END[0], dtype=np.uint32)
    out[back:] = buf[:-back]
    for i in range(back):
        out[np.minimum(heads + i, len(buf) - 1) if i else heads] = END[0]
    return out


def _owners(first: np.ndarray, n: int) -> np.ndarray:
    """The number of the run each of ``n`` places lies in, from where the runs begin."""
    edge = np.zeros(n, dtype=np.int64)
    edge[first[1:]] = 1
    return np.cumsum(edge, out=edge)


def _scatter(key: np.ndarray, table_bits: int) -> np.ndarray:
    """Table slots of 32-bit keys."""
    key = key * np.uint32(0x85EBCA6B)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0xC2B2AE35)
    return key >> np.uint32(32 - table_bits)


def _contexts(buf: np.ndarray, heads: np.ndarray, table_bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The two bytes before each byte, and its hashed contexts.

    The contexts are the three bytes before, the word so far, and a third one:
    where a word begins, its bytes so far with the last short word of the text
    (mostly a function word, which tells language and syntax), and from its
    third byte on the five bytes before.
    """
    n = len(buf)
    one = _before(buf, heads, 1)
    pair = _before(buf, heads, 2) * np.uint32(256) + one
    three = _before(buf, heads, 3)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint32)
    terms = up[:n].astype(np.uint32)
    terms *= buf + np.uint32(1)
    np.cumsum(terms, out=sums[1:])
    begins = np.ones(n, dtype=bool)
    np.less_equal(buf[:-1], 32, out=begins[1:])  # texts end in a line feed
    first = np.flatnonzero(begins)  # where words begin
    sizes, word = np.diff(first, append=n), _owners(first, n)
    prefix = (sums[:n] - sums[first].take(word)) * down[first].astype(np.uint32).take(word)
    hashes = prefix[first + sizes - 1]  # of whole words
    number = np.arange(len(first))
    short = np.maximum.accumulate(np.where((sizes - 1 <= SHORT_WORD) & (sizes > 1), number, -1))
    last = np.concatenate(([-1], short[:-1]))
    text = np.searchsorted(first, heads)  # the first word of each text
    known = (last >= 0) & (last >= np.repeat(text, np.diff(text, append=len(first))))
    hint = np.where(known, hashes[np.maximum(last, 0)], np.uint32(7)) * np.uint32(0x9E3779B1)
    prefix ^= prefix >> np.uint32(13)
    early = begins  # the first three bytes of a word
    early[1:] |= begins[:-1].copy()
    early[1:] |= begins[:-1].copy()
    begun = prefix * np.uint32(0x27D4EB2F) + hint.take(word)
    five = ((pair << np.uint32(16)) + (three << np.uint32(8)) + _before(buf, heads, 4)) * np.uint32(0x9E3779B1) + _before(buf, heads, 5)
    keys = ((pair << np.uint32(8)) + three + np.uint32(1 << 30), prefix, np.where(early, begun, five))
    return pair, [_scatter(k, table_bits) for k in keys]


def _steps(codes: Codes, streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ends of the texts in decisions, the byte of each decision and its step, and the hashed contexts of each byte."""
    buf = np.frombuffer(b"".join(streams), dtype=np.uint8)
    sizes = np.array([len(s) for s in streams])
    heads = np.cumsum(sizes) - sizes
    pair, hashed = _contexts(buf, heads, codes.table_bits)
    at = codes.code_of_pair.take(pair) * 256 + buf
    stops, owner, step = _spell(codes, at)
    return stops[heads + sizes - 1], owner, step, hashed


def _spell(codes: Codes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The paths of (code, byte) pairs one after another: their ends, the pair of each decision and its step."""
    begin, lengths = codes.start.take(at), codes.length.take(at)
    stops = np.cumsum(lengths, dtype=np.int64)
    first, n = stops - lengths, int(stops[-1]) if len(stops) else 0
    owner = _owners(first, n)
    path = (begin - first).take(owner, mode="clip")
    path += np.arange(n)
    return stops, owner, codes.step.take(path, mode="clip")


def decisions(codes: Codes, streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ends of the texts in decisions, the decided bits, and the slot of each context for each decision."""
    ends, owner, step, hashed = _steps(codes, streams)
    return ends, (step & np.uint16(1)).astype(np.uint8), [slot.copy() for slot in _slots(owner, step, hashed)]


def _slots(owner: np.ndarray, step: np.ndarray, hashed: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The slots of each context, one context after another in the same memory."""
    node, slot = (step >> np.uint16(1)).astype(np.int64), np.empty(len(owner), dtype=np.int64)
    for h in hashed:
        h.astype(np.int64).take(owner, out=slot, mode="clip")
        slot ^= node
        yield slot


def count_streams(codes: Codes, streams: list[bytes], tables: list[np.ndarray]) -> None:
    """Add the decisions of the streams to the tables: one count for each slot and bit.

    Bytes that recur in a context are spelled once, with their number.
    """
    keys: list[list] = [[] for _ in tables]
    for a, b in batches_of(streams, CUT_BYTES):
        buf = np.frombuffer(b"".join(streams[a:b]), dtype=np.uint8)
        sizes = np.array([len(s) for s in streams[a:b]])
        pair, hashed = _contexts(buf, np.cumsum(sizes) - sizes, codes.table_bits)
        at = codes.code_of_pair.take(pair) * 256 + buf
        for held, h in zip(keys, hashed):
            held.append(h.astype(np.uint64) << np.uint64(32) | at.astype(np.uint64))
    for table, held in zip(tables, keys):
        if not held:
            continue
        key = np.concatenate(held)
        held.clear()
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        times, key = np.diff(first, append=len(key)).astype(np.uint32), key[first]
        for c in range(0, len(key), CUT_BYTES):
            some = key[c : c + CUT_BYTES]
            _, owner, step = _spell(codes, (some & np.uint64(0xFFFFFFFF)).astype(np.int64))
            place = (some >> np.uint64(32) << np.uint64(1)).astype(np.int64).take(owner, mode="clip")
            place ^= step
            np.add.at(table, place, times[c : c + CUT_BYTES].take(owner, mode="clip"))


def mix(packed: np.ndarray, first: np.ndarray, size: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log2 probability of each lane, and its last weights.

    A lane is a run of decisions in ``packed`` that share weights: those of one
    text with one gate. It has its first weights in ``start`` and learns from
    all its own past decisions alone, so lanes advance together, one decision a
    step. ``packed`` holds a decision in four signed bytes (the log odds of the
    contexts and a one, negative where the bit is 0) and goes on for ``STEPS``
    unused places.
    """
    order = np.argsort(-size, kind="stable")
    log2, last = np.zeros(len(first)), start.astype(np.float64)
    windows = {n: np.lib.stride_tricks.sliding_window_view(packed, n) for n in (STEPS // 8, STEPS)}
    for a in range(0, len(order), LANES):
        lanes = order[a : a + LANES]
        at, rest = first[lanes], size[lanes]
        # Signals carry the sign of what happened and the root of the rate, weights are divided by it:
        # the chance of the other bit is the step's length.
        w = np.ascontiguousarray((start[lanes] / SCALE).astype(np.float32).T)
        while len(lanes) >= NARROW:
            steps = STEPS if len(lanes) <= LANES // 2 else STEPS // 8
            signals = _signals(windows[steps][at])
            wrong = np.zeros((steps, len(lanes)), dtype=np.float32)
            ended = int(np.searchsorted(-rest, -steps, "right"))  # lanes from here on end in these steps
            over = np.arange(steps)[:, None] >= rest[ended:]
            signals[:, :, ended:] *= ~over[:, None]  # a signal of 0 leaves the weights as they are
            _advance(w, signals, wrong)
            wrong[:, ended:][over] = 0
            log2[lanes] += np.log2(np.maximum(1 - wrong, 1e-7)).sum(axis=0, dtype=np.float64)
            ended = int(np.searchsorted(-rest, -steps, "left"))
            if ended < len(lanes):
                last[lanes[ended:]] = w[:, ended:].T * SCALE
                lanes, at, rest, w = lanes[:ended], at[:ended], rest[:ended], np.ascontiguousarray(w[:, :ended])
            at, rest = at + steps, rest - steps
        for lane, p, n, own in zip(lanes.tolist(), at.tolist(), rest.tolist(), w.T):
            log2[lane] += _go_on(packed[p : p + n], own)
            last[lane] = own * SCALE
    return log2, last


def _advance(w: np.ndarray, signals: np.ndarray, wrong: np.ndarray) -> None:
    """Bring weights forward step by step; ``wrong`` takes the chance of what did not happen."""
    multiply, add, exp, reciprocal, dot = np.multiply, np.add, np.exp, np.reciprocal, np.dot
    product, one = np.empty_like(w), np.ones(w.shape[1], dtype=np.float32)
    with np.errstate(over="ignore"):
        for signal, other in zip(signals, wrong):
            multiply(w, signal, product)
            dot(EACH, product, other)
            exp(other, other)
            add(other, one, other)
            reciprocal(other, other)
            multiply(signal, other, signal)
            add(w, signal, w)


def _signals(packed: np.ndarray) -> np.ndarray:
    """The four inputs of packed decisions (lane by step), as (step, input, lane)."""
    raw = np.ascontiguousarray(packed.T).view(np.int8).reshape(*packed.shape[::-1], CONTEXTS + 1)
    out = np.empty((packed.shape[1], CONTEXTS + 1, packed.shape[0]), dtype=np.float32)
    for k, factor in enumerate(FACTORS):
        np.multiply(raw[..., k], factor, out=out[:, k])
    return out


def _go_on(packed: np.ndarray, w: np.ndarray) -> float:
    """The decisions of one lane in turn, as in ``mix``; ``w`` (its weights) is brought forward."""
    (i, j, k, c), log2 = w.tolist(), 0.0
    for a in range(0, len(packed), 1 << 14):
        wrong = []
        for x, y, z, one in _signals(packed[None, a : a + (1 << 14)])[..., 0].tolist():
            other = 1 / (1 + math.exp(min(i * x + j * y + k * z + c * one, 700.0)))
            wrong.append(other)
            i, j, k, c = i + other * x, j + other * y, k + other * z, c + other * one
        log2 += float(np.log2(np.maximum(1 - np.array(wrong), 1e-7)).sum())
    w[:] = i, j, k, c
    return log2


def inputs_of(model: Model, slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Log odds of every context for each decision, and the gate."""
    found = _look_up(model, slots)
    return [(f >> np.uint16(8)).astype(np.uint8).view(np.int8) for f in found], _gates(found)


def _look_up(model: Model, slots: Iterable[np.ndarray]) -> list[np.ndarray]:
    return [table.take(slot, mode="clip") for table, slot in zip(model.tables, slots)]


def _gates(found: list[np.ndarray]) -> np.ndarray:
    """How much was seen of the two last contexts."""
    return ((found[-2] & np.uint16(3)) << np.uint16(2) | (found[-1] & np.uint16(3))).astype(np.uint8)


def _pack_signed(found: list[np.ndarray], bit: np.ndarray) -> np.ndarray:
    """Four signed bytes a decision: the log odds of the contexts and a one, all negative where the bit is 0."""
    one, two, three = found
    turn = bit - np.uint16(1)
    carry = turn & np.uint16(0x0101)
    rows = np.empty((len(bit), 2), dtype=np.uint16)
    for k, pair in enumerate(((one >> np.uint16(8)) | (two & np.uint16(0xFF00)), (three >> np.uint16(8)) | np.uint16(0x0100))):
        # Two's complement of each byte: all bits turned, and one added without a carry into the next byte.
        pair ^= turn
        high = pair & np.uint16(0x8080)
        pair &= np.uint16(0x7F7F)
        pair += carry
        np.bitwise_xor(pair, high, out=rows[:, k])
    return rows.view(np.uint32).ravel()


def first_weights() -> np.ndarray:
    return np.tile(np.array([0.4, 0.4, 0.4, 0.0], dtype=np.float32), (GATES, 1))


def lanes_of(model: Model, streams: list[bytes]) -> tuple[np.ndarray, ...]:
    """The streams as lanes for ``mix``: packed decisions, then first place, size, text and gate of each lane.

    Decisions with different gates share no weights, so each gate of each text is a lane.
    """
    packed, parts, done = np.empty(3 * sum(map(len, streams)), dtype=np.uint32), [], 0
    for a, b in batches_of(streams, CUT_BYTES):  # what lies in the caches is quick to hash and look up
        ends, owner, step, hashed = _steps(model.codes, streams[a:b])
        n, found = len(step), _look_up(model, _slots(owner, step, hashed))
        rows, gate = _pack_signed(found, step & np.uint16(1)), _gates(found)
        # Most decisions have the last gate, so only the others are sorted.
        last = gate == GATES - 1
        main, others = np.flatnonzero(last), np.flatnonzero(~last)
        of = gate.take(others)
        order = np.argsort(of, kind="stable")
        others = others.take(order)
        # Where each text ends in each gate: places are told apart by gate for one search.
        place = others + of.take(order).astype(np.int64) * n
        stop = np.searchsorted(place, (np.arange(GATES - 1)[:, None] * n + ends).ravel())
        stop = np.concatenate((stop, len(others) + np.searchsorted(main, ends)))
        size = np.diff(stop, prepend=0)
        own = np.flatnonzero(size)
        if done + n + STEPS > len(packed):  # some room behind the last decision: lanes read ahead in whole steps
            packed.resize((done + n + STEPS) * 9 // 8, refcheck=False)
        middle = done + len(others)
        rows.take(others, out=packed[done:middle], mode="clip")
        rows.take(main, out=packed[middle : done + n], mode="clip")
        gates, texts = np.divmod(own, len(ends))
        parts.append((done + (stop - size)[own], size[own], texts + a, gates))
        done += n
    packed[done : done + STEPS] = 0
    return packed[: done + STEPS], *map(np.concatenate, zip(*parts))


def score_streams(model: Model, streams: list[bytes], rounds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Log2 probability of each stream, and the mean of the weights at their ends by their decisions.

    In further rounds the streams start from these weights.
    """
    mean, log2 = model.weights.astype(np.float64), np.zeros(len(streams))
    if not streams:
        return log2, mean
    packed, first, size, text, gate = lanes_of(model, streams)
    share = np.bincount(text, size)[text] / size.sum()
    for _ in range(rounds):
        start = mean[gate]
        by_lane, last = mix(packed, first, size, start)
        np.add.at(mean, gate, (last - start) * share[:, None])
    return np.bincount(text, by_lane), mean


def batches_of(texts: list, size: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


# -- Training -----------------------------------------------------------------
def gather_counts(train: DataFrame) -> DataFrame:
    """Counts over training texts: ``kind, key, n`` for words (0; the end is the empty key) and byte triples (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples = np.zeros(1 << 24, dtype=np.uint32)

        def rows(kind: int, keys: pa.Array, n: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), keys, n], names=["kind", "key", "n"])

        for piece in slices(batches, WORD_BYTES):  # a bounded memory: what is counted so far goes on as a partial count
            words = words_in(piece.column(0))
            seen = words.values.value_counts()
            yield rows(0, seen.field("values"), seen.field("counts"))
            yield rows(0, pa.array([b""]), pa.array([len(words)], pa.int64()))
            streams = streams_in(words)
            for a, b in batches_of(streams, BATCH_BYTES):
                buf = np.frombuffer(b"".join(streams[a:b]), dtype=np.uint8)
                sizes = np.array([len(s) for s in streams[a:b]])
                heads = np.cumsum(sizes) - sizes
                key = (_before(buf, heads, 2) << np.uint32(16)) + (_before(buf, heads, 1) << np.uint32(8)) + buf
                np.add.at(triples, key.astype(np.int64), np.uint32(1))
            del words, seen
        pa.default_memory_pool().release_unused()
        found = np.flatnonzero(triples)
        if len(found):
            yield rows(1, pa.array([int(k).to_bytes(3, "big") for k in found], pa.binary()), pa.array(triples[found].astype(np.int64)))

    counted = train.select("text").mapInArrow(run, "kind int, key binary, n bigint")
    return materialize(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")))


def learn_codes(counts: DataFrame, pair_codes: int = PAIR_CODES, table_bits: int = TABLE_BITS) -> Codes:
    """Codes from byte triples: at most 65,536 single rows and 256 rows for each chosen pair reach the driver."""
    t = counts.filter("kind = 1").select(F.hex("key").alias("h"), "n")
    t = materialize(t.select(F.substring("h", 1, 4).alias("pair"), F.substring("h", 3, 2).alias("last"), F.substring("h", 5, 2).alias("byte"), "n"))
    best = t.groupBy("pair").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "pair").limit(pair_codes)
    pairs: dict[int, dict[int, int]] = {}
    for r in t.join(F.broadcast(best), "pair").select("pair", "byte", "n").collect():
        pairs.setdefault(int(r["pair"], 16), {})[int(r["byte"], 16)] = r["n"]
    singles: dict[int, dict[int, int]] = {}
    for r in t.groupBy("last", "byte").agg(F.sum("n").alias("n")).collect():
        singles.setdefault(int(r["last"], 16), {})[int(r["byte"], 16)] = r["n"]
    return build_codes(singles, pairs, table_bits)


def count_chunks(train: DataFrame, codes: Codes) -> DataFrame:
    """Counts of the hashed tables by task, in chunks: ``k, chunk, counts``."""
    sent = train.sparkSession.sparkContext.broadcast(codes)
    size, step = 1 << codes.table_bits, 2 << min(CHUNK_BITS, codes.table_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        tables = [np.zeros(2 * size, dtype=np.uint32) for _ in range(CONTEXTS)]
        for piece in slices(batches, COUNT_BYTES):
            count_streams(sent.value, streams_in(words_in(piece.column(0))), tables)
        for k, table in enumerate(tables):
            for c in range(0, len(table), step):
                part = table[c : c + step]
                if part.any():
                    blob = press(part)
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([c // step], pa.int32()), pa.array([blob], pa.binary())], names=["k", "chunk", "counts"])

    return train.select("text").mapInArrow(count, "k int, chunk int, counts binary")


def sum_chunks(chunks: DataFrame, table_bits: int) -> DataFrame:
    """Chunks of the same place summed, as 64-bit counts."""
    step = 2 << min(CHUNK_BITS, table_bits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, press = None, None, zstandard.ZstdCompressor(level=1).compress

        def close() -> pa.RecordBatch:
            blob = press(held)
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([blob], pa.binary())], names=["k", "chunk", "counts"])

        for batch in batches:
            for k, c, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k, c) != key:
                    if key is not None:
                        yield close()
                    key, held = (k, c), np.zeros(step, dtype=np.uint64)
                raw = zstandard.decompress(blob)
                held += np.frombuffer(raw, dtype=np.uint32 if len(raw) == 4 * step else np.uint64)
        if key is not None:
            yield close()

    return chunks.repartition("k", "chunk").sortWithinPartitions("k", "chunk").mapInArrow(add, chunks.schema)


def learn_tables(summed: DataFrame, table_bits: int) -> list[np.ndarray]:
    """The hashed tables from summed chunks: ``CONTEXTS`` times two bytes for each slot, a fixed size."""

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, blob in enumerate(batch.column(2).to_pylist()):
                held = np.frombuffer(zstandard.decompress(blob), dtype=np.uint64)
                packed = pa.array([pack(held[0::2], held[1::2]).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), packed], names=["k", "chunk", "odds"])

    tables = [np.zeros(1 << table_bits, dtype=np.uint16) for _ in range(CONTEXTS)]
    for r in summed.mapInArrow(odds, "k int, chunk int, odds binary").toLocalIterator():
        part = np.frombuffer(r["odds"], dtype=np.uint16)
        tables[r["k"]][r["chunk"] * len(part) : (r["chunk"] + 1) * len(part)] = part
    return tables


def pack(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds in the high byte; in the low one how much was seen: nothing, up to 3, up to 39, more."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    odds = np.clip(np.rint(np.log((b + 0.1) / (a + 0.1)) * ODDS), -127, 127).astype(np.int8)
    seen = np.searchsorted([1, 4, 40], a + b, "right").astype(np.uint16)
    return (odds.view(np.uint8).astype(np.uint16) << np.uint16(8)) | seen


def learn_weights(sample: DataFrame, model: Model) -> np.ndarray:
    """Weights after a few passes over texts that the tables have not counted: the mean over all slices by their bytes."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def run(cols: dict) -> dict:
        streams = [stream_of(words_of(t)) for t in cols["text"]]
        _, weights = score_streams(sent.value, streams, WEIGHT_ROUNDS)
        return {"size": [sum(map(len, streams))], "w": [weights.ravel().tolist()]}

    found = map_rows(sample.select("text"), "size bigint, w array<double>", run, max_bytes=SCORE_BYTES).collect()
    sent.unpersist()
    if not found:
        return model.weights
    sizes = np.array([r["size"] for r in found], dtype=float)
    return (np.array([r["w"] for r in found]) * sizes[:, None] / sizes.sum()).sum(axis=0).reshape(GATES, -1)


def train_model(docs: DataFrame, train: Column, counts: DataFrame, table_bits: int = TABLE_BITS) -> Model:
    """Codes, tables and first weights from the training rows of ``docs``.

    The weights are fitted over a share of the texts against tables of all
    others; then the tables count that share too.
    """
    rows = docs.select("doc_id", "text").filter(train)
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(WEIGHT_SHARE)) == 0
    held = materialize(rows.filter(apart).select("text"))
    codes = learn_codes(counts, table_bits=table_bits)
    others = materialize(sum_chunks(count_chunks(rows.filter(~apart), codes), table_bits))
    model = Model(codes, learn_tables(others, table_bits), first_weights())
    model.weights = learn_weights(held, model)
    everything = sum_chunks(others.unionByName(count_chunks(held, codes)), table_bits)
    model.tables = learn_tables(everything, table_bits)
    discard(others)
    discard(held)
    return model


# -- Scoring ------------------------------------------------------------------
def count_words(words: pa.ListArray, known: pa.Array, logs: np.ndarray) -> dict:
    """Per text the number of its tokens, the sum and number of the known ones, and the distinct others with their numbers."""
    n, sizes = len(words), np.diff(words.offsets.to_numpy())
    tokens = pa.concat_arrays([words.values, pa.array([b""] * n, pa.binary())])  # and the ends
    text = np.concatenate((np.repeat(np.arange(n), sizes), np.arange(n)))
    found = pc.index_in(tokens, value_set=known).fill_null(-1).to_numpy()
    near, far = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
    others = tokens.take(pa.array(far)).dictionary_encode()
    distinct = max(1, len(others.dictionary))
    pairs, times = np.unique(text[far] * distinct + others.indices.to_numpy(), return_counts=True)
    offsets = np.searchsorted(pairs, np.arange(n + 1) * distinct).astype(np.int32)
    return {
        "n_tokens": sizes + 1,
        "near": np.bincount(text[near], logs[found[near]], minlength=n),
        "n_near": np.bincount(text[near], minlength=n),
        "rare": pa.ListArray.from_arrays(offsets, others.dictionary.take(pa.array(pairs % distinct))),
        "times": pa.ListArray.from_arrays(offsets, times.astype(np.int32)),
    }


def score(docs: DataFrame, train: Column, table_bits: int = TABLE_BITS, frequent_words: int = FREQUENT) -> DataFrame:
    """Model and base scores of every row of ``docs``.

    Returns ``doc_id, trained, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte``. Rows with ``train`` true teach the model. A null
    or empty text is the end alone; without training rows every count is 0
    and every decision even. Repeated rows are scored (and learned from) row
    by row; a null ``doc_id`` is kept. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", train.alias("trained"))
    counts = gather_counts(marked.filter("trained"))
    vocabulary = counts.filter("kind = 0").select("key", "n")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, norm = total["n"], math.log10(total["n"] + total["v"] + 1)
    top = vocabulary.filter((F.length("key") <= LONGEST) & (F.col("n") * frequent_words >= n_train))
    frequent = {bytes(r["key"]): math.log10(r["n"] + 1) for r in top.collect()}
    model = train_model(marked, F.col("trained"), counts, table_bits)
    sent, common = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(frequent)

    schema = "doc_id bigint, trained boolean, n_tokens bigint, near double, n_near bigint, rare array<binary>, times array<int>, log2 double, n_bytes bigint"
    target = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        model.tables = [t.copy() for t in model.tables]  # in memory that numpy lays out for look-ups
        known, logs = pa.array(list(common.value), pa.binary()), np.array(list(common.value.values()))
        for piece in slices(batches, SCORE_BYTES):
            streams, counted = [], []
            for part in slices(iter([piece]), WORD_BYTES):
                words = words_in(part.column("text"))
                out = {"doc_id": part.column("doc_id"), "trained": part.column("trained")} | count_words(words, known, logs)
                streams += (own := streams_in(words))
                counted.append(out | {"n_bytes": [len(s) for s in own]})
                del words
            pa.default_memory_pool().release_unused()  # the lanes need it more
            log2 = score_streams(model, streams)[0]
            for out in counted:
                out["log2"], log2 = np.split(log2, [len(out["n_bytes"])])
                yield pa.RecordBatch.from_arrays([c if isinstance(c := out[f.name], pa.Array) else pa.array(c, type=f.type) for f in target], schema=target)

    scored = marked.mapInArrow(run, schema)
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()))
    pairs = scored.select("row", F.explode(F.arrays_zip(F.col("rare").alias("key"), F.col("times").alias("times"))).alias("p"))
    far = pairs.select("row", "p.key", "p.times").join(vocabulary, "key", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("far"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_far"),
    )
    zero = F.lit(0.0)
    return scored.drop("rare", "times").join(far, "row", "left").select(
        "doc_id", "trained", "n_tokens", (F.col("n_near") + F.coalesce("n_far", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("near") + F.coalesce("far", zero) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("log2") * F.lit(math.log10(2))).alias("score"), (-F.col("log2") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 7) == 2
    return score(read_table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", ~F.col("trained")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
