"""BPE encoding as a bounded-lookahead transducer, and incremental decoding.

From the merge list alone follows how many bytes to the right of a position
can still change the tokens that end there (``sufficient_lookahead``). The
encoder holds a window of a piece, merges it, emits every token that ends at
least that many bytes before the window's end, and goes on from there: no
merge ever crosses such an end, so the rest encodes as if it stood alone.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, read_table
from tripmart.llm.tokencount import NONE, _every_other, byte_symbols

#: Bytes a window holds besides the lookahead; pieces each of a task's two memories holds; bytes of a short piece.
WINDOW, REMEMBERED, SHORT = 1024, 75_000, 64
#: Pieces that are looked up together, and characters from which a text is split step by step.
TOGETHER, LONG = 1 << 16, 1 << 20
#: The pre-token pattern of the format (fixed value), with Unicode white space spelled out.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+"
)
#: Beyond these scripts the library's own pre-tokeniser cuts, since Unicode versions differ there.
_RARE = re.compile("[^\x00-ԯ -⁯]")


def sufficient_lookahead(merges: list[tuple[int, int]], made: list[int], sizes: list[int]) -> int:
    """Bytes to the right of a place after which tokens ending there can no longer change.

    One pass in rank order. ``own[t]`` bounds the bytes beyond the end of
    ``t`` that decide whether ``t`` is formed, ``next[t]`` those that decide
    whether a rule so far takes ``t`` as its left part. A rule ``(l, r) -> t``
    waits for what decides ``r`` being free, for what decides ``l`` being free
    less the bytes of ``r``, and for what decides any token to the left less
    the bytes of ``t``.
    """
    n = len(sizes)
    own, following, most = [0] * n, [0] * n, 0
    for (left, right), t in zip(merges, made):
        free = max(own[right], following[right])
        beyond = max(own[left], following[left]) - sizes[right]
        own[t] = max(own[t], free, beyond, most - sizes[t])
        following[left] = max(following[left], sizes[right] + free)
        most = max(most, own[t])
    return max(max(own), max(following))


class Memory:
    """Pieces met lately with their ids: two generations of bounded size.

    A piece that is met again moves to the younger one; when that is full it
    becomes the older one, which goes. Frequent pieces so never leave.
    """

    def __init__(self, room: int = REMEMBERED):
        self.room = room
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, pieces: set[str]) -> dict[str, bytes]:
        found = {}
        for p in pieces:
            ids = self.young.get(p) or self.old.get(p)
            if ids is not None:
                found[p] = ids
        return found

    def keep(self, pieces: dict[str, bytes]) -> None:
        self.young.update(pieces)
        if len(self.young) >= self.room:
            self.young, self.old = {}, self.young


class Transducer:
    """Tables of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.byte = [vocab[c] for c in symbols]
        self.rule = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self._tables(vocab, pairs)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.special = {t: i.to_bytes(4, "little") for t, i in added.items()}
        self.cut = re.compile("(" + ("|".join(map(re.escape, added)) or r"(?!)") + ")")
        self.lookahead = sufficient_lookahead(
            [(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs], [len(b) for b in self.bytes_of]
        )
        self.window = max(WINDOW, max(map(len, self.bytes_of)))
        self.path, self.library_split = path, None

    def _tables(self, vocab: dict[str, int], pairs: list[tuple[str, str]]) -> None:
        """The merge list as sorted arrays, for pieces that are merged side by side."""
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], np.arange(len(keys))[order], made[order]
        born = np.full(self.size, -1)
        born[made] = np.arange(len(made))
        parts = np.array([[vocab[a], vocab[b]] for a, b in pairs])
        #: Every merge comes after those that make its parts: equal pairs of a piece may then merge at once.
        self.ordered = bool((born[parts].max(axis=1) < np.arange(len(parts))).all())
        self.first = np.array(self.byte, dtype=np.int64)

    def merge_together(self, raws: list[bytes]) -> list[bytes]:
        """Packed ids of short pieces, each round merging the lowest pair of every piece at once."""
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        ids, owner = self.first[np.frombuffer(b"".join(raws), dtype=np.uint8)], np.repeat(np.arange(len(raws)), sizes)
        done_ids, done_owner = [], []
        while len(ids):
            keys = ids[:-1] * self.size + ids[1:]
            slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = (self.keys[slot] == keys) & (owner[:-1] == owner[1:])
            ranks = np.append(np.where(known, self.ranks[slot], NONE), NONE)
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(ranks, heads)
            best = np.repeat(best, np.diff(np.append(heads, len(ids))))
            ended = best == NONE
            done_ids.append(ids[ended])
            done_owner.append(owner[ended])
            at = np.flatnonzero((ranks == best) & ~ended)
            at = _every_other(at) if self.ordered else at[np.diff(owner[at], prepend=-1) != 0]
            keep = ~ended
            ids[at] = self.made[slot[at]]
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        owners = np.concatenate(done_owner) if done_owner else np.empty(0, np.int64)
        order = np.argsort(owners, kind="stable")
        packed = np.concatenate(done_ids)[order].astype("<u4").tobytes() if len(owners) else b""
        ends = np.cumsum(np.bincount(owners, minlength=len(raws))) * 4
        return [packed[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def merge(self, raw: bytes) -> list[int]:
        """BPE of bytes that are held whole."""
        ids, rule = [self.byte[b] for b in raw], self.rule
        if len(ids) > SHORT:
            return self._merge_heap(ids)
        while len(ids) > 1:
            best = None
            for pair in zip(ids, ids[1:]):
                found = rule.get(pair)
                if found is not None and (best is None or found < best):
                    best, at = found, pair
            if best is None:
                break
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and ids[i] == at[0] and ids[i + 1] == at[1]:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_heap(self, ids: list[int]) -> list[int]:
        """The same for longer runs: pairs by rank, then place, in a heap over a linked list."""
        n, rule = len(ids), self.rule
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*rule[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rule]
        heap = [(rank, i, made, a, b) for rank, made, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (ids[x], ids[y]) in rule:
                    rank, product = rule[ids[x], ids[y]]
                    heapq.heappush(heap, (rank, x, product, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def stream(self, raw: bytes) -> Iterator[list[int]]:
        """Tokens of one piece, emitted once stable; the window is the only state."""
        at, hold = 0, self.window + self.lookahead
        while len(raw) - at > hold:
            ids = self.merge(raw[at : at + hold])
            end, out = 0, []
            for i in ids:
                if end + len(self.bytes_of[i]) > self.window:
                    break
                end += len(self.bytes_of[i])
                out.append(i)
            yield out
            at += end
        yield self.merge(raw[at:])

    def piece(self, text: str) -> bytes:
        return b"".join(np.array(ids, dtype="<u4").tobytes() for ids in self.stream(text.encode()))

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and _RARE.search(text):
            if self.library_split is None:
                from tokenizers import Tokenizer

                self.library_split = Tokenizer.from_file(self.path).pre_tokenizer.pre_tokenize_str
            return [text[a:b] for _, (a, b) in self.library_split(text)]
        return _PIECES.findall(text)

    def steps(self, text: str) -> Iterator[list[str]]:
        """Pieces of a text, a bounded number at a time if it is long."""
        if len(text) <= LONG or (not text.isascii() and _RARE.search(text)):
            yield self.pieces(text)
            return
        found = (m.group() for m in _PIECES.finditer(text))
        while some := list(islice(found, TOGETHER)):
            yield some

    def encode_all(self, texts: list[str | None], memory: Memory) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str] | bytes]] = []
        count = 0
        for i, text in enumerate(texts):
            for part in self.cut.split(text or ""):
                if part in self.special:
                    waiting.append((i, self.special[part]))
                    continue
                for some in self.steps(part):
                    waiting.append((i, some))
                    count += len(some)
                    if count >= TOGETHER:
                        self._answer(waiting, out, memory)
                        waiting, count = [], 0
        self._answer(waiting, out, memory)
        return [b"".join(x) for x in out]

    def _answer(self, waiting: list[tuple[int, list[str] | bytes]], out: list[list[bytes]], memory: Memory) -> None:
        """Append the ids of waiting pieces, merging each unknown one once."""
        distinct = set().union(*[x for _, x in waiting if isinstance(x, list)])
        table = memory.known(distinct)
        fresh = {p: p.encode() for p in distinct if p not in table}
        short = [p for p, raw in fresh.items() if len(raw) <= SHORT]
        table.update(zip(short, self.merge_together([fresh[p] for p in short])))
        memory.keep({p: table[p] for p in distinct if len(p) <= SHORT and p in table})
        table.update((p, self.piece(p)) for p in fresh if p not in table)
        for i, x in waiting:
            out[i].append(x if isinstance(x, bytes) else b"".join(map(table.__getitem__, x)))

    def encode(self, text: str | None, memory: Memory) -> bytes:
        return self.encode_all([text], memory)[0]

    def decode(self, ids: bytes, step: int = 1 << 16) -> str:
        """Text of packed ids; a byte sequence cut between steps waits in the decoder's state."""
        machine, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        numbers, table = np.frombuffer(ids, dtype="<u4"), self.bytes_of
        for i in range(0, len(numbers), step):
            out.append(machine.decode(b"".join([table[x] for x in numbers[i : i + step].tolist()])))
        return "".join([*out, machine.decode(b"", final=True)])


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every row, ``ids`` packed as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids; special strings in a text become their
    token; repeated rows are encoded row by row; an empty table gives an
    empty one. A very long text is split a bounded number of pieces at a time
    (whole, where rare scripts need the library's own splitting), so beside it
    only its ids are held. Only ``doc_id`` and ``text`` are read.
    """
    memory = Memory()  # of one task: it goes when the task ends

    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "ids": transducer(path).encode_all(cols["text"], memory)}

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, ids binary", run)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``; null ids give the empty text."""

    def run(cols: dict) -> dict:
        t = transducer(path)
        return {"doc_id": cols["doc_id"], "ids": cols["ids"], "text": [t.decode(x or b"") for x in cols["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), "doc_id bigint, ids binary, text string", run)


def transcode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: every row encoded and its ids decoded again, in one pass over the texts.

    Answers as :func:`encode` followed by :func:`decode`, with one Python
    worker for each running task instead of two.
    """
    memory = Memory()

    def run(cols: dict) -> dict:
        t = transducer(path)
        ids = t.encode_all(cols["text"], memory)
        return {"doc_id": cols["doc_id"], "ids": ids, "text": [t.decode(x) for x in ids]}

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, ids binary, text string", run)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of the encoded and the decoded form of every row."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return transcode(docs, path).select(
        "doc_id", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))
