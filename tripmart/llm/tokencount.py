"""Token counts by rank-synchronous merging of ragged arrays.

Texts become chunks between white space; each distinct chunk of a slice is
cut into pre-tokens whose symbols lie in one flat array. In every round each
pre-token applies its lowest-rank pair, all pre-tokens at once; pre-tokens
without a mergeable pair leave, and their surviving symbols are counted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, read_table

LIMIT = 2048
#: Distinct chunks a task remembers; the memory is emptied when full, the counts stay the same.
REMEMBERED = 150_000
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character of each byte in byte-level vocabularies (fixed values of the format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + rest.index(b)) for b in range(256)]


class Merger:
    """Vocabulary and merge ranks of a word-end BPE file, as sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in byte_symbols()], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], np.arange(len(keys))[order], made[order]
        born = np.full(self.size, -1)
        born[made] = np.arange(len(made))
        parts = np.array([[vocab[a], vocab[b]] for a, b in pairs])
        #: Every merge comes after the merges that make its parts: equal pairs may then merge in one round.
        self.ordered = bool((born[parts].max(axis=1) < np.arange(len(parts))).all())
        self.specials = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.back = {c: b for b, c in enumerate(byte_symbols())}

    def pre_tokens(self, chunk: bytes) -> list[bytes]:
        if chunk.isascii():
            return [p.encode() for p in _ASCII.findall(chunk.decode().lower())]
        pieces = self.split(self.normalize(chunk.decode()))
        return [bytes(self.back[c] for c in piece) for piece, _ in pieces]

    def merge_counts(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each word; words are not empty."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.inner[np.frombuffer(b"".join(words), dtype=np.uint8)]
        stops = np.cumsum(lengths)
        ids[stops - 1] = self.last[np.frombuffer(b"".join(w[-1:] for w in words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        out = np.ones(len(words), dtype=np.int64)
        while len(ids):
            ranks, made = self._lookup(ids, owner)
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(ranks, heads)
            sizes = np.diff(np.append(heads, len(ids)))
            ended = best == NONE
            out[owner[heads[ended]]] = sizes[ended]
            chosen = (ranks == np.repeat(best, sizes)) & (ranks != NONE)
            at = np.flatnonzero(chosen)
            if self.ordered:
                at = _every_other(at)
            else:  # the leftmost of each sequence only
                at = at[np.diff(owner[at], prepend=-1) != 0]
            keep = np.repeat(~ended, sizes)
            ids[at] = made[at]
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        return out

    def _lookup(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each symbol (``NONE`` without one)."""
        keys = ids[:-1] * self.size + ids[1:]
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[slot] == keys) & (owner[:-1] == owner[1:])
        ranks = np.append(np.where(known, self.ranks[slot], NONE), NONE)
        return ranks, np.append(self.made[slot], 0)

    def count(self, texts: list[str | None], seen: dict[bytes, int]) -> list[int]:
        """Tokens of whole texts; special strings count one each. ``seen`` remembers chunks."""
        split, extra = [], []
        for text in texts:
            text = text or ""
            special = self.specials.findall(text) if "<|" in text else ()
            extra.append(len(special))
            split.append((self.specials.sub("\n", text) if special else text).encode().split())
        if len(seen) > REMEMBERED:
            seen.clear()
        fresh = list({c for chunks in split for c in chunks if c not in seen})
        for i in range(0, len(fresh), 20_000):
            seen.update(self._counted(fresh[i : i + 20_000]))
        return [sum([seen[c] for c in chunks]) + n for chunks, n in zip(split, extra)]

    def _counted(self, chunks: list[bytes]) -> Iterator[tuple[bytes, int]]:
        words, owner = [], []
        for i, chunk in enumerate(chunks):
            pieces = self.pre_tokens(chunk)
            words += pieces
            owner += [i] * len(pieces)
        counts = np.zeros(len(chunks), dtype=np.int64)
        if words:
            np.add.at(counts, owner, self.merge_counts(words))
        return zip(chunks, counts.tolist())


def _every_other(at: np.ndarray) -> np.ndarray:
    """Of overlapping places (a run of neighbours) the first, third, fifth and so on."""
    if not len(at):
        return at
    head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    offset = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    return at[offset % 2 == 0]


_LOADED: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    if path not in _LOADED:
        _LOADED[path] = Merger(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Null and empty texts have no bytes and no tokens; a very long text is a
    slice of its own; repeated rows are counted row by row; an empty table
    gives an empty one. Only ``doc_id`` and ``text`` are read.
    """

    seen: dict[bytes, int] = {}

    def run(cols: dict) -> dict:
        counts = merger(path).count(cols["text"], seen)
        sizes = [len((t or "").encode()) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "n_bytes": sizes, "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    return map_rows(docs.select("doc_id", "text"), SCHEMA, run)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
