"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon is learned from labelled rows: words and word stems whose rate in
toxic texts exceeds that in others. Features for training are taken with a
lexicon from the other half of the sample, so the trees see hit rates as they
occur in new texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import crc_mod, hash_share, keep_rows, map_rows, read_table, slices

#: Bound of the labelled sample, and with it of the lexicon learned from it.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
MIN_ODDS, MIN_TOXIC = 2.0, 3
TREES, DEPTH, RATE, BINS, L2 = 60, 3, 0.2, 32, 1.0
#: Words that address the reader (fixed list, four languages).
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "usted ustedes tú ti tus vosotros os".split()
)
#: Characters written in place of letters (fixed list).
_LEET = str.maketrans("0134578@$!", "oieastbasi")
_EDGE = ".,;:?!\"'()[]{}<>|#*%&_-–…«»“”‘’"
FEATURES = (
    "log_words", "lexicon_max", "lexicon_density", "lexicon_hits", "stem_max", "stem_density", "near_second_person",
    "second_person_density", "capitals", "shouted_words", "exclamation", "punctuation", "obfuscation", "repeated_letters",
)


def fold(word: str) -> str:
    """A word without edge punctuation, in lower case, with letters for look-alike characters inside it."""
    core = word.strip(_EDGE).lower()
    return core if core.isalpha() or not any(c.isalpha() for c in core) else core.translate(_LEET).replace("*", "").replace(".", "")


def keys_of(word: str) -> list[str]:
    """Lexicon keys: the folded word, and its first four and five letters as stems."""
    core = fold(word)
    return [core] + [f"{core[:n]}~" for n in (4, 5) if len(core) > n] if core else []


def features(text: str | None, weights: dict[str, float], memory: dict[str, tuple]) -> list[float]:
    """The dense features of one whole text; ``memory`` keeps what is known of words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    known = []
    for w in words:
        k = memory.get(w)
        if k is None:
            k = memory[w] = _word(w, weights)
        known.append(k)
    word_w, stem_w, person, shouted, odd, drawn = np.array(known, dtype=np.float64).T
    hits = np.flatnonzero((word_w > 0) | (stem_w > 0))
    people = np.flatnonzero(person)
    near = 0.0
    if len(hits) and len(people):
        at = np.searchsorted(people, hits)
        right = np.abs(people[np.minimum(at, len(people) - 1)] - hits)
        near = 1.0 / (1.0 + min(right.min(), np.abs(people[np.maximum(at - 1, 0)] - hits).min()))
    raw = text.encode()
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    letters = max(1, len(text) - n)
    marks = len(raw) - len(raw.translate(None, b".,;:?!\"'()-#*%&$|<>"))
    return [
        math.log1p(n), word_w.max(), word_w.sum() / n, math.log1p(np.count_nonzero(word_w)), stem_w.max(), stem_w.sum() / n, near,
        person.sum() / n, upper / letters, shouted.sum() / n, (raw.count(b"!") + raw.count(b"?")) / n, marks / n, odd.sum() / n,
        drawn.sum() / n,
    ]


#: What is known of most words: nothing. They share one tuple.
PLAIN = (0.0, 0.0, False, False, False, False)


def _word(word: str, weights: dict[str, float]) -> tuple:
    keys = keys_of(word)
    core = keys[0] if keys else ""
    body = word.strip(_EDGE)
    odd = any(c.isalpha() for c in body) and any(c in "0134578@$!*" for c in body)
    drawn = any(a == b == c for a, b, c in zip(core, core[1:], core[2:]))
    stem = max([weights.get(k, 0.0) for k in keys[1:]], default=0.0)
    known = weights.get(core, 0.0), stem, core in SECOND_PERSON, len(body) > 2 and body.isupper(), odd, drawn
    return known if any(known) else PLAIN


def feature_rows(texts: list[str | None], weights: dict[str, float], memory: dict[str, tuple]) -> np.ndarray:
    if len(memory) > 150_000:  # what is remembered of words is bounded; forgetting changes nothing
        memory.clear()
    return np.array([features(t, weights, memory) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """Complete trees of ``DEPTH`` levels: split feature and threshold of inner nodes, values of leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (len(f))]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Logistic gradient boosting over quantile bins, second-order splits."""
    mean = np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T] if len(x) else []
    # Rare features are mostly zero: quantiles of their nonzero values are cuts as well.
    cuts = [np.unique(np.concatenate([c, [0.0], np.quantile(col[col > 0], np.linspace(0, 1, 9)) - 1e-9 if (col > 0).any() else []])) for c, col in zip(cuts, x.T)]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], axis=1) if len(x) else x
    margin, inner = np.full(len(x), base), (1 << DEPTH) - 1
    feature, threshold, value = [], [], []
    for _ in range(TREES if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(x), dtype=np.int64)
        f_at, t_at = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for j in range(inner):
            rows = np.flatnonzero(node == j)
            split = _best_split(binned[rows], g[rows], h[rows], cuts)
            if split is not None:
                f_at[j], t_at[j] = split[0], cuts[split[0]][split[1]]
            node[rows] = 2 * j + 1 + (x[rows, f_at[j]] > t_at[j])
        leaf = node - inner
        size = 1 << DEPTH
        v = RATE * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + L2)
        margin += v[leaf]
        feature.append(f_at), threshold.append(t_at), value.append(v)
    return Trees(base, np.array(feature, dtype=np.int64), np.array(threshold), np.array(value))


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, int] | None:
    best, found = 1e-6, None
    total = g.sum() ** 2 / (h.sum() + L2) if len(g) else 0.0
    for f in range(binned.shape[1] if len(g) else 0):
        size = len(cuts[f]) + 1
        gl = np.bincount(binned[:, f], g, size).cumsum()[:-1]
        hl = np.bincount(binned[:, f], h, size).cumsum()[:-1]
        gain = gl**2 / (hl + L2) + (g.sum() - gl) ** 2 / (h.sum() - hl + L2) - total
        if len(gain) and gain.max() > best:
            best, found = gain.max(), (f, int(gain.argmax()))
    return found


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: increasing steps ``(margins, probabilities)``."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, lowest and highest margin
    for m, t in zip(margin[order].tolist(), y[order].tolist()):
        blocks.append([t, 1.0, m, m])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            t2, n2, _, hi = blocks.pop()
            blocks[-1][0] += t2
            blocks[-1][1] += n2
            blocks[-1][3] = hi
    at = np.array([e for b in blocks for e in (b[2], b[3])])
    return at, np.repeat([b[0] / b[1] for b in blocks], 2)


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    trees: Trees
    steps: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str | None], memory: dict[str, tuple]) -> np.ndarray:
        margin = self.trees.margin(feature_rows(texts, self.weights, memory))
        at, p = self.steps
        out = np.interp(margin, at, p) if len(at) else 1 / (1 + np.exp(-margin))
        # Inside a flat step the margin still orders texts, by less than a step differs.
        return np.clip(out + 1e-6 / (1 + np.exp(-margin)), 0.0, 1.0)


def _lexicon(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    odds = {
        k: math.log((p + 0.5) / (n_toxic + 1)) - math.log((q + 0.5) / (n_clean + 1))
        for k, (p, q) in counts.items() if p >= MIN_TOXIC
    }
    # A key seen in few toxic texts by chance alone has few of them; more texts lift the bar.
    least = max(MIN_TOXIC, 0.002 * n_toxic)
    strong = sorted(((v, k) for k, v in odds.items() if v >= MIN_ODDS and counts[k][0] >= least), reverse=True)
    return {k: v for v, k in strong}


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon, trees and calibration from about ``sample_rows`` labelled training rows at most.

    The sample is the labelled ids of smallest hash share among ``train``; a
    document with several labels is toxic if one says so. Texts are read for
    these rows alone. Every tree is trained, and calibration measured, with
    lexicons and trees from the other half of the sample.
    """
    spark = docs.sparkSession
    marked = labels.select("doc_id", "toxic").filter(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample_rows / max(1, marked.count()))
    picked = marked.filter(hash_share("doc_id", "sample") < share)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Rows that share an id count once, by their smallest text.
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = rows.select((F.xxhash64("doc_id", F.lit("half")) % 2 != 0).alias("half"), "text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bool, bool], Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (half, toxic), of in seen.items():
                n = list(of.values())
                zero = [0] * len(n)
                cols = [[half] * len(n), list(of), n if toxic else zero, zero if toxic else n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["half", "key", "toxic", "clean"])
            seen.clear()

        for piece in slices(batches, 1 << 20):
            for half, text, toxic in zip(*(piece.column(i).to_pylist() for i in range(3))):
                of = seen.setdefault((half, bool(toxic)), Counter())
                of[""] += 1
                of.update({k for w in set((text or "").split()) for k in keys_of(w)})
            if sum(map(len, seen.values())) > 150_000:  # a bounded memory: partial counts go on
                yield from rows()
        yield from rows()

    counted = rows.mapInArrow(count, "half boolean, key string, toxic bigint, clean bigint")
    counted = counted.groupBy("half", "key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    both = counted.groupBy("key").agg(*[
        F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{int(h)}")
        for c in ("toxic", "clean") for h in (False, True)
    ])
    both = both.filter((F.col("toxic0") + F.col("toxic1") >= MIN_TOXIC) | (F.col("key") == ""))
    table = {r["key"]: (r["toxic0"], r["clean0"], r["toxic1"], r["clean1"]) for r in both.collect()}
    totals = table.pop("", (0, 0, 0, 0))
    of_half = lambda t, h: (t[2 * h], t[2 * h + 1])
    halves = [_lexicon({k: of_half(t, h) for k, t in table.items()}, *of_half(totals, h)) for h in (0, 1)]
    whole = _lexicon({k: (t[0] + t[2], t[1] + t[3]) for k, t in table.items()}, totals[0] + totals[2], totals[1] + totals[3])
    sent = spark.sparkContext.broadcast(halves)

    def measured(cols: dict) -> dict:
        memories: tuple[dict, dict] = ({}, {})
        x = [features(t, sent.value[1 - h], memories[h]) for h, t in zip(cols["half"], cols["text"])]
        return {"half": cols["half"], "toxic": cols["toxic"], "x": x}

    found = map_rows(rows, "half boolean, toxic int, x array<double>", measured).collect()
    found.sort(key=lambda r: (r["half"], r["toxic"], r["x"]))
    x = np.array([r["x"] for r in found], dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array([float(r["toxic"] > 0) for r in found])
    half = np.array([r["half"] for r in found], dtype=bool)
    ones = np.ones(len(y))
    margin = np.zeros(len(y))
    for h in (False, True):
        margin[half == h] = boost(x[half != h], y[half != h], ones[half != h]).margin(x[half == h])
    return Model(whole, boost(x, y, ones), isotonic(margin, y))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row, from the text alone.

    Null and empty texts score as a text without words; without labelled rows
    every text gets the same low score; repeated rows are answered row by row.
    Only ``doc_id`` and ``text`` are read.
    """
    sent, memory = docs.sparkSession.sparkContext.broadcast(model), {}

    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "score": sent.value.score(cols["text"], memory).tolist()}

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, score double", run)


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without rows that score ``threshold`` or more, all columns as they are."""
    sent, memory = docs.sparkSession.sparkContext.broadcast(model), {}
    return keep_rows(docs, "text", lambda texts: (sent.value.score(texts, memory) < threshold).tolist())


def held_out() -> Column:
    return crc_mod("doc_id", 3) == 1


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    found = toxicity(docs, fit(docs, labels, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
