"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed byte 2- and 3-grams, scaled to length
one. Each language has several centroids, found by spherical k-means over a
bounded sample; a text takes the language of the centroid of highest cosine,
and is rejected when it is much farther from it than held-out texts of that
language, and pieces of them, with about as many n-grams are.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import crc_mod, hash_share, keep_rows, map_rows, read_table

DIM_BITS = 12
DIM = 1 << DIM_BITS
UNKNOWN = "und"
#: About so many training texts in all, but so many of each language at least; centroids of a language.
SAMPLE_ROWS, EACH_ROWS, CENTROIDS, ROUNDS = 2000, 8, 4, 12
#: A text is rejected below this share of a low quantile of the held-out cosines of its language and size.
SLACK, QUANTILE = 0.4, 0.01
#: One sample text in so many is held out for that; sizes are powers of two of n-grams; fewer cosines than LEAST tell nothing.
FOLDS, SIZES, LEAST = 5, DIM_BITS + 1, 20
#: Texts with an n-gram at all: one ASCII letter, or one letter or sign beyond ASCII.
HAS_GRAMS = r"[A-Za-z]|[^\x00-\x7F]"
_LETTER = regex.compile(r"\p{L}")
#: ASCII letters fold, other ASCII characters part n-grams as one blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
GROUP_BYTES, GROUP_ROWS = 1 << 20, 256


def _grams(buf: np.ndarray) -> np.ndarray:
    """Hashed 2- and 3-grams at every place of a buffer; those of two blanks are -1."""
    x = buf.astype(np.uint32)
    two = x[:-1] * np.uint32(257) + x[1:]
    three = two[:-1] * np.uint32(263) + x[2:] + np.uint32(1 << 24)
    out = []
    for g, blank in ((two, (buf[:-1] == 32) & (buf[1:] == 32)), (three, (buf[1:-1] == 32))):
        h = ((g * np.uint32(2654435761)) >> np.uint32(32 - DIM_BITS)).astype(np.int32)
        h[blank] = -1
        out.append(h)
    return out


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Dense counts of hashed n-grams, one row for each whole text."""
    parts = [b" " + (t or "").encode().translate(_FOLD) + b" " for t in texts]
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    sizes = np.array([len(p) for p in parts])
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), sizes)
    counts = np.zeros(len(parts) * DIM, dtype=np.int64)
    for n, grams in enumerate(_grams(buf)):
        at = owner[: len(grams)]
        inside = (grams >= 0) & (at == owner[n + 1 :])
        counts += np.bincount(at[inside] * DIM + grams[inside], minlength=len(counts))
    return counts.reshape(len(parts), DIM)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray  # DIM
    centroids: np.ndarray  # centroids x DIM, length one
    languages: tuple[str, ...]  # of each centroid
    floors: np.ndarray  # centroids x SIZES, cosines below which a text is rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts, dtype=np.float32) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def cosines(self, texts: list[str | None]) -> np.ndarray:
        return self.measured(texts)[0]

    def measured(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cosines to all centroids, and the size class, of each text."""
        cos, sizes = np.zeros((len(texts), len(self.languages)), np.float32), np.zeros(len(texts), np.int64)
        lengths = [len(t or "") for t in texts]
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and stop - start < GROUP_ROWS and (stop == start or held + lengths[stop] <= GROUP_BYTES):
                held += lengths[stop]
                stop += 1
            counts = term_counts(texts[start:stop])
            cos[start:stop], sizes[start:stop] = self.vectors(counts) @ self.centroids.T, _size(counts)
            start = stop
        return cos, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine to its nearest centroid, and whether the text is rejected, for each text."""
        if not texts or not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        cos, sizes = self.measured(texts)
        best = cos.argmax(axis=1)
        top = np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0)
        far = top < self.floors[best, sizes]
        lettered = [bool(t) and _LETTER.search(t) is not None for t in texts]
        langs = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
        return langs, [float(s) if ok else 0.0 for s, ok in zip(top, lettered)], [bool(f) or not ok for f, ok in zip(far, lettered)]


def _size(counts: np.ndarray) -> np.ndarray:
    """Size classes: the power of two below the number of different n-grams."""
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(np.int64)


def _pieces(text: str) -> list[str]:
    """A text and its beginnings of 8, 16, 32, ... characters."""
    return [text[: 8 << i] for i in range(SIZES) if 8 << i < len(text)] + [text]


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, started from the text nearest the mean and then the farthest ones."""
    centres = [x[(x @ x.mean(axis=0)).argmax()]]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.array(centres).T).max(axis=1).argmin()])
    c = np.array(centres)
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(docs: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Centroids of every language from a sample of about ``sample_rows`` texts, about as many of each language.

    Of each language the texts below a share of the id's hash are taken, the
    share following from the language's count; with very many languages each
    still has about ``EACH_ROWS``. A text without n-grams teaches nothing and
    is left out before. Rows that share id and language count once, by their
    smallest text.
    """
    named = docs.filter(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(HAS_GRAMS))
    named = named.select("doc_id", "lang", "text")
    counts = named.groupBy("lang").count().collect()  # one row per language, as the model has
    each = max(EACH_ROWS, sample_rows // max(1, len(counts)))
    shares = [(r["lang"], min(1.0, each / r["count"])) for r in counts]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    picked = named.join(F.broadcast(shares), "lang").filter(hash_share("doc_id", "language") < F.col("share"))
    rows = picked.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def sparse(cols: dict) -> dict:
        """Counts of every text (fold -1 where the text is held out, else 0), and of the pieces of held-out ones (fold 1)."""
        out: dict = {"lang": [], "fold": [], "at": [], "value": []}
        for lang, t in zip(cols["lang"], cols["text"]):
            held = zlib.crc32(t.encode()) % FOLDS == 0
            for fold, piece in [(-1 if held else 0, t)] + [(1, p) for p in _pieces(t) if held]:
                counts = term_counts([piece])[0]
                hot = np.flatnonzero(counts)
                if len(hot):
                    for name, v in zip(out, (lang, fold, hot.astype("<i4").tobytes(), counts[hot].astype("<i4").tobytes())):
                        out[name].append(v)
        return out

    found = map_rows(rows, "lang string, fold int, at binary, value binary", sparse).orderBy("lang", "fold", "at", "value").collect()
    by: dict[tuple, list] = {}
    df = np.zeros(DIM)
    for r in found:
        pair = np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<i4")
        if r["fold"] < 1:
            df[pair[0]] += 1
        by.setdefault((r["lang"], r["fold"]), []).append(pair)
    n = sum(r["fold"] < 1 for r in found)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    blank = Model(idf, np.zeros((0, DIM), np.float32), (), np.zeros((0, SIZES)))

    def dense(lang: str, *folds: int) -> np.ndarray:
        pairs = [p for fold in folds for p in by.get((lang, fold), [])]
        counts = np.zeros((len(pairs), DIM), dtype=np.int64)
        for row, (at, value) in zip(counts, pairs):
            row[at] = value
        return counts

    names = sorted({lang for lang, _ in by})
    if not names:
        return blank
    c, of = _centroids({lang: blank.vectors(dense(lang, -1, 0)) for lang in names})
    floors = _floors({lang: blank.vectors(dense(lang, 0)) for lang in names if (lang, 0) in by}, {lang: dense(lang, 1) for lang in names}, blank)
    return Model(idf, c, tuple(of.tolist()), np.array([floors[lang] for lang in of.tolist()]))


def _centroids(sample: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of all languages, and the language of each."""
    centroids = {lang: _k_means(x, CENTROIDS) for lang, x in sample.items()}
    c, of = np.concatenate(list(centroids.values())), np.repeat(np.array(list(sample)), [len(v) for v in centroids.values()])
    truth = np.repeat(np.array(list(sample)), [len(x) for x in sample.values()])
    near = np.concatenate([(x @ c.T).argmax(axis=1) for x in sample.values()])
    keep = _pure(near, truth, of)
    return c[keep], of[keep]


def _floors(sample: dict[str, np.ndarray], held: dict[str, np.ndarray], blank: Model) -> dict[str, np.ndarray]:
    """Cosines of rejection of each language by size class, from texts that its centroids have not seen.

    A size of a language with too few held-out pieces takes the floor of that
    size over all languages, or else that of the size below (shorter texts
    lie farther off); without any, nothing is rejected.
    """
    seen = {lang: [np.zeros(0)] * SIZES for lang in held}
    if sample:
        c = _centroids(sample)[0]
        for lang in sample:
            if len(held[lang]):
                top, size = (blank.vectors(held[lang]) @ c.T).max(axis=1), _size(held[lang])
                seen[lang] = [top[size == k] for k in range(SIZES)]
    floors = {lang: np.zeros(SIZES) for lang in held}
    for k in range(SIZES):
        pooled = np.concatenate([v[k] for v in seen.values()])
        for lang, v in seen.items():
            known = next((x for x in (v[k], pooled) if len(x) >= LEAST), None)
            floors[lang][k] = SLACK * np.quantile(known, QUANTILE) if known is not None else floors[lang][k - 1] if k else 0.0
    return floors


def _pure(near: np.ndarray, truth: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Centroids most of whose nearest sample texts have their language.

    Wrong labels gather in centroids that lie among another language's texts;
    those go, unless a language has no other.
    """
    right = np.array([(truth[near == j] == of[j]).mean() if (near == j).any() else 0.0 for j in range(len(of))])
    keep = right > 0.5
    for lang in set(of.tolist()):
        own = np.flatnonzero(of == lang)
        if not keep[own].any():
            keep[own[right[own].argmax()]] = True
    return keep


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row, from the text alone.

    A text without letters, null and empty ones too, is ``und`` with score 0
    and rejected; equal cosines go to the language that sorts first; repeated
    rows are answered row by row; without training rows all texts are
    ``und``. Only ``doc_id`` and ``text`` are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(cols: dict) -> dict:
        lang, score, rejected = sent.value.predict(cols["text"])
        return {"doc_id": cols["doc_id"], "lang_pred": lang, "score": score, "rejected": rejected}

    schema = "doc_id bigint, lang_pred string, score double, rejected boolean"
    return map_rows(docs.select("doc_id", "text"), schema, run)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without rejected rows, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, "text", lambda texts: [not r for r in sent.value.predict(texts)[2]])


def held_out() -> Column:
    return crc_mod("doc_id", 4) == 2


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
