"""Quality rules as a bitmask ledger.

Each document is measured once and every rule is evaluated once; the ledger
keeps the measurements and one failure bit per rule. Policies are versioned
sets of rules applied to the stored bits, and ablations are bitwise
aggregates over the ledger, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, read_table
from tripmart.operators.lookup import materialize

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_bullet_lines")
SCHEMA = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
#: Word characters that count as letters: ASCII letters and everything beyond ASCII.
_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128))
_BULLETS = (b"-", b"*", b"\xe2\x80\xa2")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurements


#: The place of a rule is its bit; rules are appended, never moved.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("too_many_words", "n_words > 1000000"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "5 * n_dup_lines > 2 * n_lines"),
    Rule("few_letter_words", "10 * n_letter_words < 7 * n_words"),
    Rule("bullet_lines", "n_lines > 2 AND 10 * n_bullet_lines > 9 * n_lines"),
)
#: Versioned policies: the rules each applies.
POLICIES = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "too_many_words", "word_length", "symbols"),
    "v2": tuple(r.name for r in RULES),
}


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    buf = np.frombuffer(raw, dtype=np.uint8)
    blank = (buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D))
    chars = int(np.count_nonzero(((buf & 0xC0) != 0x80) & ~blank))
    symbols = sum(raw.count(bytes([s])) for s in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    bullets = sum(line.lstrip().startswith(_BULLETS) for line in lines)
    letters = n - sum(1 for w in words if not w.translate(None, _LETTER))
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), _repeated(words), letters, bullets


def _repeated(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    size = len(number)
    _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
    _, window, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = counts[window] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + n] |= again
    return int(covered.sum())


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = [f"(CASE WHEN {r.fails} THEN {1 << i}L ELSE 0L END)" for i, r in enumerate(rules)]
    return F.expr(" | ".join(bits))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``failures``, a bit for each failed rule.

    Null and empty texts have no words and fail ``too_few_words``; repeated
    rows are measured row by row; an empty table gives an empty ledger. Only
    ``doc_id`` and ``text`` are read.
    """

    def run(cols: dict) -> dict:
        rows = list(zip(*map(measure, cols["text"]))) or [()] * len(MEASURES)
        return {"doc_id": cols["doc_id"]} | dict(zip(MEASURES, rows))

    return map_rows(docs.select("doc_id", "text"), SCHEMA, run).withColumn("failures", failure_bits(rules))


def policy_mask(policy: str | tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    at = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << at[n] for n in names)


def passes(policy: str | tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy_mask(policy, rules))) == 0


def ablation(book: DataFrame, policy: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    Rows are first counted by their bits under the policy, at most two to the
    number of rules, so the per-rule sums read that small table.
    """
    mask = policy_mask(policy, rules)
    counted = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).count()
    named = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
        for i, r in enumerate(rules) if mask >> i & 1
    ])
    rows = counted.select("bits", "count", F.explode(named).alias("r")).select("bits", "count", "r.*")
    total: Callable[[Column], Column] = lambda when: F.coalesce(F.sum(F.when(when, F.col("count"))), F.lit(0))
    return rows.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without"),
    )


def only_rule(policy: str | tuple[str, ...] = "v2", rules: tuple[Rule, ...] = RULES) -> Column:
    """The one rule of a policy that a document fails; null if it fails none or several."""
    mask = policy_mask(policy, rules)
    bits = F.col("failures").bitwiseAND(F.lit(mask))
    return F.coalesce(*[F.when(bits == 1 << i, r.name) for i, r in enumerate(rules) if mask >> i & 1])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all ``documents``, written once, with the verdict of every policy and the ablation of ``v2``.

    A document that fails one rule of ``v2`` alone names it (``only_rule``)
    with the number of documents that the policy would keep besides if it lacked
    that rule (``n_rescued``); other documents have no such rule and 0.
    """
    book = materialize(ledger(read_table(spark, sf_dir, "documents")))
    alone = ablation(book).select(F.col("rule").alias("only_rule"), "failed_alone")
    rows = book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes("v2").alias("kept"), "failures",
        passes("v1").alias("kept_v1"), only_rule().alias("only_rule"),
    )
    rescued = F.coalesce("failed_alone", F.lit(0).cast("bigint")).alias("n_rescued")
    return rows.join(F.broadcast(alone), "only_rule", "left").select(*rows.columns, rescued)  # one row a rule


_BLANK = r"\x20\x09-\x0D"
OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, doc_id, t, regexp_extract_all(t, '[^{_BLANK}]+') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_BLANK}]')) AS lines FROM d),
g AS (SELECT row, i, words[i:i + 2] AS gram FROM w, unnest(range(1, len(words) - 1)) AS u(i)),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY row),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
  len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letters,
  len(list_filter(lines, lambda x: regexp_matches(x, '^[{_BLANK}]*[-*•]'))) AS n_bullets
  FROM w LEFT JOIN covered ON covered.row = w.row),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN n_words > 1000000 THEN 4 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 8 ELSE 0 END
  + CASE WHEN 10 * n_symbols > n_words THEN 16 ELSE 0 END + CASE WHEN 5 * n_dup_lines > 2 * n_lines THEN 32 ELSE 0 END
  + CASE WHEN 10 * n_letters < 7 * n_words THEN 64 ELSE 0 END
  + CASE WHEN n_lines > 2 AND 10 * n_bullets > 9 * n_lines THEN 128 ELSE 0 END AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, bits = 0 AS kept,
  CAST(bits AS BIGINT) AS failures, bits & 31 = 0 AS kept_v1,
  CASE bits {" ".join(f"WHEN {1 << i} THEN '{r.name}'" for i, r in enumerate(RULES))} END AS only_rule,
  CASE WHEN bits IN ({", ".join(str(1 << i) for i in range(len(RULES)))}) THEN count(*) OVER (PARTITION BY bits)
  ELSE 0 END AS n_rescued FROM f
"""
