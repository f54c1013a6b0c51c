import random
import re
from collections import Counter

from odd_texts import ODD
from tripmart.llm import ledger

R = random.Random(2)


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


TEXTS = ODD + ["\n".join(" ".join(R.choice(["a", "é", "|", "#x", "b b", "漢字"]) for _ in range(R.randint(0, 9))) for _ in range(R.randint(1, 30))) for _ in range(80)]


def test_measures_match_the_contract(docs_of):
    for r in ledger.ledger(docs_of(TEXTS, extra=True)).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == plain(TEXTS[r["doc_id"]])


def test_policies_and_ablation_agree_with_single_rules(docs_of):
    book = ledger.ledger(docs_of(TEXTS)).cache()
    rows = book.collect()
    base = book.select(ledger.passes("base").alias("p"), "n_words", "n_repeat_words").collect()
    assert all(r["p"] == (not (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])) for r in base)
    for policy in ledger.POLICIES:
        mask = ledger.policy_mask(policy)
        found = {r["rule"]: r for r in ledger.ablation(book, policy).collect()}
        assert set(found) == set(ledger.POLICIES[policy])
        for i, rule in enumerate(ledger.RULES):
            if rule.name in found:
                bits = [r["failures"] & mask for r in rows]
                f = found[rule.name]
                assert f["failed"] == sum(b >> i & 1 for b in bits)
                assert f["failed_alone"] == sum(b == 1 << i for b in bits)
                assert f["kept_without"] == sum(b in (0, 1 << i) for b in bits)


def test_only_rule_names_a_rule_failed_alone(docs_of):
    for policy in ledger.POLICIES:
        mask = ledger.policy_mask(policy)
        alone = {1 << i: r.name for i, r in enumerate(ledger.RULES) if mask >> i & 1}
        for r in ledger.ledger(docs_of(TEXTS)).withColumn("rule", ledger.only_rule(policy)).collect():
            assert r["rule"] == alone.get(r["failures"] & mask)


def test_empty(docs_of):
    assert ledger.ledger(docs_of([])).count() == 0
