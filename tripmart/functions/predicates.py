"""Three-valued-logic helpers and rule-table to reason-array builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """NULL or only white space."""
    return c.isNull() | (F.length(F.trim(c)) == 0)


def reason_array(rules: Sequence[tuple[str, Column | str]], sort: bool = False) -> Column:
    """Array of the codes whose predicate is true, in rule order (or sorted).

    A predicate evaluating to NULL does not fire, exactly like ``WHEN NULL``.
    The result is never NULL, so ``size`` on it is always defined. Predicates
    given as SQL text become one parsed expression.
    """
    if all(isinstance(pred, str) for _, pred in rules):
        cases = ", ".join(f"CASE WHEN {pred} THEN '{code}' END" for code, pred in rules)
        text = f"filter(array({cases}), x -> x IS NOT NULL)"
        return F.expr(f"array_sort({text})" if sort else text)
    fired = F.filter(
        F.array(*[F.when(pred, F.lit(code)) for code, pred in rules]),
        lambda x: x.isNotNull(),
    )
    return F.array_sort(fired) if sort else fired


def count_true(pred: Column) -> Column:
    """Aggregate: rows where the predicate is true, as BIGINT."""
    return F.count_if(pred).cast("bigint")
