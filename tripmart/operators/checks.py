"""Check reports and expectation sets (SET1, SRT2, SRT3, EX1-EX8, VR1-VR4).

A report is built from one-row statistics frames: each input table is
reduced once by a single aggregate of conditional counts, the one-row
results are combined, and every check becomes one struct of an array that
``inline`` turns into rows. No check re-scans a table.

Predicates and aggregates are SQL expression text, parsed by Spark: the
contract reads like the data rules it encodes and costs one call per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = [
    "validation_group",
    "validation_name",
    "severity",
    "status",
    "exception_record_count",
    "evaluated_record_count",
    "exception_rate_pct",
    "details",
]


@dataclass(frozen=True)
class Check:
    order: int
    group: str
    name: str
    severity: str
    status: str
    exceptions: str
    evaluated: str
    details: str


def stats(df: DataFrame, measures: Sequence[tuple[str, str]]) -> DataFrame:
    """One aggregate pass: ``(name, SQL aggregate)`` pairs to one row.

    Integral counters are returned as BIGINT; other results keep their type.
    """
    return df.agg(*[F.expr(expr).alias(name) for name, expr in measures])


def count_where(
    df: DataFrame, total: str, predicates: dict[str, str], aggregates: dict[str, str] | None = None
) -> DataFrame:
    """One row: all rows as ``total``, for each name the rows its predicate holds for, and other aggregates."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(F.expr(p)).alias(name) for name, p in predicates.items()],
        *[F.expr(a).alias(name) for name, a in (aggregates or {}).items()],
    )


def combine(*frames: DataFrame) -> DataFrame:
    """Side-by-side combination of one-row frames, without a join.

    The frames (distinct column names) are stacked by name, each row NULL in
    the others' columns, and one global aggregate keeps the single non-NULL
    value per column: a handful of rows, reduced map-side.
    """
    names = [name for f in frames for name in f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.any_value(F.col(n), True).alias(n) for n in names])


def check_report(one_row: DataFrame, checks: Sequence[Check], order_by: str = "order") -> DataFrame:
    """Rows of a check report from one statistics row.

    ``order_by='order'`` sorts by each check's numeric order; ``'severity'``
    sorts by severity rank, then status rank, then group and name.
    """
    structs = [
        F.struct(
            F.lit(c.order).alias("validation_order"),
            F.lit(c.group).alias("validation_group"),
            F.lit(c.name).alias("validation_name"),
            F.lit(c.severity).alias("severity"),
            F.expr(c.status).alias("status"),
            F.expr(c.exceptions).cast("bigint").alias("exception_record_count"),
            F.expr(c.evaluated).cast("bigint").alias("evaluated_record_count"),
            F.expr(c.details).cast("string").alias("details"),
        )
        for c in checks
    ]
    rows = one_row.select(F.inline(F.array(*structs)))
    exc, ev = F.col("exception_record_count"), F.col("evaluated_record_count")
    rate = F.round(
        F.when(ev == 0, F.lit(0.0)).otherwise(exc.cast("double") * 100.0 / ev.cast("double")), 6
    )
    report = rows.withColumn("exception_rate_pct", rate)
    if order_by == "severity":
        report = report.orderBy(
            F.expr("CASE severity WHEN 'BLOCKER' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END"),
            F.expr("CASE status WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 3 ELSE 4 END"),
            "validation_group",
            "validation_name",
        )
    else:
        report = report.orderBy("validation_order")
    return report.select(*REPORT_COLUMNS)


# ---------------------------------------------------------------------------
# Expectations: named SQL predicates over a dataset.


def expectation_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``(expectation, passed_records, failed_records)`` in one aggregate pass.

    A predicate that evaluates to NULL counts as failed.
    """
    total = F.count(F.lit(1))
    aggs = [total.alias("_rows")] + [
        F.count_if(F.coalesce(F.expr(pred), F.lit(False))).alias(f"_p{i}")
        for i, pred in enumerate(rules.values())
    ]
    one = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(f"_p{i}").cast("bigint").alias("passed_records"),
            (F.col("_rows") - F.col(f"_p{i}")).cast("bigint").alias("failed_records"),
        )
        for i, name in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*structs)))


class ExpectationError(ValueError):
    pass


def enforce(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Fail the run when any row breaks a rule (one aggregate action); else return ``df``."""
    failed = {r["expectation"]: r["failed_records"] for r in expectation_report(df, rules).collect()}
    if any(failed.values()):
        raise ExpectationError(f"expectations failed: {({k: v for k, v in failed.items() if v})}")
    return df
