"""Inline rows with a DDL schema (SRC5).

Rows are generated by ``inline(array(struct(...)))`` over a one-row range, a
plan whose size Spark knows, so joins against these small tables can be
broadcast by the planner's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string


def inline_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    schema = _parse_datatype_string(ddl)
    fields = schema.fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
