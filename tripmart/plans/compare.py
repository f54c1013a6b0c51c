"""Engine-neutral result projection used by the registered queries.

Results are compared against a SQL oracle, so each registered query renders
types that different engines hand over differently: decimals as doubles,
dates as ``yyyy-MM-dd`` text, string arrays as comma-joined text. Refresh
timestamps (``current_timestamp()``) are dropped: they differ per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, DoubleType

#: Places that ratios are compared at; operators themselves do not round.
RATIO_SCALE = 6
RUN_TIME_COLUMNS = {
    "_ingested_at",
    "_pipeline_refresh_timestamp",
    "_bronze_refresh_timestamp",
    "_silver_refresh_timestamp",
    "_eligibility_refresh_timestamp",
    "silver_refresh_timestamp",
    "eligibility_refresh_timestamp",
    "gold_refresh_timestamp",
}


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        name, dtype = field.name, field.dataType
        c = F.col(f"`{name}`")
        if name in RUN_TIME_COLUMNS:
            continue
        if isinstance(dtype, DecimalType):
            c = F.round(c, RATIO_SCALE).cast("double") if dtype.scale > RATIO_SCALE else c.cast("double")
        elif isinstance(dtype, DoubleType):
            c = F.round(c, RATIO_SCALE)
        elif isinstance(dtype, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(dtype, ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(name))
    return df.select(*cols)
