"""Trip measures: date parts and duration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM_TYPE = "decimal(20,2)"


def date_parts(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> dict:
    """Calendar parts of pickup and dropoff (day of week: 1 = Sunday)."""
    parts = {
        "pickup_date": f"to_date({pickup})",
        "dropoff_date": f"to_date({dropoff})",
        "pickup_year": f"year({pickup})",
        "dropoff_year": f"year({dropoff})",
        "pickup_month": f"month({pickup})",
        "pickup_day": f"dayofmonth({pickup})",
        "pickup_hour": f"hour({pickup})",
        "pickup_day_of_week": f"dayofweek({pickup})",
    }
    return {name: F.expr(sql) for name, sql in parts.items()}


def duration_minutes(start: str, end: str) -> Column:
    """Whole-second difference in minutes, rounded to 2 decimals (double)."""
    return F.expr(f"round((unix_timestamp({end}) - unix_timestamp({start})) / 60, 2)")
