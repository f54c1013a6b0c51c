"""Calendar attributes: ISO weekday numbering and US federal holidays by rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed holiday rules (US federal, statutory date, no observed-day shift).
# (name, month, fixed day of month or None, weekday 1=Monday..7=Sunday or
# None, first and last day of month the weekday may fall on)
FEDERAL_HOLIDAY_RULES = (
    ("New Year's Day", 1, 1, None, None),
    ("Martin Luther King Jr. Day", 1, None, 1, (15, 21)),
    ("Washington's Birthday", 2, None, 1, (15, 21)),
    ("Memorial Day", 5, None, 1, (25, 31)),
    ("Juneteenth National Independence Day", 6, 19, None, None),
    ("Independence Day", 7, 4, None, None),
    ("Labor Day", 9, None, 1, (1, 7)),
    ("Columbus Day", 10, None, 1, (8, 14)),
    ("Veterans Day", 11, 11, None, None),
    ("Thanksgiving Day", 11, None, 4, (22, 28)),
    ("Christmas Day", 12, 25, None, None),
)
HOLIDAY_SCOPE = "US Federal"
# ---------------------------------------------------------------------------


def iso_weekday(d: Column) -> Column:
    """Day of week with Monday = 1 ... Sunday = 7."""
    return (F.pmod(F.dayofweek(d) + 5, F.lit(7)) + 1).cast("int")


def holiday_name(d: Column) -> Column:
    """Name of the federal holiday falling on ``d``, else NULL."""
    month, day, weekday = F.month(d), F.dayofmonth(d), iso_weekday(d)
    expr = None
    for name, m, fixed_day, wd, window in FEDERAL_HOLIDAY_RULES:
        if fixed_day is not None:
            cond = (month == m) & (day == fixed_day)
        else:
            cond = (month == m) & (weekday == wd) & day.between(*window)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr
