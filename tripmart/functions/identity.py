"""Record identity: a SHA-256 over a fixed, ordered column list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "<NULL>"
SEPARATOR = "||"


def record_hash(columns: Sequence[str]) -> Column:
    """``sha2(c1 || '||' || c2 ..., 256)`` with NULL rendered as ``<NULL>``.

    Column order is part of the identity. Values are rendered by Spark's
    string cast, so decimals keep their scale and timestamps print in the
    session time zone.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
