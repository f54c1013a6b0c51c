"""Clustered fact layout (SNK2). Layers are published by :mod:`tripmart.sources.commits` (SNK1, SNK3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLUSTER_KEYS = ("pickup_date_key", "pickup_zone_key")
#: The last part of the range key: it splits a busy day and zone over tasks.
TIE_KEY = "source_record_hash"
#: Ranges of one key are numbered by this many bits: 1,024 ranges between its bounds.
RANGE_BITS = 10


def day_number(date_key: Column) -> Column:
    """A number without gaps between months or years for a ``yyyymmdd`` key; the unknown member's key lies below all."""
    return F.floor(date_key / 10000) * 372 + F.floor(date_key % 10000 / 100) * 31 + date_key % 100


def range_id(value: Column, low: Column | int, high: Column | int, bits: int = RANGE_BITS) -> Column:
    """The range of equal width between two bounds that a number falls into; null and lower ones the first, higher ones the last."""
    ranges = 1 << bits
    width = F.greatest(F.lit(high) - F.lit(low) + 1, F.lit(1))
    place = F.floor((value - F.lit(low)) * ranges / width)
    return F.greatest(F.least(F.coalesce(place, F.lit(0)), F.lit(ranges - 1)), F.lit(0)).cast("bigint")


def curve(ids: Sequence[Column], bits: int = RANGE_BITS) -> Column:
    """Place of a cell on the Z curve: the bits of all range ids dealt in turn, the highest first."""
    dealt = [
        F.shiftleft(F.shiftright(one, bit).bitwiseAND(F.lit(1)), bit * len(ids) + len(ids) - 1 - place)
        for place, one in enumerate(ids)
        for bit in range(bits)
    ]
    return reduce(Column.bitwiseOR, dealt)


def clustered(fact: DataFrame, dates: tuple[int, int], zones: tuple[int, int], files: int | None = None) -> DataFrame:
    """Cluster the fact along a Z curve over day and pickup zone before writing.

    ``dates`` and ``zones`` are the least and largest known key of either
    dimension. Every file covers a small rectangle of days and zones, so
    Parquet bounds skip most files for a filter on either key alone. Spark
    draws the boundaries of the files from a sample of places on the curve, so
    busy days and zones get more files; the record hash ends the range key, so
    one busy cell splits as well. Without ``files`` the number is the
    session's shuffle partitions, which AQE merges by size.
    """
    date_key, zone_key = (F.col(k).cast("bigint") for k in CLUSTER_KEYS)
    days = [day_number(F.lit(d)) for d in dates]
    place = curve([range_id(day_number(date_key), *days), range_id(zone_key, *zones)])
    ranged = fact.repartitionByRange(*([files] if files else []), place, F.col(TIE_KEY))
    return ranged.sortWithinPartitions(place, *CLUSTER_KEYS, TIE_KEY)
