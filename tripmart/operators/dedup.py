"""Duplicate detection without a window over a possibly hot key (WN1, WN2, DUP1-3).

A row-level window ``PARTITION BY record_hash`` sends a whole duplicate group
to one task; one hash holding a third of all rows would then land in a
single task. Instead:

1. A hash aggregate on the binary form of the hash counts each group and keeps
   its smallest row identity, a number: a hot key collapses to one row per map
   task before the shuffle, and nothing is sorted.
2. Only groups with more than one row are kept, materialised and joined back:
   all by broadcast when their counted size allows, else the few hot groups
   by broadcast and the others by a shuffle that hot rows stay out of.
3. The canonical member of a group is the row with the smallest identity;
   every other member is a duplicate. Rows in a group are equal on every
   hashed column, so the choice does not change any value downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import BROADCAST_BYTES, join_lookup, materialize, row_bytes

DUP_COUNT = "_duplicate_record_count"
DUP_FIRST = "_duplicate_first_row_id"
GROUP = "_duplicate_group"
#: Rows from which a group counts as hot: there are at most as many such groups as table rows over this.
HOT_ROWS = 1_000_000


def duplicate_groups(df: DataFrame, key: str = "_record_hash", row_id: str = "_source_row_id") -> DataFrame:
    """Groups with more than one row: ``(binary hash, count, first row id)``, materialised."""
    return materialize(duplicate_groups_by(df, (), key, row_id))


def duplicate_groups_by(
    df: DataFrame, by: tuple[str, ...], key: str = "_record_hash", row_id: str = "_source_row_id"
) -> DataFrame:
    """Groups with more than one row, with the columns ``by`` that are alike in all rows of a group."""
    return (
        df.groupBy(F.unhex(key).alias(GROUP), *by)
        .agg(F.count(F.lit(1)).alias(DUP_COUNT), F.min(row_id).alias(DUP_FIRST))
        .where(F.col(DUP_COUNT) > 1)
    )


def flag_duplicates(
    df: DataFrame,
    groups: DataFrame,
    key: str = "_record_hash",
    row_id: str = "_source_row_id",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keep-first policy: group size, group flag and duplicate flag per row."""
    marked = df.withColumn(GROUP, F.unhex(key))
    if groups.count() * row_bytes(groups) <= max_bytes:
        joined = marked.join(F.broadcast(groups), GROUP, "left")
    else:
        joined = _join_large(marked, groups, row_id, hot_rows)
    return joined.withColumns(
        {
            DUP_COUNT: F.coalesce(F.col(DUP_COUNT), F.lit(1)).cast("bigint"),
            "_is_duplicate_group": F.coalesce(F.col(DUP_COUNT) > 1, F.lit(False)),
            "_is_duplicate_record": F.coalesce(F.col(row_id) != F.col(DUP_FIRST), F.lit(False)),
        }
    ).drop(DUP_FIRST, GROUP)


def _join_large(marked: DataFrame, groups: DataFrame, row_id: str, hot_rows: int) -> DataFrame:
    """Hot groups by broadcast; their rows then take a key of their own, so no shuffled key is hot."""
    hot = groups.filter(F.col(DUP_COUNT) >= hot_rows).select(
        GROUP, F.col(DUP_COUNT).alias("_hot_count"), F.col(DUP_FIRST).alias("_hot_first")
    )
    rest = groups.filter(F.col(DUP_COUNT) < hot_rows).withColumnRenamed(GROUP, "_rest_key")
    spread = F.when(F.col("_hot_count").isNull(), F.col(GROUP)).otherwise(F.col(row_id).cast("string").cast("binary"))
    joined = (
        marked.join(F.broadcast(hot), GROUP, "left")
        .withColumn("_spread", spread)
        .join(rest, F.col("_spread") == F.col("_rest_key"), "left")
    )
    return joined.withColumns(
        {
            DUP_COUNT: F.coalesce("_hot_count", DUP_COUNT),
            DUP_FIRST: F.coalesce("_hot_first", DUP_FIRST),
        }
    ).drop("_hot_count", "_hot_first", "_spread", "_rest_key")


def number_duplicates(
    flagged: DataFrame,
    key: str = "_record_hash",
    row_id: str = "_source_row_id",
    salt_buckets: int = 64,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """Occurrence number 1..n inside each duplicate group (1 = canonical).

    Only members of duplicate groups are ranked, from one written copy. Each
    group is cut into cells by a hash of the row identity (the canonical row
    gets its own first cell): at least ``salt_buckets`` cells, and more for a
    large group (its known size over ``cell_rows``), so a cell stays near
    ``cell_rows`` rows however hot the key. Rows are ranked inside their cell
    and shifted by the size of the preceding cells, so no task ever holds a
    whole group.
    """
    singles = flagged.where(~F.col("_is_duplicate_group")).withColumn(
        "_duplicate_occurrence_number", F.lit(1)
    )
    members = materialize(flagged.where(F.col("_is_duplicate_group"))).withColumn(
        "_salt",
        F.when(~F.col("_is_duplicate_record"), F.lit(-1)).otherwise(
            F.pmod(
                F.xxhash64(F.col(row_id)),
                F.greatest(F.lit(salt_buckets).cast("bigint"), F.ceil(F.col(DUP_COUNT) / F.lit(cell_rows))),
            )
        ),
    )
    cells = members.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_cell_rows"))
    by_key = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        key, "_salt", F.coalesce(F.sum("_cell_rows").over(by_key), F.lit(0)).alias("_offset")
    )
    ranked = join_lookup(members, offsets, [key, "_salt"], "inner").withColumn(
        "_duplicate_occurrence_number",
        (
            F.col("_offset")
            + F.row_number().over(Window.partitionBy(key, "_salt").orderBy(row_id))
        ).cast("int"),
    )
    return singles.unionByName(ranked.drop("_salt", "_offset"))
