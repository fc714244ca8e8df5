"""Exact distinct counts that add up: the ids of a group as bitmaps, which may be stored and merged later.

A count of distinct ids cannot be added to another one, a bitmap can: the counts of a year come from the bitmaps of its months,
those of two runs from both, without reading a record again. Ids are whole numbers; 64 neighbouring ones share a bitmap, which is
one number. So a group costs no more than its ids do, also where they lie far apart, and every task sets the bits of its own
rows in a hash table first. NULL ids do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = ["_kind", "_bucket"]


def id_sets(df: DataFrame, groups: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """One row per group, id column (``_kind``) and bucket of ids, with the bitmap ``_bits`` of the ids that occur."""
    kinds = F.array(*[F.struct(F.lit(i).alias("_kind"), F.col(i).cast("long").alias("_id")) for i in ids])
    each = df.select(*groups, F.inline(kinds)).filter(F.col("_id").isNotNull())
    bit = F.expr("shiftleft(1L, cast(_id & 63 as int))")
    placed = each.select(*groups, "_kind", F.shiftright("_id", 6).alias("_bucket"), bit.alias("_bit"))
    return placed.groupBy(*groups, *PLACES).agg(F.bit_or("_bit").alias("_bits"))


def merge_sets(sets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The same for fewer ``groups`` or for the rows of several runs: bitmaps of a bucket become one."""
    return sets.groupBy(*groups, *PLACES).agg(F.bit_or("_bits").alias("_bits"))


def count_ids(sets: DataFrame, groups: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Distinct ids of every group, one column per id column; 0 where a group has ids of another column only."""
    counted = merge_sets(sets, groups).select(*groups, "_kind", F.bit_count("_bits").alias("_n"))
    return counted.groupBy(*groups).agg(
        *[F.coalesce(F.sum(F.when(F.col("_kind") == i, F.col("_n"))), F.lit(0).cast("long")).alias(i) for i in ids]
    )
