"""Row numbers, first rows and duplicate flags without pulling one key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.session import stable

# monotonically_increasing_id keeps the position within a partition in its lower 33 bits
_POSITION_BITS = 33


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first in ``order``.

    Spark keeps only the first row of each key per map task before the shuffle (window group limit), so
    a key holding most of the rows costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, descending: bool = False, unique_order: bool = False
) -> DataFrame:
    """Add ``name``: 0 on the first row of each key, 1 on all others.

    The first order value per key is an aggregate (combined before the shuffle) that is joined back, so a
    hot key is spread over tasks. Rows that tie on key and order are numbered among themselves;
    ``unique_order=True`` says there are none and saves that step.
    """
    position = F.struct(*order)
    best = F.max(position) if descending else F.min(position)
    firsts = df.groupBy(*keys).agg(best.alias("_first")).select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_first")
    if not unique_order:
        tie = Window.partitionBy(*keys, *order).orderBy(F.lit(0))
        df = df.withColumn("_tie", F.row_number().over(tie))
    same_key = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    is_first = position.eqNullSafe(F.col("_first"))
    if not unique_order:
        is_first = is_first & (F.col("_tie") == 1)
    return (
        df.join(firsts, same_key, "left")
        .withColumn(name, F.when(is_first, 0).otherwise(1))
        .drop("_first", "_tie", *[f"_key_{k}" for k in keys])
    )


def mark_once(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_once", **options) -> DataFrame:
    """Add ``name``: 1 on the highest row of each key in ``order``, 0 elsewhere."""
    marked = flag_duplicates(df, keys, order, name, descending=True, **options)
    return marked.withColumn(name, 1 - F.col(name))


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "id") -> DataFrame:
    """Number all rows 1, 2, 3, ... in ``order`` with every task numbering its own range.

    The sorted ranges are materialised once, so that counting and numbering see the same partitions. The
    offsets that are broadcast have one row per partition.
    """
    ranges = stable(df.orderBy(*order)).withColumns(
        {"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1)}
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranges.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_offset")
    )


def number_in_cells(df: DataFrame, order: Sequence[Column], cell: Sequence[tuple[Column, bool]], name: str = "id") -> DataFrame:
    """Number all rows 1, 2, 3, ... in ``order`` without sorting or storing the table as a whole.

    ``cell`` lists columns that lead the order, coarse ones such as a period or a range of ids, each with whether it
    descends (NULL counts as lowest). The rows of each cell are counted, the cells before a cell tell where its numbers begin,
    and every cell is sorted and numbered on its own. Choose cells that are many, but few enough for one task to add up
    their counts. The plan below is computed twice, once for the counts: cheaper than a copy of a wide table.
    """
    names = [f"_cell{i}" for i in range(len(cell))]
    placed = df.withColumns({n: c for n, (c, _) in zip(names, cell, strict=True)})
    in_turn = [F.desc_nulls_last(n) if down else F.asc_nulls_first(n) for n, (_, down) in zip(names, cell, strict=True)]
    before = Window.orderBy(*in_turn).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    keys = [F.col(n).alias(f"_of{n}") for n in names]
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    same = [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names]
    numbered = placed.withColumn("_within", within).join(offsets, same)
    return numbered.withColumn(name, F.col("_offset") + F.col("_within")).drop("_offset", "_within", *names, *[f"_of{n}" for n in names])
