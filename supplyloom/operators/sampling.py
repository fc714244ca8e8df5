"""Reproducible random picks: rows are ordered by the MD5 of a seed and the columns that identify them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.operators.windows import first_per_key

# leading hex digits of the hash that form a bucket: at most 16 ** 4 = 65,536 buckets
BUCKET_DIGITS = 4


def random_key(seed: str, key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("#", F.lit(seed), *[F.col(k).cast("string") for k in key]))


def current_period(incoming: DataFrame) -> DataFrame:
    """The period of an import: any of its rows tells it, we take the smallest."""
    return incoming.agg(F.min("period").alias("period"))


def sample_percent(df: DataFrame, percent: int, seed: str, key: Sequence[str]) -> DataFrame:
    """``ceil(count * percent / 100)`` rows in random order of ``key``.

    The hash buckets are counted, which tells the bucket the cut falls into; buckets behind it are dropped
    before the shuffle and rows are ranked within their bucket only. No task sees all rows. What is
    broadcast is the list of bucket counts, at most 65,536 rows whatever the data size.
    """
    hashed = df.withColumn("_hash", random_key(seed, key)).withColumn("_bucket", F.left("_hash", F.lit(BUCKET_DIGITS)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    room = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_bucket",
            (
                F.ceil(F.sum("_n").over(everything) * percent / 100) - F.coalesce(F.sum("_n").over(before), F.lit(0))
            ).alias("_room"),
        )
        .filter(F.col("_room") > 0)
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *key))
    return (
        hashed.join(F.broadcast(room), "_bucket")
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= F.col("_room"))
        .drop("_hash", "_bucket", "_room", "_rank")
    )


def sample_one_per_group(df: DataFrame, group: Sequence[str], seed: str, key: Sequence[str]) -> DataFrame:
    """One random row of every group."""
    return first_per_key(df.withColumn("_hash", random_key(seed, key)), group, [F.col("_hash"), *[F.col(k) for k in key]]).drop("_hash")


def entity_candidates(
    rows: DataFrame, candidates: DataFrame, team: str, entity: str, seed: str, key: Sequence[str]
) -> DataFrame:
    """Candidates that belong to the entity drawn for their team; entities are weighted by their rows."""
    drawn = sample_one_per_group(rows, [team], f"{seed}-entity", key).select(team, entity)
    return candidates.join(drawn, [team, entity], "left_semi")


def sample_via_entity(
    rows: DataFrame, candidates: DataFrame, team: str, entity: str, seed: str, key: Sequence[str]
) -> DataFrame:
    """Draw one entity per team from ``rows``, then one row of that entity from ``candidates``."""
    return sample_one_per_group(entity_candidates(rows, candidates, team, entity, seed, key), [team], seed, key)
