"""Quality-check sample of an imported period.

1. Teams below ``min_rows`` rows: a percentage of all their rows.
2. Teams at or above it: one order of a randomly drawn customer.
3. Every team: one order of a randomly drawn creator.

Orders requested before are never picked again. Teams pick in the order of their id, customer before
creator, and an order picked by one is gone for the next. Picks go by the hash of a seed in place of a
random number.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.aggregates import teams_by_volume
from supplyloom.operators.joins import not_in
from supplyloom.operators.sampling import entity_candidates, random_key, sample_percent
from supplyloom.operators.windows import first_per_key
from supplyloom.session import stable, staged

CUSTOMER_STEP, CREATOR_STEP = 1, 2


def percent_sample(
    record: DataFrame,
    prior: DataFrame,
    period: str,
    seed: str,
    key: Sequence[str],
    min_rows: int = 500,
    percent: int = 10,
    unique_po: bool = False,
    null_aware: bool = False,
) -> DataFrame:
    """Step 1: rows of small teams. Rows are sampled, so an order may come up twice unless ``unique_po``."""
    small = teams_by_volume(record, period, min_rows).filter(~F.col("is_large")).select("team_id")
    pool = not_in(
        record.filter((F.col("period") == period) & F.col("team_id").isNotNull()).join(small, "team_id", "left_semi"),
        prior,
        "po_number",
        null_aware,
    )
    if unique_po:
        pool = first_per_key(pool, ["po_number"], [F.col(k) for k in key])
    return sample_percent(pool, percent, f"{seed}-percent", key)


def one_pick_per_step(candidates: DataFrame) -> DataFrame:
    """Give each (``team_id``, ``step``) its first order in hash order that no earlier one takes.

    Everyone asks for the first order on their list; an order asked for twice goes to the earlier team and
    step, and the others strike it from their list and ask again. That ends with exactly the picks of going
    through the teams one by one, mostly after one or two rounds, and no task holds all teams.
    ``candidates``: team_id, step, po_number, category_id, _hash.
    """
    lists = stable(
        candidates.groupBy("team_id", "step", "po_number").agg(F.min(F.struct("_hash", "category_id")).alias("_best"))
    )
    struck = None
    while True:
        left = lists if struck is None else lists.join(struck, ["team_id", "step", "po_number"], "left_anti")
        asked = stable(first_per_key(left, ["team_id", "step"], [F.col("_best"), F.col("po_number")]))
        earliest = asked.groupBy("po_number").agg(F.min(F.struct("team_id", "step")).alias("_first"))
        turn = asked.join(earliest, "po_number")
        mine = F.struct("team_id", "step") == F.col("_first")
        lost = turn.filter(~mine).select("team_id", "step", "po_number")
        if lost.isEmpty():
            return turn.select("team_id", "step", "po_number", F.col("_best.category_id").alias("category_id"))
        struck = lost if struck is None else stable(struck.unionByName(lost))


def team_picks(
    record: DataFrame,
    taken: DataFrame,
    period: str,
    seed: str,
    key: Sequence[str],
    min_rows: int = 500,
    null_aware: bool = False,
) -> DataFrame:
    """Steps 2 and 3; ``taken`` lists the orders requested so far."""
    rows = record.filter((F.col("period") == period) & F.col("team_id").isNotNull())
    large = teams_by_volume(record, period, min_rows).filter("is_large").select("team_id")
    free = not_in(rows, taken, "po_number", null_aware)
    steps = []
    for step, entity, pool in (
        (CUSTOMER_STEP, "customer_id", rows.join(large, "team_id", "left_semi")),
        (CREATOR_STEP, "po_created_by", rows),
    ):
        name = f"{seed}-{entity}"
        chosen = entity_candidates(pool, free, "team_id", entity, name, key)
        steps.append(
            chosen.select("team_id", F.lit(step).alias("step"), "po_number", "category_id", random_key(name, key).alias("_hash"))
        )
    return one_pick_per_step(steps[0].unionByName(steps[1]))


def quality_sample(
    record: DataFrame,
    prior: DataFrame,
    period: str,
    seed: str,
    as_of: datetime,
    created_by: int,
    key: Sequence[str],
    min_rows: int = 500,
    percent: int = 10,
    unique_po: bool = False,
    null_aware: bool = False,
) -> DataFrame:
    """New requests of the three steps. ``key`` names the columns that identify a record row.

    The rows of the period are stored once, in the columns that the steps read; every step starts from there.
    """
    needed = dict.fromkeys(["period", "team_id", "po_number", "category_id", "customer_id", "po_created_by", *key])
    record = staged(record.filter((F.col("period") == period) & F.col("team_id").isNotNull()).select(*needed))
    first = percent_sample(record, prior, period, seed, key, min_rows, percent, unique_po, null_aware).select(
        "po_number", "category_id"
    )
    first = stable(first)
    taken = prior.select("po_number").unionByName(first.select("po_number"))
    picks = team_picks(record, taken, period, seed, key, min_rows, null_aware).select("po_number", "category_id")
    return first.unionByName(picks).select(
        "po_number",
        "category_id",
        F.lit(period).alias("period"),
        F.lit("team").alias("q_type"),
        F.lit(1).alias("status_id"),
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("created_at"),
        F.lit(created_by).alias("created_by"),
    )
