"""Mix sources to target weights: whole documents, repeated where a target asks for more than its source holds.

Every document is taken a whole number of times for sure; the rest of its rate is an inclusion probability, and the cube
method draws the documents that are taken once more. Flight: three documents at a time, the step vector is orthogonal to (1, 1, 1)
and to their sizes, so the expected number of documents and of words stays exactly what it is while at least one of the three
becomes certain. Landing: the few documents still open at the end are rounded together, to the subset whose words (then
documents) are nearest to what is left.

Spark deals the open documents of a source into blocks of bounded size; a block flies until two documents are open. The open
documents of all blocks form the next, far smaller level, until one block per source is left, which lands.

Defined cases: a NULL text has size 0. NULL is a source of its own, after all others; the empty string is another, before all
others. Rows that agree in source, id and text are one unit with as many copies: the copies share the unit's draws, and as they
cannot be told apart, which of them gets one more does not matter. NULL ids count as one id. A source without words has target 0
and nothing of it is taken. An empty table gives no rows. Draws depend on the seed and the rows only, not on how they are
partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.common import staged
from supplyloom.operators.windows import global_row_number

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
BLOCK = 20_000
LANDING = 10
# probabilities this close to 0 or 1 are certain
CERTAIN = 1e-9
COPIES_PER_ROW = 65_536
WORD = "[^\\x20\\x09-\\x0D]+"

UNIT = ["source", "doc_id", "text_hash", "size"]
FLOWN = "source string, doc_id long, text_hash long, size long, p double"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """Distinct (source, id, text) with their size and how many rows they stand for."""
    sized = docs.select(
        "source", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size")
    )
    return sized.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n"))


def source_targets(unit_rows: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source: source_size, target.

    Sources are numbered by code point, NULL last, and weigh ``weights`` in turn. ``share`` of all sizes is dealt out by
    weight; a target stops at ``most`` times its source and the excess goes to the others by weight until none is above.
    A round is one aggregate over the sources, of which the driver sees three numbers.
    """
    if share > most:
        raise ValueError("share must not exceed most: the excess would have nowhere to go")
    sizes = unit_rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    numbered = global_row_number(sizes, [F.asc_nulls_last("source")], "_number")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = staged(
        numbered.select(
            "source", "source_size", F.get(turn, F.pmod(F.col("_number") - 1, F.lit(len(weights))).cast("int")).alias("_weight"),
            (F.col("source_size") * float(most)).alias("_cap"),
        )
    )
    total = weighed.agg(F.sum("source_size")).first()[0]
    level, capped = 0.0, -1
    while total:
        full = F.col("_cap") <= F.col("_weight") * F.lit(level)
        seen = weighed.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("open"),
            F.sum(full.cast("long")).alias("capped"),
        ).first()
        if seen["capped"] == capped or not seen["open"]:
            break
        capped, level = seen["capped"], (share * total - seen["given"]) / seen["open"]
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(level)).alias("target")
    return weighed.select("source", "source_size", target)


def null_vectors(size: np.ndarray) -> np.ndarray:
    """For rows of three sizes a vector orthogonal to (1, 1, 1) and to the sizes; three equal sizes leave a free choice."""
    step = np.stack([size[:, 1] - size[:, 2], size[:, 2] - size[:, 0], size[:, 0] - size[:, 1]], axis=1)
    equal = ~step.any(axis=1)
    step[equal] = (1.0, -1.0, 0.0)
    return step / np.abs(step).max(axis=1, keepdims=True)


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, leave: int = 2) -> np.ndarray:
    """Probabilities after moving them through the null space until at most ``leave`` (2 or more) are neither 0 nor 1.

    Triples move side by side: each round takes one step per triple of open units, which makes one of the three certain.
    """
    p = p.astype(np.float64).copy()
    while True:
        found = np.flatnonzero((p > CERTAIN) & (p < 1 - CERTAIN))
        if len(found) <= max(leave, 2):
            break
        three = found[: len(found) // 3 * 3].reshape(-1, 3)
        u, now = null_vectors(size[three].astype(np.float64)), p[three]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf)).min(axis=1)
            down = np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf)).min(axis=1)
        # either way the mean stays where it is
        far = np.where(rng.random(len(three)) * (up + down) < down, up, -down)
        p[three] = now + far[:, None] * u
        p[p < CERTAIN], p[p > 1 - CERTAIN] = 0.0, 1.0
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last open units (at most ``LANDING``): the subset nearest in words, then in documents."""
    p = p.copy()
    found = np.flatnonzero((p > 0) & (p < 1))
    subsets = np.array(list(product((0, 1), repeat=len(found))), dtype=np.int64).reshape(2 ** len(found), len(found))
    words = np.abs(subsets @ size[found] - p[found] @ size[found])
    documents = np.abs(subsets.sum(axis=1) - p[found].sum())
    p[found] = subsets[np.lexsort((documents, np.round(words, 6)))[0]]
    return p


def _fly(seed: str, level: int):
    def fly(rows: pd.DataFrame) -> pd.DataFrame:
        source, block, blocks = rows["source"].iloc[0], int(rows["block"].iloc[0]), int(rows["blocks"].iloc[0])
        # an order that does not depend on how rows reached the task; large units first, so that small ones are left to land
        rows = rows.sort_values(["size", "order", "doc_id", "text_hash"], ascending=[False, True, True, True])
        rng = np.random.default_rng(xxhash.xxh64_intdigest(f"{seed}:{level}:{source!r}:{block}"))
        size = rows["size"].to_numpy(dtype=np.int64)
        p = flight(rows["p"].to_numpy(), size, rng, LANDING if blocks == 1 else 2)
        out = rows[[*UNIT]].copy()
        out["p"] = landing(p, size) if blocks == 1 else p
        return out

    return fly


def cube_sample(open_units: DataFrame, seed: str = SEED) -> DataFrame:
    """``UNIT`` and ``p``, now 0 or 1, for units with an inclusion probability ``p`` strictly between 0 and 1.

    Each level writes what it decided and hands the open rest on: two units of a block of ``BLOCK``.
    """
    decided, level = [], 0
    while True:
        order = F.xxhash64(F.lit(f"{seed}:{level}"), *UNIT)
        blocks = open_units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
        blocks = blocks.withColumnRenamed("source", "_source")
        dealt = (
            open_units.join(blocks, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("order", order)
            .withColumn("block", F.pmod(F.xxhash64("order"), F.col("blocks")))
        )
        flown = staged(dealt.select(*UNIT, "p", "order", "block", "blocks").groupBy("source", "block").applyInPandas(_fly(seed, level), FLOWN))
        still = (F.col("p") > 0) & (F.col("p") < 1)
        decided.append(flown.filter(~still))
        open_units, level = flown.filter(still), level + 1
        if open_units.isEmpty():
            break
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED
) -> DataFrame:
    """Per unit: source, doc_id, text_hash, size, n (rows it stands for), source_size, target, base (copies of each row) and
    extra (how many of the rows are taken once more)."""
    unit_rows = staged(units(docs))
    targets = staged(source_targets(unit_rows, weights, share, most)).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = unit_rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rated = rated.withColumn("_rate", F.least(rate, F.lit(float(most)))).withColumn("base", F.floor(F.col("_rate") + CERTAIN))
    # n rows of one unit: the whole part of what they ask for together is certain, only the rest is left to chance
    asked = F.greatest(F.col("n") * (F.col("_rate") - F.col("base")), F.lit(0.0))
    rated = rated.withColumn("_asked", asked).withColumn("sure", F.floor(F.col("_asked") + CERTAIN))
    rated = rated.withColumn("p", F.col("_asked") - F.col("sure"))
    by_chance = cube_sample(rated.filter(F.col("p") > CERTAIN).select(*UNIT, "p"), seed)
    drawn = by_chance.filter("p = 1").select(*[F.col(c).alias(f"_{c}") for c in UNIT], F.lit(1).alias("_drawn"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in UNIT]
    extra = (F.col("sure") + F.coalesce("_drawn", F.lit(0))).alias("extra")
    return rated.join(drawn, same, "left").select(*UNIT, "n", "source_size", "target", "base", extra)


def per_row(plan: DataFrame) -> DataFrame:
    """One row for each row of the documents: doc_id, source, size, source_size, target, copies, taken."""
    first = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES_PER_ROW))).alias("_part")
    parts = plan.select("*", first)
    left = F.least(F.lit(COPIES_PER_ROW), F.col("n") - F.col("_part") * COPIES_PER_ROW)
    rows = parts.select("*", F.explode(F.sequence(F.lit(1), left.cast("int"))).alias("_row"))
    number = F.col("_part") * COPIES_PER_ROW + F.col("_row")
    copies = F.col("base") + (number <= F.col("extra")).cast("long")
    rows = rows.withColumn("copies", copies)
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixture(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed documents themselves, each as often as the plan takes it.

    Rows of one unit repeat id, source and text; those that are taken once more are copies of one of them.
    """
    names = ("source", "doc_id", "text_hash", "base", "extra")
    plan = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in names])
    keys = {"source": F.col("source"), "doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64("text")}
    found = docs.join(plan, [value.eqNullSafe(F.col(f"__mix_{name}")) for name, value in keys.items()])

    def times(name: str) -> Column:
        return F.explode(F.sequence(F.lit(1), F.col(f"__mix_{name}").cast("int"))).alias("__mix_copy")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    every = found.filter("__mix_base > 0").select(*columns, times("base"))
    one = found.filter("__mix_extra > 0").groupBy(*[f"__mix_{c}" for c in names]).agg(F.any_value(F.struct(*columns)).alias("__mix_row"))
    more = one.select("__mix_row.*", times("extra"))
    return every.unionByName(more).drop("__mix_copy")
