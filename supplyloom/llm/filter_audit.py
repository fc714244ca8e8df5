"""How five quality filters interact: what each removes, in every order they can be applied in.

A document is a cell of a 2 x 2 x 2 x 2 x 2 table: it passes (0) or fails (1) each of the filters A to E. Per part the
cells are counted once, in Spark; the count of every step of every order is then a contraction of that small tensor, with
one selector (pass, fail or all) along each axis. The order of filters never touches a document again.

Defined cases: a NULL text is an empty text; a NULL ``lang`` and an empty one are the same part ''. A document whose id
is NULL is no copy of another and no other is a copy of it. Rows that share id and text are no copies of each other.
A document without label is neither good nor toxic; one with contradicting labels is both. Repeated rows count as often
as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
MARKUP = "[#$%&*|]"
BLANKS = "[\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MEASURES = ("documents", "good", "toxic")
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
STEP_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides, as 0 or 1."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    return {
        "A": (n_words < MIN_WORDS).cast("int"),
        "B": (100 * n_distinct < MIN_DISTINCT_PERCENT * n_words).cast("int"),
        "C": (100 * capitals > MAX_CAPITALS_PERCENT * F.char_length(text)).cast("int"),
        "D": F.regexp_like(text, F.lit(MARKUP)).cast("int"),
    }


def labels_by_id(labels: DataFrame) -> DataFrame:
    """One row per labelled id: ``good`` and ``toxic`` tell whether any of its rows says so."""
    return (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )


def cell_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part`` and cell (``a`` to ``e``), with how many of them are good and how many toxic.

    Copies are found without joining the documents to anything by text: rows are counted per (text, id), then per text
    and label, keeping the smallest id and its count, and only these few rows of a text look at its smallest id at all.
    Each step combines before its shuffle, so a text that makes up a third of the table costs no more than any other.
    """
    text = F.coalesce("text", F.lit(""))
    failures = text_failures(F.col("text"))
    letters = [c.lower() for c in failures]
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).select(
        "id", "part", F.sha2("text", 256).alias("copy"), *[c.alias(name.lower()) for name, c in failures.items()]
    )
    per_id = rows.groupBy("copy", "id", "part", *letters).agg(F.count(F.lit(1)).alias("n"))
    judged = per_id.join(labels_by_id(labels), "id", "left").select(
        "copy", "id", "part", *letters, "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    # the rows of the smallest id of each (text, part, label), and all rows with an id at all
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    cell = ["part", *letters, "good", "toxic"]
    per_copy = judged.groupBy("copy", *cell).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), first.alias("first")
    )
    # a text has one row per part and label here, so these are all that a window over a text ever holds
    least = F.min("first.id").over(Window.partitionBy("copy"))
    passing = F.col("unnamed") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    halves = F.array(
        F.struct(F.lit(0).alias("e"), F.col("passing").alias("n")), F.struct(F.lit(1).alias("e"), (F.col("n") - F.col("passing")).alias("n"))
    )
    return (
        per_copy.withColumn("least", least)
        .withColumn("passing", passing)
        .select(*cell, F.inline(halves))
        .groupBy("part", *letters, "e")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        )
    )


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def selectors(order: list[str], own: np.ndarray, before: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """For every step of every order one selector per axis: ``own`` for the filter of the step, ``before`` for those
    already applied, ``other`` for those to come. Five arrays of shape (steps, 2)."""
    picked = np.empty((len(FILTERS), len(order) * len(FILTERS), 2), dtype=np.int64)
    for i, letters in enumerate(order):
        for step, letter in enumerate(letters):
            for axis, name in enumerate(FILTERS):
                place = letters.index(name)
                picked[axis, i * len(FILTERS) + step] = own if name == letter else before if place < step else other
    return list(picked)


def contract(tensor: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """Counts of every measure at every step: (measures, 2, 2, 2, 2, 2) with five selectors to (measures, steps)."""
    return np.einsum("mabcde,sa,sb,sc,sd,se->ms", tensor, *chosen, optimize=True)


def steps_of_part(cells: pd.DataFrame) -> pd.DataFrame:
    """The 600 steps of one part from its cells, at most 32 rows."""
    tensor = np.zeros((len(MEASURES), 2, 2, 2, 2, 2), dtype=np.int64)
    axes = tuple(cells[c.lower()].to_numpy() for c in FILTERS)
    for m, name in enumerate(MEASURES):
        np.add.at(tensor[m], axes, cells[name].to_numpy())
    order = orders()
    kept = contract(tensor, selectors(order, PASS, PASS, ALL))[0]
    removed = contract(tensor, selectors(order, FAIL, PASS, ALL))
    failing = contract(tensor, selectors(order, FAIL, ALL, ALL))[0]
    unique = contract(tensor, selectors(order, FAIL, PASS, PASS))[0]
    letters = np.array([c for o in order for c in o])
    shapley = {c: int(removed[0][letters == c].sum()) for c in FILTERS}
    return pd.DataFrame(
        {
            "part": cells["part"].iloc[0],
            "filter_order": np.repeat(order, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(order)),
            "kept": kept,
            "removed": removed[0],
            "redundant": failing - removed[0],
            "unique_fails": unique,
            "good_lost": removed[1],
            "toxic_lost": removed[2],
            "shapley": [shapley[c] for c in letters],
        }
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``docs`` has ``doc_id``, ``text`` and ``lang``, ``labels`` has ``doc_id``, ``quality`` and ``toxic``; further columns
    do no harm. A part reaches its task as at most 32 rows of counts, whatever its size; parts are contracted in parallel.
    """
    return cell_counts(docs, labels).groupBy("part").applyInPandas(steps_of_part, STEP_SCHEMA)
