"""Top-level ancestor of every node of a forest, and interval labels that turn "below" into a range."""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.session import stable, staged

ROWS_PER_TASK = 100_000
BLOCK = 10_000


def top_level(nodes: DataFrame) -> DataFrame:
    """(``id``, ``root_id``) for nodes given as (``id``, ``parent_id``); a NULL parent marks a root.

    Every round doubles the distance each unresolved node looks upwards, so a tree of depth d takes log2(d)
    equi joins; the state is checkpointed between rounds. A parent that is not listed counts as a root.
    Nodes that lead into a cycle have no root and get NULL.
    """
    known = nodes.select(F.col("id").alias("up"), F.lit(True).alias("_listed"))
    state = stable(
        nodes.select("id", F.col("parent_id").alias("up"))
        .join(known, "up", "left")
        .select(
            "id",
            F.coalesce("up", "id").alias("up"),
            F.col("_listed").isNull().alias("done"),  # the parent is NULL or not listed
        )
    )
    size, open_nodes = state.agg(F.count(F.lit(1)), F.count_if(~F.col("done"))).first()
    for _ in range(ceil(log2(max(2, size))) + 1):
        if not open_nodes:
            break
        state = stable(_look_up(state))
        open_nodes = state.filter("not done").count()
    return state.select("id", F.when(F.col("done"), F.col("up")).alias("root_id"))


def _look_up(state: DataFrame) -> DataFrame:
    # resolved nodes stay out of the join, so that a root above most nodes is no hot join key
    above = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("done").alias("_done"))
    moved = state.filter("not done").join(above, "up").select("id", F.col("_up").alias("up"), F.col("_done").alias("done"))
    return state.filter("done").unionByName(moved)


def _salted(children: DataFrame, group: str, rows_per_task: int) -> DataFrame:
    """Add ``_before``: the sizes of the siblings in front of each child, in the order of (salt, id).

    Siblings are numbered within a salt, and salts within their parent, so that a parent of any number of children
    is never in one task. ``children``: id, size and the group column.
    """
    counts = children.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_salts"))
    spread = children.join(counts, group).withColumn("_salt", F.pmod(F.xxhash64("id"), F.col("_salts"))).drop("_salts")
    earlier = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = spread.groupBy(group, "_salt").agg(F.sum("size").alias("_sum"))
    offsets = sums.select(group, "_salt", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(group, "_salt").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumn("_inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, [group, "_salt"])
    return placed.withColumn("_before", F.col("_offset") + F.col("_inner")).drop("_salt", "_offset", "_inner")


def interval_labels(nodes: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``id``, ``root_id``, ``depth``, ``size``, ``start``): pre-order numbers of a forest given as (``id``, ``parent_id``).

    The nodes below a node, itself included, are those whose ``start`` lies in [start, start + size). Levels are found from
    the roots down, sizes added from the leaves up, numbers handed down again; each level is stored once, and a round
    only reads the level beside it. Ids are unique. As in ``top_level``, a parent that is not listed counts as root (its
    children are numbered as tops); nodes that lead into a cycle have no root and no label.
    """
    links = staged(nodes.select("id", "parent_id"))
    known = links.select(F.col("id").alias("_up"), F.lit(True).alias("_listed"))
    joined = links.join(known, F.col("parent_id") == F.col("_up"), "left")
    level = staged(joined.filter(F.col("_listed").isNull()).select("id", F.lit(None).cast(links.schema["id"].dataType).alias("parent_id"), F.coalesce("parent_id", "id").alias("root_id")))
    levels = []
    while not level.isEmpty():
        levels.append(level)
        above = level.select(F.col("id").alias("_up"), "root_id")
        level = staged(links.join(above, F.col("parent_id") == F.col("_up")).select("id", "parent_id", "root_id"))
    sized = []
    for level in reversed(levels):
        rows = level.withColumn("size", F.lit(1).cast("long"))
        if sized:
            below = sized[-1].groupBy(F.col("parent_id").alias("id")).agg(F.sum("size").alias("_below"))
            rows = rows.join(below, "id", "left").withColumn("size", F.col("size") + F.coalesce("_below", F.lit(0))).drop("_below")
        sized.append(staged(rows))
    labelled = []
    for depth, rows in enumerate(reversed(sized)):
        if depth:
            above = labelled[-1].select(F.col("id").alias("parent_id"), F.col("start").alias("_start"))
            placed = _salted(rows, "parent_id", rows_per_task).join(above, "parent_id").withColumn("start", F.col("_start") + 1 + F.col("_before"))
        else:
            placed = _salted(rows.withColumn("_forest", F.lit(0)), "_forest", rows_per_task).withColumn("start", F.col("_before"))
        labelled.append(staged(placed.select("id", "root_id", F.lit(depth).alias("depth"), "size", F.col("start").cast("long").alias("start"))))
    if not labelled:
        kind = links.schema["id"].dataType.simpleString()
        return nodes.sparkSession.createDataFrame([], f"id {kind}, root_id {kind}, depth int, size long, start long")
    return reduce(DataFrame.unionByName, labelled)


def join_below(df: DataFrame, labels: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """Rows of ``df`` paired with every node below the one that ``key`` names (``node_id``), itself included.

    The numbers of the forest are cut into blocks; a node belongs to one block, a subtree to as many as it touches, and both
    meet by an equi join on the block. So the nodes of a large subtree come from many keys with at most ``block`` nodes
    each, whoever they stand below.
    """
    own = labels.select(F.col("id").alias("_own"), F.col("start").alias("_from"), (F.col("start") + F.col("size")).alias("_to"))
    touched = F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))).alias("_block")
    ranges = df.join(own, F.col(key) == F.col("_own")).select(*[F.col(c) for c in df.columns], "_from", "_to", touched)
    nodes = labels.select(F.col("id").alias("node_id"), F.col("start").alias("_at"), F.floor(F.col("start") / block).alias("_in"))
    inside = (F.col("_block") == F.col("_in")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    return ranges.join(nodes, inside).drop("_from", "_to", "_block", "_in", "_at")
