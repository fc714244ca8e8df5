"""Interval labels against walking up from every node."""

import random

from pyspark.sql import functions as F

from supplyloom.operators import hierarchy
from supplyloom.operators.joins import join_top_level


def forest(rng, n):
    """Parents by id; a third of all nodes hang below one root, some lead into cycles or to unknown parents."""
    parent = {0: None, 1: None, 2: 10**6}
    for i in range(3, n):
        parent[i] = 0 if rng.random() < 0.34 else rng.choice([None, *range(max(0, i - 30), i)]) if rng.random() < 0.98 else i - 1
    for a, b in ((n, n + 1), (n + 1, n), (n + 2, n), (n + 3, n + 3)):
        parent[a] = b
    return parent


def ancestors(parent, node):
    """The nodes above, itself included; None in a cycle."""
    seen = []
    while node in parent:
        if node in seen:
            return None
        seen.append(node)
        node = parent[node]
    return seen


def frame(spark, parent):
    return spark.createDataFrame([(i, p, "x") for i, p in parent.items()], "id long, parent_id long, size string")


def test_labels_and_pairs_equal_walking_up(spark):
    parent = forest(random.Random(1), 400)
    nodes = frame(spark, parent)
    above = {n: a for n in parent if (a := ancestors(parent, n)) is not None}
    below = {n: {m for m, a in above.items() if n in a} for n in above}
    labels = hierarchy.interval_labels(nodes, rows_per_task=16)
    rows = {r.id: r for r in labels.collect()}
    assert set(rows) == set(above) and len({r.start for r in rows.values()}) == len(rows)
    for n, r in rows.items():
        assert (r.root_id, r.depth, r["size"]) == (parent[above[n][-1]] or above[n][-1], len(above[n]) - 1, len(below[n]))
        assert {m for m, o in rows.items() if r.start <= o.start < r.start + r["size"]} == below[n]
    asked = spark.createDataFrame([(n, "t") for n in (0, 1, 7, 30, 399, 400, -5, None)], "key long, start string")
    for block in (7, 1000):
        got = hierarchy.join_below(asked, labels, "key", block)
        assert got.columns == ["key", "start", "node_id"]
        assert sorted((r.key, r.node_id) for r in got.collect()) == sorted((n, m) for n in (0, 1, 7, 30, 399) for m in below[n])


def test_below_roots_equals_the_join_on_the_root(spark):
    nodes = frame(spark, forest(random.Random(5), 300))
    tops = hierarchy.top_level(nodes)
    labels = hierarchy.interval_labels(nodes)
    roots = labels.filter("depth = 0 AND root_id = id").select(F.col("id").alias("owner"))
    pairs = [sorted((r.owner, r.node_id) for r in df.collect()) for df in (hierarchy.join_below(roots, labels, "owner", 20), join_top_level(roots, tops, "owner"))]
    assert pairs[0] == pairs[1]


def test_a_block_bounds_the_rows_of_a_key(spark):
    nodes = spark.range(5000).select("id", F.when(F.col("id") > 0, F.lit(0)).cast("long").alias("parent_id"))
    labels = hierarchy.interval_labels(nodes, rows_per_task=500)
    hot = labels.groupBy(F.floor(F.col("start") / 100)).count().agg(F.max("count")).first()[0]
    assert hot == 100 and labels.filter("id = 0").first()["size"] == 5000
    assert hierarchy.join_below(nodes.filter("id = 0").select("id"), labels, "id", 100).count() == 5000


def test_empty_forest(spark):
    labels = hierarchy.interval_labels(spark.createDataFrame([], "id long, parent_id long"))
    assert labels.columns == ["id", "root_id", "depth", "size", "start"] and labels.count() == 0
