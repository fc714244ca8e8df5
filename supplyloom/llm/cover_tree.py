"""Exact top-k inner product search with cover trees over queries and data.

Vectors are dealt to blocks of bounded size around a few pivots (the top level of the tree, a farthest-first net of
a bounded sample); a crowded pivot gets several blocks. Each block of data and each block of queries is packed into
one row with its own cover tree. For a node with center c and covering radius r, and a query node (q, s), no inner product exceeds
``q.c + |q| r + |c| s + r s``. First every query block searches the data block with the largest bound, which gives
each query its worst kth score so far; then only block pairs whose bound reaches the worst score of the query block are
joined, and inside a pair the two trees are descended together under the same rule. Query blocks meet data
blocks as summaries; vectors move only for pairs that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.llm.common import staged

PIVOTS, COARSE = 32, 8  # pivots of the data; the first of them group the queries
SAMPLE = 2_048
BLOCK = 2_048
LEAF = 64
EXACT = float(1 << 53)


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v``: components as floor(scale * x); vectors that are NULL or hold NULL or non-finite values go, and so do NULL ids."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: F.floor(scale * x.cast("double"))).alias("v")
    )


def padded(arrays: list, width: int) -> np.ndarray:
    """Rows of integers; a shorter vector counts as filled up with zeros."""
    out = np.zeros((len(arrays), width), dtype=np.int64)
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out


def net(points: np.ndarray, most: int, radius: float = 0.0) -> list[int]:
    """Farthest-first centers, until there are ``most`` or every point is within ``radius`` of one."""
    centers = [0]
    away = ((points - points[0]) ** 2).sum(axis=1)
    while len(centers) < min(most, len(points)):
        far = int(away.argmax())
        if away[far] <= radius * radius:
            break
        centers.append(far)
        away = np.minimum(away, ((points - points[far]) ** 2).sum(axis=1))
    return centers


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and nodes (start, end, center, radius, first child, children) over that order.

    A child covers with half the radius of its parent and its center is farther than that from its sisters'. A node becomes
    a leaf when it is small, has radius zero, or would fall apart into about as many children as points.
    """
    pts = points.astype(np.float64)
    order = np.arange(len(pts))
    nodes: list[list[float]] = []

    def radius_of(start: int, end: int, center: int) -> float:
        return float(np.sqrt(((pts[order[start:end]] - pts[center]) ** 2).sum(axis=1).max()))

    nodes.append([0, len(pts), 0, radius_of(0, len(pts), 0), -1, 0])
    todo = [0]
    while todo:
        at = todo.pop()
        start, end, center, radius = int(nodes[at][0]), int(nodes[at][1]), int(nodes[at][2]), nodes[at][3]
        if end - start <= LEAF or radius == 0:
            continue
        own = order[start:end]
        own = np.concatenate([[center], own[own != center]])
        local = net(pts[own], (end - start) // 4 + 1, radius / 2)
        if len(local) > (end - start) // 4 or len(local) == 1:
            continue
        gaps = np.stack([((pts[own] - pts[own[c]]) ** 2).sum(axis=1) for c in local])
        nearest = gaps.argmin(axis=0)
        order[start:end] = own[np.argsort(nearest, kind="stable")]
        nodes[at][4], nodes[at][5] = len(nodes), len(local)
        begin = start
        for k, c in enumerate(local):
            size = int((nearest == k).sum())
            child = int(own[c])
            nodes.append([begin, begin + size, child, radius_of(begin, begin + size, child), -1, 0])
            todo.append(len(nodes) - 1)
            begin += size
    placed = np.empty(len(pts), dtype=np.int64)
    placed[order] = np.arange(len(pts))
    table = np.array(nodes, dtype=np.float64)
    table[:, 2] = placed[table[:, 2].astype(int)]
    return order, table


class Block:
    """Vectors in tree order with their ids and nodes."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, nodes: np.ndarray):
        self.ids, self.points, self.nodes = ids, points, nodes
        self.real = points.astype(np.float64)
        self.norms = np.sqrt((self.real**2).sum(axis=1))
        self.repeats = len(np.unique(ids)) < len(ids)

    @classmethod
    def unpack(cls, row, prefix: str) -> Block:
        ids = np.frombuffer(getattr(row, prefix + "ids"), dtype=np.int64)
        points = np.frombuffer(getattr(row, prefix + "points"), dtype=np.int64).reshape(len(ids), -1)
        return cls(ids, points, np.frombuffer(getattr(row, prefix + "nodes"), dtype=np.float64).reshape(-1, 6))


class Best:
    """The k best (score, id) of each query of a block, each id once with its best score; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        self.worst = np.full(n, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, i, s = np.concatenate([self.query, query]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((-s, i, q))
        q, i, s = q[order], i[order], s[order]
        again = np.zeros(len(q), dtype=bool)
        again[1:] = (q[1:] == q[:-1]) & (i[1:] == i[:-1])
        q, i, s = q[~again], i[~again], s[~again]
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        self.query, self.ids, self.scores = q[keep], i[keep], s[keep]
        last = np.arange(len(q)) - first == self.k - 1
        self.worst[q[last]] = np.maximum(self.worst[q[last]], s[last])


def search(queries: Block, data: Block, k: int, worst: np.ndarray | None = None) -> Best:
    """Descend both trees together; a node pair goes if its bound is below the worst kth score of all its queries."""
    best = Best(len(queries.ids), k)
    if worst is not None:
        best.worst = worst.copy()
    exact = queries.norms.max(initial=0) * data.norms.max(initial=0) < EXACT

    def bound(a: np.ndarray, b: np.ndarray) -> float:
        q, c = int(a[2]), int(b[2])
        value = queries.real[q] @ data.real[c] + queries.norms[q] * b[3] + data.norms[c] * a[3] + a[3] * b[3]
        return float(value + 1e-9 * abs(value) + 1e-6)

    def leaves(a: np.ndarray, b: np.ndarray) -> None:
        q, d = slice(int(a[0]), int(a[1])), slice(int(b[0]), int(b[1]))
        scores = queries.real[q] @ data.real[d].T if exact else queries.points[q] @ data.points[d].T
        scores = scores.astype(np.float64)
        scores[queries.ids[q][:, None] == data.ids[d][None, :]] = -np.inf
        n = scores.shape[1]
        reach = best.worst[q]
        if n > k and not data.repeats:  # of repeated ids the k largest scores may be fewer than k ids
            reach = np.maximum(reach, np.partition(scores, n - k, axis=1)[:, n - k])
        rows, cols = np.nonzero((scores >= reach[:, None]) & (scores > -np.inf))
        if len(rows):
            rows, cols = rows + int(a[0]), cols + int(b[0])
            exact_scores = (queries.points[rows] * data.points[cols]).sum(axis=1)
            best.add(rows, data.ids[cols], exact_scores)

    todo = [(bound(queries.nodes[0], data.nodes[0]), 0, 0)]
    while todo:
        high, i, j = todo.pop()
        a, b = queries.nodes[i], data.nodes[j]
        if high < best.worst[int(a[0]) : int(a[1])].min():
            continue
        if a[4] < 0 and b[4] < 0:
            leaves(a, b)
            continue
        if b[4] < 0 or (a[4] >= 0 and a[3] > b[3]):
            pairs = [(i2, j) for i2 in range(int(a[4]), int(a[4] + a[5]))]
        else:
            pairs = [(i, j2) for j2 in range(int(b[4]), int(b[4] + b[5]))]
        todo += sorted((bound(queries.nodes[x], data.nodes[y]), x, y) for x, y in pairs)  # the best comes off first
    return best


PACKED = "block long, center array<double>, radius double, ids binary, points binary, nodes binary"


def blocks(vectors: DataFrame, pivots: np.ndarray, width: int, size: int) -> DataFrame:
    """One row for each block of about ``size`` vectors, numbered from 0."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(pivots)  # bounded: PIVOTS rows

    @F.pandas_udf("int")
    def nearest(batch: pd.Series) -> pd.Series:
        centers = shared.value.astype(np.float64)
        points = padded(list(batch), width).astype(np.float64)
        gaps = (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)[None, :]
        return pd.Series(gaps.argmin(axis=1).astype(np.int32))

    near = staged(vectors.withColumn("pivot", nearest("v")))
    counts = near.groupBy("pivot").count().collect()  # at most PIVOTS rows
    parts = {r.pivot: -(-r["count"] // size) for r in counts}
    first, total = {}, 0
    for p in sorted(parts):
        first[p], total = total, total + parts[p]
    if not total:
        return spark.createDataFrame([], PACKED)
    start = F.element_at(F.array(*(F.lit(first.get(p, 0)) for p in range(len(pivots)))), F.col("pivot") + 1)
    share = F.element_at(F.array(*(F.lit(parts.get(p, 1)) for p in range(len(pivots)))), F.col("pivot") + 1)
    dealt = near.withColumn("block", (start + F.pmod(F.xxhash64("vec_id"), share)).cast("long"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        points, ids = padded(list(rows.v), width), rows.vec_id.to_numpy(np.int64)
        order, nodes = build_tree(points)
        root = points[order][int(nodes[0][2])]
        return pd.DataFrame(
            {
                "block": [int(key[0])],
                "center": [root.astype(np.float64).tolist()],
                "radius": [float(nodes[0][3])],
                "ids": [ids[order].tobytes()],
                "points": [points[order].tobytes()],
                "nodes": [nodes.tobytes()],
            }
        )

    return dealt.select("block", "vec_id", "v").groupBy("block").applyInPandas(pack, PACKED)


FOUND = "query_block long, worst binary, query_id long, vec_id long, score long"


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of every pair (columns q_* and d_*, and ``worst`` where known)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                queries, data = Block.unpack(row, "q_"), Block.unpack(row, "d_")
                worst = np.frombuffer(row.worst, dtype=np.float64) if row.worst is not None else None
                best = search(queries, data, k, worst)
                yield pd.DataFrame(
                    {"query_block": row.q_block, "worst": best.worst.tobytes(), "query_id": queries.ids[best.query], "vec_id": best.ids, "score": best.scores}
                )

    return pairs.select("q_block", "q_ids", "q_points", "q_nodes", "d_ids", "d_points", "d_nodes", "worst").mapInPandas(run, FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of every query with rows of other ids.

    ``vectors`` and ``queries`` have ``vec_id, v`` (integers). Ties go to the smaller id; a query with fewer than k
    other rows gets all of them; repeated rows of an id count as one with its best score. No vectors or queries give no rows.
    """
    spark = vectors.sparkSession
    vectors, queries = staged(vectors.dropDuplicates(["vec_id", "v"])), queries.dropDuplicates(["vec_id", "v"])
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    out = ["query_id", "rank", "vec_id", "score"]
    if not sample or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sampled = padded([r.v for r in sample], width)
    pivots = sampled[net(sampled.astype(np.float64), PIVOTS)]
    data = staged(blocks(vectors, pivots, width, BLOCK))
    asked = staged(blocks(queries, pivots[:COARSE], width, BLOCK))
    many = asked.count()
    if not many:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    d = data.select(*(F.col(c).alias(f"d_{c}") for c in data.columns))
    q = asked.select(*(F.col(c).alias(f"q_{c}") for c in asked.columns))

    def norm(c: str):
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))

    inner = F.aggregate(F.zip_with("q_center", "d_center", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    bound = inner + norm("q_center") * F.col("d_radius") + norm("d_center") * F.col("q_radius") + F.col("q_radius") * F.col("d_radius")
    summaries = staged(
        d.select("d_block", "d_center", "d_radius", F.explode(F.sequence(F.lit(0), F.lit(many - 1)).cast("array<long>")).alias("q_block"))
        .join(q.select("q_block", "q_center", "q_radius"), "q_block")
        .select("q_block", "d_block", (bound * (1 + 1e-9) + 1e-6).alias("bound"))
    )
    nearest = summaries.groupBy("q_block").agg(F.max_by("d_block", F.struct("bound", "d_block")).alias("d_block"))
    nothing = F.lit(None).cast("binary").alias("worst")
    first = staged(_searched(nearest.join(q, "q_block").join(d, "d_block").withColumn("worst", nothing), k))
    known = first.groupBy("query_block").agg(F.first("worst").alias("worst")).withColumnRenamed("query_block", "q_block")
    floor = staged(
        q.join(known, "q_block", "left").select("q_block", "worst", _least("worst", "q_ids").alias("floor"))
    )
    rest = (
        summaries.join(nearest.withColumnRenamed("d_block", "done"), "q_block")
        .filter(F.col("d_block") != F.col("done"))
        .join(floor, "q_block")
        .filter(F.col("bound") >= F.col("floor"))
        .select("q_block", "d_block", "worst")
    )
    second = _searched(rest.join(q, "q_block").join(d, "d_block"), k)
    best = first.union(second).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*out)


def _least(worst: str, ids: str):
    """The smallest worst kth score of a block; minus infinity where a query has fewer than k results."""

    @F.pandas_udf("double")
    def least(batch: pd.Series, _: pd.Series) -> pd.Series:
        return pd.Series([float(np.frombuffer(w, dtype=np.float64).min()) if w is not None else float("-inf") for w in batch])

    return least(F.col(worst), F.col(ids))
