"""Exact inner-product search with a ball tree per shard.

Vectors are integers: ``floor(1024 * x)`` of every component. A node of a tree knows
its centre and radius, so for a query no vector in it can score higher than
``q . centre + |q| * radius``. Nodes are visited from the highest bound down until it
falls below the query's current k-th score. That score carries on from node to node
and, through a first search of one shard, to all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspan.llm.common import written

SCALE = 1024
TOP = 10
QUERY_MODULUS = 100
# A task holds one shard of vectors and one block of queries.
SHARD_VECTORS = 4096
BLOCK_QUERIES = 2048
LEAF_VECTORS = 32
# Products and sums below this are exact in double precision.
EXACT = float(2**52)


def usable(vector: Column) -> Column:
    """Neither NULL itself nor with a NULL, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


class BallTree:
    """Nodes over the rows of ``vectors``: centre, radius, smallest id, children or rows."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.rows = np.arange(len(vectors))
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        centers, radii, lowest = [], [], []
        # (start, end, parent, side); children are filled in when they are made.
        todo = [(0, len(vectors), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            node = len(self.nodes)
            own = vectors[self.rows[start:end]]
            center = own.mean(0)
            away = np.sqrt(((own - center) ** 2).sum(1))
            self.nodes.append((start, end, -1, -1))
            centers.append(center)
            radii.append(away.max())
            lowest.append(ids[self.rows[start:end]].min())
            if parent >= 0:
                at = list(self.nodes[parent])
                at[2 + side] = node
                self.nodes[parent] = tuple(at)
            # Equal vectors are one point: nothing can be told apart below.
            if end - start <= LEAF_VECTORS or radii[-1] == 0:
                continue
            far = own[away.argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            order = np.argsort(own @ (other - far), kind="stable")
            self.rows[start:end] = self.rows[start:end][order]
            middle = (start + end) // 2
            todo.append((start, middle, node, 0))
            todo.append((middle, end, node, 1))
        self.centers = np.array(centers)
        self.radii = np.array(radii)
        self.lowest = np.array(lowest)


def _exact(vectors: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all inner products are exact in double precision."""
    high = np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0)
    return high * max(1, vectors.shape[1]) < EXACT


def _scores(vectors: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (vectors @ query).astype(np.int64)
    # Components beyond 2**52 or so: whole numbers of any size, held to 64 bits at the end.
    whole = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in vectors]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in whole], np.int64)


def search_tree(tree, vectors, ids, query, query_id, k, floor, exact):
    """Best ``k`` (score, id) of the tree's vectors that are not below ``floor``."""
    norm = np.sqrt(query @ query)
    bounds = tree.centers @ query + norm * tree.radii
    # Rounding must never prune: widen the bounds by more than it can amount to.
    bounds += 1e-9 * (np.abs(bounds) + norm * np.sqrt((tree.centers**2).sum(1))) + 1e-3
    scores = np.zeros(0, np.int64)
    found = np.zeros(0, np.int64)
    heap = [(-bounds[0], 0)] if len(bounds) else []
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound < floor:
            break
        start, end, left, right = tree.nodes[node]
        if left >= 0:
            for child in (left, right):
                if bounds[child] >= floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        rows = tree.rows[start:end]
        rows = rows[ids[rows] != query_id]
        own = _scores(vectors[rows], query, exact)
        keep = own >= floor
        scores = np.r_[scores, own[keep]]
        found = np.r_[found, ids[rows[keep]]]
        if len(scores) > k:
            best = np.lexsort((found, -scores))[:k]
            scores, found = scores[best], found[best]
        if len(scores) >= k:
            floor = max(floor, scores.min())
    order = np.lexsort((found, -scores))[:k]
    return scores[order], found[order]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of scaled whole numbers, filled up with zeros to ``width``."""
    out = np.zeros((len(column), width))
    for row, vector in zip(out, column):
        with np.errstate(over="ignore"):
            row[: len(vector)] = np.floor(SCALE * np.asarray(vector, float))
    return np.nan_to_num(out, posinf=np.finfo(float).max, neginf=-np.finfo(float).max)


_FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def _search(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Candidates of each (shard, block) that may be among a query's best ``k``."""

    def task(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(asked):
            widths = [*map(len, vectors["vector"]), *map(len, asked["vector"])]
            all_vectors = _matrix(vectors["vector"], max(widths))
            all_queries = _matrix(asked["vector"], max(widths))
            ids = vectors["vec_id"].to_numpy()
            exact = _exact(all_vectors, all_queries)
            # Bounds need finite squares; huge components are bounded by one open node.
            tree = BallTree(all_vectors if exact else np.zeros_like(all_vectors), ids)
            if not exact:
                tree.radii[:] = np.inf
            rows = zip(asked["query"], asked["query_id"], all_queries, asked["floor"])
            for number, query_id, query, floor in rows:
                low = -np.inf if pd.isna(floor) else floor
                scores, found = search_tree(tree, all_vectors, ids, query, query_id, k, low, exact)
                out += [(number, query_id, i, s) for s, i in zip(scores.tolist(), found.tolist())]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    return (
        candidates.groupBy("shard", "block")
        .cogroup(queries.groupBy("shard", "block"))
        .applyInPandas(task, _FOUND)
    )


def top_inner_products(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank (from 1), vec_id, score.

    Queries are the rows where ``is_query`` holds, candidates all rows with another id.
    Ties go to the smaller id. Rows with a NULL id, with an unusable vector or of an
    empty table take no part. Repeated candidate rows are listed as often as they are
    there; equal query rows (id and vector) are asked once. Of vectors of different
    length the shorter one is filled up with zeros. Scores beyond 64 bits are held to
    them. Only the two named columns are read.
    """
    source = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    doubles = F.col(vector_col).cast("array<double>")
    candidates = source.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("vector"))
    asked = source.where(is_query).select(
        F.col(id_col).cast("long").alias("query_id"), doubles.alias("vector")
    )
    asked = asked.distinct().withColumn("query", F.xxhash64("query_id", "vector"))
    asked = written(asked, "queries")
    shards = max(1, -(-candidates.count() // SHARD_VECTORS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    candidates = candidates.withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    )
    dealt = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    best = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")

    pilot = _search(
        dealt.where("shard = 0"),
        asked.select("*", F.lit(0).alias("shard"), F.lit(None).cast("double").alias("floor")),
        k,
    )
    pilot = written(pilot, "pilot")
    floors = (
        pilot.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") == k)
        .select("query", "query_id", F.col("score").cast("double").alias("floor"))
    )
    informed = asked.join(floors, ["query", "query_id"], "left")
    if shards > 1:
        others = F.explode(F.sequence(F.lit(1), F.lit(shards - 1)))
        rest = _search(dealt.where("shard > 0"), informed.withColumn("shard", others), k)
        pilot = pilot.unionByName(rest)
    return (
        pilot.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
