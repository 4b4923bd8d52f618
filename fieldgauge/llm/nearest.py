"""Approximate nearest neighbours from low-dimensional stable projections.

Vectors are projected with Gaussian (2-stable) weights to a few dimensions, where a squared
distance is the true one times a chi-square variable. A k-d tree over the projections, fitted on
a bounded sample, deals all rows to leaves. A query first searches its home leaf, which bounds
its k-th distance; then it visits every leaf whose box it can still need. Within a leaf,
candidates are verified on the original vectors in order of projected distance until the
chi-square test says that a better one is unlikely to follow. Inner products become distances
by one added coordinate that gives all rows the same length.

Leaves and queries are dealt in blocks of bounded size, so that one leaf full of copies is many
tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.llm.tables import stored

NEIGHBOURS = 20
PROJECTED = 16  # even, so that the chi-square distribution has a closed form
#: Chance that the test does not stop before a true neighbour.
CERTAINTY = 0.97
SAMPLE_ROWS = 20_000  # rows (expected) that the tree is fitted on
LEAF_ROWS, QUERY_BLOCK, STEP = 2048, 1024, 256
LEAST_SAMPLED = 8  # sampled rows in a leaf
SEED = 20


def chi_square_quantile(chance: float, degrees: int) -> float:
    """Inverse of the chi-square distribution for an even number of degrees, by bisection."""

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < chance else (low, middle)
    return high


@dataclass
class Tree:
    """Splits of a k-d tree: inner nodes have a dimension and a cut, leaves a number."""

    dimension: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[node] < 0)
            if not len(inner):
                return self.leaf[node]
            n = node[inner]
            goes_left = points[inner, self.dimension[n]] <= self.cut[n]
            node[inner] = np.where(goes_left, self.left[n], self.right[n])


def fit_tree(sample: np.ndarray, rows: int, leaf_rows: int) -> Tree:
    """Split the sample at medians of the widest dimension until a leaf stands for ``leaf_rows`` rows."""
    dimension, cut, left, right, leaf = [], [], [], [], []
    share = rows / max(1, len(sample))
    leaves = 0

    def add() -> int:
        for values, empty in ((dimension, 0), (cut, 0.0), (left, 0), (right, 0), (leaf, -1)):
            values.append(empty)
        return len(leaf) - 1

    todo = [(add(), np.arange(len(sample)))]
    while todo:
        node, members = todo.pop()
        points = sample[members]
        widest = int(np.argmax(points.var(axis=0))) if len(members) else 0
        middle = float(np.median(points[:, widest])) if len(members) else 0.0
        low = points[:, widest] <= middle if len(members) else np.zeros(0, dtype=bool)
        if len(members) * share <= leaf_rows or len(members) < 2 * LEAST_SAMPLED or low.all():
            leaf[node], leaves = leaves, leaves + 1
            continue
        dimension[node], cut[node], left[node], right[node] = widest, middle, add(), add()
        todo += [(left[node], members[low]), (right[node], members[~low])]
    return Tree(*(np.array(x) for x in (dimension, cut, left, right, leaf)))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) as doubles: rows with an id and a finite, non-zero vector of the usual length."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = vectors.select("vec_id", v.alias("v")).filter(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = fine.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return fine.filter(F.size("v") == F.lit(sizes["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _search(points: pd.DataFrame, queries: pd.DataFrame, k: int, reach: float, largest: float) -> pd.DataFrame:
    """The best ``k`` rows of a block of points for each query, verified in order of projected distance.

    ``bound`` is a score the query has already found ``k`` times; only rows that reach it come back.
    """
    x, p, ids = np.stack(points["v"].to_numpy()), np.stack(points["p"].to_numpy()), points["vec_id"].to_numpy()
    squares = (p * p).sum(axis=1)
    found_q, found_i, found_s = [], [], []
    for qid, q, qp, bound in zip(queries["query_id"], queries["v"], queries["p"], queries["bound"], strict=True):
        q, qp = np.asarray(q, dtype=np.float64), np.asarray(qp, dtype=np.float64)
        length = math.sqrt(float((q * q).sum()))
        distance = np.maximum(squares - 2 * (p @ qp) + float((qp * qp).sum()), 0.0)
        limit = _limit(bound, length, reach, largest)
        near = np.flatnonzero(distance <= limit)
        near = near[np.argsort(distance[near], kind="stable")]
        best_s, best_i = np.zeros(0), np.zeros(0, dtype=np.int64)
        for at in range(0, len(near), STEP):
            if distance[near[at]] > limit:
                break
            step = near[at : at + STEP]
            step = step[ids[step] != qid]
            scores = (x[step] * q).sum(axis=1)  # each row summed alone: equal vectors score equally
            good = scores >= bound
            best_s, best_i = _top(np.r_[best_s, scores[good]], np.r_[best_i, ids[step][good]], k)
            if len(best_s) == k and best_s[-1] > bound:
                bound = float(best_s[-1])
                limit = _limit(bound, length, reach, largest)
        found_q.append(np.full(len(best_i), qid, dtype=np.int64))
        found_i.append(best_i)
        found_s.append(best_s)
    return pd.DataFrame({"query_id": np.concatenate(found_q), "vec_id": np.concatenate(found_i), "score": np.concatenate(found_s)})


def _limit(bound: float, length: float, reach: float, largest: float) -> float:
    """Squared projected distance beyond which the test stops, given the k-th score."""
    if bound == -math.inf:
        return math.inf
    # rounding must not turn a distance of zero into a negative one
    return reach * max(2 * largest * largest - 2 * largest * bound / length, 1e-12 * largest * largest)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    _, first = np.unique(ids, return_index=True)  # a repeated id counts once
    first = np.sort(first)[:k]
    return scores[first], ids[first]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    projected: int = PROJECTED,
    certainty: float = CERTAINTY,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found per query.

    Rows whose vector is NULL, zero, of unusual length or holds NULL or non-finite values take no
    part, nor do rows without an id. Ties go to the smaller id; a repeated id counts once, with
    its best score; a query with fewer candidates gets all of them; other columns are ignored.
    """
    spark = vectors.sparkSession
    fine = usable(vectors)
    facts = fine.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("m"), F.max(F.size("v")).alias("d")).first()
    if not facts["n"]:
        return fine.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows, largest, d = facts["n"], math.sqrt(facts["m"]), facts["d"]
    weights = np.random.default_rng(SEED).standard_normal((d + 1, projected))
    reach = chi_square_quantile(certainty, projected)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"))
                extra = np.sqrt(np.maximum(largest * largest - (v * v).sum(axis=1), 0.0))
                p = v @ weights[:-1] + extra[:, None] * weights[-1]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), _lists(p)], names=["vec_id", "v", "p"])

    base = stored(fine.select(F.col("vec_id").cast("long").alias("vec_id"), "v").mapInArrow(project, "vec_id long, v array<double>, p array<double>"), "projected")
    share = min(1.0, sample_rows / rows)
    sample = base.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("p").toPandas()
    points = np.stack(sample["p"].to_numpy()) if len(sample) else np.zeros((0, projected))
    tree = fit_tree(points, rows, leaf_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaves_of(_matrix(batch.column("p"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "v", "p", "leaf"])

    dealt = stored(base.mapInArrow(deal, "vec_id long, v array<double>, p array<double>, leaf int"), "dealt")
    # one row a leaf: its rows and its box
    extents = dealt.groupBy("leaf").agg(
        F.count("*").alias("n"), *[f(F.get("p", i)).alias(f"{name}{i}") for i in range(projected) for name, f in (("lo", F.min), ("hi", F.max))]
    ).toPandas().sort_values("leaf")
    leaf_numbers = extents["leaf"].to_numpy()
    low, high = (extents[[f"{s}{i}" for i in range(projected)]].to_numpy() for s in ("lo", "hi"))
    blocks = np.maximum(1, -(-extents["n"].to_numpy() // leaf_rows)).astype(np.int64)
    blocks_of = spark.createDataFrame([(int(a), int(b)) for a, b in zip(leaf_numbers, blocks, strict=True)], "leaf int, blocks long")
    points_df = dealt.join(F.broadcast(blocks_of), "leaf").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    queries = dealt.filter(is_query)
    n_queries = queries.count()
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    q_block = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(query_blocks)).cast("int")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The query as a point: scaled to the common length, added coordinate 0."""
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"))
                p = (v * (largest / np.sqrt((v * v).sum(axis=1)))[:, None]) @ weights[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), batch.column("v"), _lists(p), pa.array(tree.leaves_of(p).astype(np.int32)), batch.column("q_block")],
                    names=["query_id", "v", "p", "leaf", "q_block"],
                )

    asked = stored(
        queries.select(F.col("vec_id").alias("query_id"), "v", q_block.alias("q_block")).mapInArrow(home, "query_id long, v array<double>, p array<double>, leaf int, q_block int"),
        "queries",
    )
    at_home = asked.withColumns({"block": F.lit(0), "bound": F.lit(float("-inf"))})
    result = "query_id long, vec_id long, score double"
    first = stored(_visited(points_df, at_home, k, reach, largest, result), "home")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).select("query_id", F.when(F.col("n") >= k, F.col("s")).alias("bound"))
    bounded = asked.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every block of every leaf that a query can still need, but the one it has searched."""
        for batch in batches:
            if not batch.num_rows:
                continue
            v, p, bounds, own = _matrix(batch.column("v")), _matrix(batch.column("p")), batch.column("bound").to_numpy(), batch.column("leaf").to_numpy()
            lengths = np.sqrt((v * v).sum(axis=1))
            for r in range(batch.num_rows):
                gap = np.maximum(np.maximum(low - p[r], p[r] - high), 0.0)
                needed = np.flatnonzero((gap * gap).sum(axis=1) <= _limit(bounds[r], lengths[r], reach, largest))
                visit = [(leaf_numbers[i], b) for i in needed for b in range(blocks[i]) if (leaf_numbers[i], b) != (own[r], 0)]
                if visit:
                    row = batch.slice(r, 1).take(pa.array(np.zeros(len(visit), dtype=np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [row.column("query_id"), row.column("v"), row.column("p"), pa.array([a for a, _ in visit], pa.int32()), pa.array([b for _, b in visit], pa.int32()), row.column("q_block"), row.column("bound")],
                        names=["query_id", "v", "p", "leaf", "block", "q_block", "bound"],
                    )

    routed = bounded.select("query_id", "v", "p", "leaf", "q_block", "bound").mapInArrow(
        route, "query_id long, v array<double>, p array<double>, leaf int, block int, q_block int, bound double"
    )
    second = _visited(points_df, stored(routed, "routed"), k, reach, largest, result)
    merged = first.unionByName(second).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _visited(points: DataFrame, visits: DataFrame, k: int, reach: float, largest: float, schema: str) -> DataFrame:
    """Search each (leaf, block) for each block of queries that visits it."""
    keys = ["leaf", "block", "q_block"]
    # columns under new names, as both sides come from the same visits
    asked = visits.withColumnsRenamed({c: f"v_{c}" for c in keys})
    copied = points.join(visits.select(*keys).distinct(), ["leaf", "block"])

    def search(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return _search(p, q, k, reach, largest)

    return copied.groupBy(*keys).cogroup(asked.groupBy(*[f"v_{c}" for c in keys])).applyInPandas(search, schema)
