"""Exact nearest rows by inner product: a Voronoi join.

Vectors become integers (the floor of 256 times each component), so scores are exact.  A bounded
sample of the data gives pivots; every row belongs to its nearest pivot's cell.  Each cell is summed up
by its size and its radius r, the largest distance of a row from the pivot p.  For a query q no row x
of a cell scores above <q, p> + |q| r.  A query is solved first in the cells with the largest <q, p>
that together hold k other rows; its k-th score there is a bound, and only cells that may hold a
higher or an equal score need the query.  Cells are dealt to blocks of a bounded number of rows, so a
cell with a third of all rows is many tasks, and only queries, which are the few, are replicated.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, as
query or as candidate; so do rows without an id and vectors whose length differs from that of the
pivots; ties go to the smaller id; rows with equal ids are separate candidates, but none of them is a
candidate for a query with that id; equal query rows give equal answers, which are returned once; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_sample, query, table

SCALE = 256
PIVOTS = 64
#: Rows that are read for pivots: a bounded sample, by a hash of the id.
PIVOT_ROWS = 2_000
BLOCK_ROWS = 4_000


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) with integer components, of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    whole = (
        F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    scaled = F.transform(F.col("v"), lambda x: F.floor(x * SCALE).cast("long"))
    return vectors.filter(whole).select(F.col(key).cast("long").alias("id"), v.alias("v")).select("id", scaled.alias("v"))


def choose_pivots(data: DataFrame, pivots: int = PIVOTS, rows: int = PIVOT_ROWS) -> np.ndarray:
    """Centres of a few k-means rounds over a bounded sample."""
    sample = bounded_sample(data, "id", rows).collect()
    if not sample:
        return np.zeros((0, 0))
    vectors = [r["v"] for r in sample if len(r["v"]) == len(sample[0]["v"])]
    points = np.unique(np.array(vectors, float).reshape(len(vectors), -1), axis=0)
    if len(points) <= pivots:
        return points
    rng = np.random.default_rng(7)
    centres = points[rng.choice(len(points), pivots, replace=False)]
    for _ in range(5):
        near = nearest(points, centres)[0]
        centres = np.array([points[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return np.unique(np.rint(centres), axis=0)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and the distance from it."""
    squares = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]
    cell = squares.argmin(axis=1)
    return cell, np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))


def best_rows(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
    """(query number, id, score) of the k best rows of each query, by score, then id.

    Components and their products stay far below 2**53, so double arithmetic is exact.
    """
    order = np.argsort(ids, kind="stable")
    points, ids = points[order], ids[order]
    scores = queries @ points.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    for number, row in enumerate(scores):
        if len(row) > 4 * k:
            bar = np.partition(row, len(row) - k)[len(row) - k]
            chosen = np.flatnonzero(row >= bar)
        else:
            chosen = np.arange(len(row))
        chosen = chosen[np.argsort(-row[chosen], kind="stable")][:k]
        out += [(number, int(ids[i]), int(row[i])) for i in chosen if np.isfinite(row[i])]
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score) for the rows that ``is_query(id column)`` picks."""
    data = stage(quantised(vectors, key, vector), "vectors")
    spark = data.sparkSession
    pivots = choose_pivots(data)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    width = pivots.shape[1]
    shared = spark.sparkContext.broadcast(pivots)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                cell, distance = nearest(np.stack(frame["v"].to_numpy()).astype(float), shared.value)
                yield frame.assign(cell=cell.astype(np.int32), distance=distance)

    celled = stage(
        data.filter(F.size("v") == width).mapInPandas(assign, "id long, v array<long>, cell int, distance double"), "cells"
    )
    summary = {r["cell"]: (r["n"], r["radius"]) for r in celled.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}  # one row per pivot
    size = np.array([summary.get(c, (0, 0.0))[0] for c in range(len(pivots))])
    radius = np.array([summary.get(c, (0, 0.0))[1] for c in range(len(pivots))]) * (1 + 1e-9) + 1e-6
    blocks = np.maximum(1, -(-size // BLOCK_ROWS))
    deal = F.array(*[F.lit(int(b)) for b in blocks])
    rows = stage(
        celled.withColumn("block", F.pmod(F.xxhash64("id"), F.get(deal, F.col("cell"))).cast("int")).select("id", "v", "cell", "block"),
        "blocks",
    )
    queries = stage(celled.filter(is_query(F.col("id"))).select("id", "v").distinct(), "queries")

    def route(first: bool):
        """Rows (id, v, cell, block) for the cells a query needs."""

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p = shared.value
            for frame in frames:
                if not len(frame):
                    continue
                q = np.stack(frame["v"].to_numpy()).astype(float)
                centre = q @ p.T
                bound = centre + np.sqrt((q**2).sum(axis=1))[:, None] * radius[None, :]
                bound[:, size == 0] = -np.inf
                order = np.argsort(-np.where(size > 0, centre, -np.inf), axis=1, kind="stable")
                out = []
                for n in range(len(frame)):
                    # The first cells hold k rows besides the query, or all there are.
                    held = np.cumsum(size[order[n]])
                    own = order[n][: int(np.searchsorted(held, k + 1)) + 1]
                    own = own[size[own] > 0]
                    cells = own
                    if not first:
                        bar = frame["bar"].iloc[n]
                        need = np.flatnonzero(bound[n] + 1e-6 * (1 + abs(bound[n])) >= (-np.inf if pd.isna(bar) else bar))
                        cells = np.setdiff1d(need, own)
                    out += [(frame["id"].iloc[n], frame["v"].iloc[n], int(c), b) for c in cells for b in range(blocks[c])]
                yield pd.DataFrame(out, columns=["id", "v", "cell", "block"])

        return run

    def solve(key_, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(d):
            points, ids = np.stack(d["v"].to_numpy()).astype(float), d["id"].to_numpy()
            for start in range(0, len(q), 512):
                part = q.iloc[start : start + 512]
                names = part["id"].to_numpy()
                best = best_rows(np.stack(part["v"].to_numpy()).astype(float), names, points, ids, k)
                found += [(names[n], at, score, part["v"].iloc[n]) for n, at, score in best]
        return pd.DataFrame(found, columns=["query_id", "id", "score", "v"])

    def local(routed: DataFrame, name: str) -> DataFrame:
        solved = routed.groupBy("cell", "block").cogroup(rows.groupBy("cell", "block")).applyInPandas(
            solve, "query_id long, id long, score long, v array<long>"
        )
        return stage(solved, name)

    routed = "id long, v array<long>, cell int, block int"
    near = local(queries.mapInPandas(route(True), routed), "near")
    # The k-th score so far; null while fewer than k rows are known, and then every cell is needed.
    ranked = F.sort_array(F.collect_list("score"), asc=False)  # k scores of each of a query's first blocks
    bars = near.groupBy("query_id", "v").agg(F.get(ranked, F.lit(k - 1)).cast("double").alias("bar"))
    bounded = queries.join(bars.withColumnRenamed("query_id", "id"), ["id", "v"], "left").select("id", "v", "bar")
    far = local(bounded.mapInPandas(route(False), routed), "far")
    every = near.union(far)
    best = every.groupBy("query_id", "v").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))), 1, k).alias("best")
    )
    flat = best.select("query_id", F.posexplode("best").alias("at", "hit"))
    return flat.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.minus")).alias("score")
    )


OP6_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len([x FOR x IN embedding IF NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op6_voronoi_topk", OP6_SQL)
def op6_voronoi_topk(spark, sf_dir):
    found = top_k(table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
