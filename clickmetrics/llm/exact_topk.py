"""Exact top-k by inner product with pivot tables.

Inner products become distances: with one more component sqrt(M - |x|^2) for candidates and 0 for
queries, |q' - x'|^2 = |q|^2 + M - 2 q.x. For each block of candidates the distances to some pivots
are kept; by the triangle inequality every pivot bounds a distance from below, and the largest
bound gives the highest score the candidate can have. Candidates are scored in the order of these
bounds until none that is left can reach the k-th score, so the result is exact.

Queries and candidates are dealt into blocks of bounded size and each pair of blocks is one task:
queries meet every candidate by an equi-join on block numbers. A pair returns k rows a query; the
best of them over all blocks are the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
PIVOTS = 16
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
CHUNK = 512


def integer_vectors(df: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows with null or non-finite parts go."""
    usable = "embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return df.where(f"vec_id IS NOT NULL AND ({usable})").selectExpr(
        "CAST(vec_id AS bigint) AS vec_id",
        f"transform(embedding, x -> CAST(floor({scale} * CAST(x AS double)) AS bigint)) AS v",
    )


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Points far from each other: each next one is the farthest from those chosen."""
    chosen = [int(np.argmax((points * points).sum(axis=1)))]
    nearest = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


class PivotTable:
    """A block of candidates with their distances to pivots."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: int = PIVOTS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        real = self.vectors.astype(np.float64)
        norms = (real * real).sum(axis=1)
        self.most = float(norms.max())
        self.points = np.hstack([real, np.sqrt(np.maximum(self.most - norms, 0))[:, None]])
        self.pivots = _pivots(self.points, pivots)
        self.table = np.ascontiguousarray(_distances(self.points, self.pivots).T)

    def search(self, own_id: int, query: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        """Ids and scores of the k best but for the query's own id, ties to smaller ids."""
        point = np.append(query.astype(np.float64), 0.0)
        to_pivots = _distances(point[None, :], self.pivots)[0]
        bound = np.abs(self.table[0] - to_pivots[0])
        for row, d in zip(self.table[1:], to_pivots[1:]):
            np.maximum(bound, np.abs(row - d), out=bound)
        reach = float(point @ point) + self.most
        if reach >= 2**63:
            raise OverflowError("scores of these vectors may pass 63 bits")
        # Room for rounding: distances carry errors far below this share of their size.
        bound = np.maximum(bound - 1e-6 * (1 + np.sqrt(reach)), 0)
        highest = np.floor((reach - bound * bound) / 2 + 1e-6 * (1 + reach))
        order = np.argsort(-highest, kind="stable")
        exact = reach < 2**52
        ids, scores, kth = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for lo in range(0, len(order), CHUNK):
            some = order[lo : lo + CHUNK]
            if kth is not None and highest[some[0]] < kth:
                break
            some = some[self.ids[some] != own_id]
            if exact:
                new = (self.points[some, :-1] @ point[:-1]).astype(np.int64)
            else:
                new = self.vectors[some] @ query
            ids, scores = np.concatenate([ids, self.ids[some]]), np.concatenate([scores, new])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            kth = scores[-1] if len(scores) == k else None
        return ids.tolist(), scores.tolist()


def search_all(vectors: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other ids for every query row.

    ``vectors`` has vec_id and embedding. Vectors that are null or hold null or non-finite components,
    and rows without an id, take no part. Vectors only meet those of equal length. A query never
    meets its own id; where ids repeat, each row of another id counts. Fewer candidates give fewer rows.
    Vectors without components score 0 with each other. Components so large that a score may pass 63
    bits fail the search.
    """
    points = integer_vectors(vectors).withColumn("dim", F.size("v"))
    rows, queries = points.agg(F.count("*"), F.count_if(F.expr(is_query))).first()
    n_q, n_c = max(1, -(-queries // QUERY_BLOCK)), max(1, -(-rows // CANDIDATE_BLOCK))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(n)).cast("int")
    asked = points.where(is_query).withColumns(
        {"q": block(n_q, 1), "c": F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))}
    )
    offered = points.withColumns({"c": block(n_c, 2), "q": F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))})

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            table = PivotTable(right.column("vec_id").to_numpy(), _matrix(right, dim))
            for own_id, query in zip(left.column("vec_id").to_pylist(), _matrix(left, dim)):
                ids, scores = table.search(own_id, query, k)
                out[0].extend([own_id] * len(ids))
                out[1].extend(ids)
                out[2].extend(scores)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    found = asked.groupBy("q", "c", "dim").cogroup(offered.groupBy("q", "c", "dim")).applyInArrow(
        pair, "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
