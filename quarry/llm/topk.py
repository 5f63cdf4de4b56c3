"""Exact top-k by block-at-a-time pruning.

Vectors are quantised to integers; every dimension is a term. Candidates lie in document-range blocks of
BLOCK rows, each a small forward index (a dense matrix of the rows' values) with the largest and smallest
value of every term. For a query the sum over terms of its best possible product bounds every score in a
block; blocks are taken by falling bound and scored through their forward index until the next bound falls
below the query's kth score. An equal bound is still scored, since a smaller id could win the tie.

Scale: rows are packed by a hash of their id into tiles of TILE rows and queries into tiles as well; the
pairs of tiles are dealt by key, so a task holds one tile pair whatever the table's size, and
what leaves it are k rows a query. Neither side is broadcast or collected. The last window is limited to k
rows a query on both sides of its shuffle.

Vectors that are null or hold null or non-finite components take no part. Vectors of different lengths are
padded with zeros. Null ids take no part; repeated rows are separate candidates, but never their own id's.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, TILE = 256, 8192


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False)))


def quantised(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """df with the vector as floor(scale * x) of x in double, an array<long>."""
    return df.withColumn(vector, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Index:
    """Block forward indexes of one tile of candidates, in id order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        cuts = range(0, len(ids), BLOCK)
        self.high = np.array([self.rows[i : i + BLOCK].max(axis=0) for i in cuts])
        self.low = np.array([self.rows[i : i + BLOCK].min(axis=0) for i in cuts])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """An upper bound of every score, [query, block]."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def best(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows that are not the query's own, ties to smaller ids."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)
        for b in np.argsort(-bounds, kind="stable"):
            if len(ids) == k and bounds[b] < scores[-1]:
                break
            s = slice(b * BLOCK, (b + 1) * BLOCK)
            got = self.rows[s] @ query
            own = self.ids[s] != query_id
            if len(ids) == k:
                own &= got >= scores[-1]
            if own.any():
                ids, scores = np.concatenate([ids, self.ids[s][own]]), np.concatenate([scores, got[own]])
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
        return ids, scores


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width; doubles where all products and sums are exact in them, else longs."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which is_query holds."""
    rows = quantised(usable(df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("q")).where(F.col(key).isNotNull()), "v"), "v", scale)
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    tiles, query_tiles = max(1, -(-n // TILE)), max(1, -(-n_queries // TILE))
    tile = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    # candidates go to every query tile and queries to every candidate tile: one task's work is a pair of tiles
    candidates = rows.select("id", "v", F.lit(False).alias("query"), tile(tiles, 1).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(query_tiles - 1))).alias("t"))
    queries = rows.where("q").select("id", "v", F.lit(True).alias("query"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("c"), tile(query_tiles, 2).alias("t"))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, pdf["v"]), default=0)
        asked = pdf["query"].to_numpy(bool)
        ids, all_rows = pdf["id"].to_numpy(), _matrix(pdf["v"].tolist(), width)
        biggest = int(np.abs(all_rows).max(initial=0))
        if 0 <= biggest and width * biggest * biggest < 2**52:
            all_rows = all_rows.astype(np.float64)
        found = []
        if (~asked).any():
            index = Index(ids[~asked], all_rows[~asked])
            q, q_ids = all_rows[asked], ids[asked]
            bounds = index.bounds(q)
            for i in range(len(q)):
                got, scores = index.best(q_ids[i], q[i], bounds[i], k)
                found.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": got, "score": scores.astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    near = candidates.unionByName(queries).groupBy("c", "t").applyInPandas(score, "query_id long, vec_id long, score long")

    # Spark cuts each task's rows to the k best of a query before this window's shuffle
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
