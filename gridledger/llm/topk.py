"""Exact top-k inner products by no-random-access aggregation.

A vector's component is its grade in that component's list. In a block of rows each list
is sorted once. All lists are read in step, from their best end: from the top where the
query's weight is positive, from the bottom where it is negative. What has been read of a
row, plus for each unread list the best or the worst value it may still hold, bounds the
row's score from above and below. Reading stops once few rows but the k best can reach the
k-th best lower bound; the scores of those rows are then resolved. A block of queries reads
together: with one depth for all lists, the sums over what has been read are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.vectors import matrix, usable

#: Rows and queries that meet in one task; queries that read the lists together.
BLOCK_ROWS, BLOCK_QUERIES, ABREAST = 8192, 8192, 128
#: Parts of the lists that have been read when the bounds are looked at.
DEPTHS = (0.5, 0.7, 0.85, 1.0)
#: Reading goes on while more rows than this times k may still qualify.
OPEN = 16


class Lists:
    """The sorted lists of one block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.values = rows.astype(np.float64)
        place = np.argsort(self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, place, axis=0)
        self.rank = np.empty_like(place)
        np.put_along_axis(self.rank, place, np.arange(len(rows))[:, None], axis=0)
        self.read = [(d, *self._read_to(int(np.ceil(d * len(rows))))) for d in DEPTHS]

    def _read_to(self, depth: int):
        """For either end: the next unread value, and what a read entry adds to the upper and to the lower bound."""
        n, v = len(self.rows), self.values
        for_plus, for_minus = self.rank >= n - depth, self.rank < depth
        next_plus, next_minus = self.sorted[max(0, n - depth - 1)], self.sorted[min(n - 1, depth)]
        low, high = self.sorted[0], self.sorted[-1]
        return next_plus, next_minus, [
            np.where(seen, v - at, 0).T.copy()
            for seen, at in ((for_plus, next_plus), (for_minus, next_minus), (for_plus, low), (for_minus, high))
        ]

    def bounds(self, plus: np.ndarray, minus: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bound of each row's score for each query."""
        _, next_plus, next_minus, (up_plus, up_minus, low_plus, low_minus) = self.read[step]
        upper = (plus @ next_plus + minus @ next_minus)[:, None] + plus @ up_plus + minus @ up_minus
        lower = (plus @ self.sorted[0] + minus @ self.sorted[-1])[:, None] + plus @ low_plus + minus @ low_minus
        return upper, lower

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its id, and ids and scores of the block's k best rows in order."""
        weights = queries.astype(np.float64)
        slack = 1e-12 * np.abs(weights).sum(axis=1) * max(1.0, np.abs(self.values).max(initial=0))
        left = np.arange(len(queries))
        for step in range(len(DEPTHS)):
            upper, lower = self.bounds(np.maximum(weights[left], 0), np.minimum(weights[left], 0), step)
            own = self.ids[None, :] == query_ids[left][:, None]
            upper[own] = lower[own] = -np.inf
            kth = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(left), -np.inf)
            able = (upper >= (kth - slack[left])[:, None]) & ~own
            done = (able.sum(axis=1) <= OPEN * k) | (step == len(DEPTHS) - 1)
            for q, may in zip(left[done], able[done], strict=True):
                row = np.flatnonzero(may)
                score = self.rows[row] @ queries[q]
                order = np.lexsort((self.ids[row], -score))[:k]
                yield query_ids[q], self.ids[row[order]], score[order]
            left = left[~done]
            if not len(left):
                return


def _meet(k: int):
    def each(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        width = key[0].as_py()
        found = [(np.empty(0, np.int64),) * 3]
        if len(rows) and len(queries):
            ids, vectors = rows["vec_id"].to_numpy(), matrix(rows["whole"], width)
            query_ids, weights = queries["vec_id"].to_numpy(), matrix(queries["whole"], width)
            top = max(1, width) * int(np.abs(vectors).max(initial=0)) * int(np.abs(weights).max(initial=0))
            if top >= 1 << 63:
                raise ArithmeticError("a score of these vectors may not fit a long")
            lists = Lists(ids, vectors)
            for i in range(0, len(weights), ABREAST):
                for q, who, score in lists.best(query_ids[i : i + ABREAST], weights[i : i + ABREAST], k):
                    found.append((np.full(len(who), q), who, score))
        return pa.table([np.concatenate(x) for x in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    return each


def top_k(
    vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k rows of highest integer inner product for every query row.

    Components become ``floor(scale * x)`` in double precision. ``is_query`` tells by
    ``id_col`` which rows are queries; all other rows, other queries too, are candidates.
    Result: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller
    id; fewer candidates than k give as many rows.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do
    null ids; vectors meet those of the same length only; an empty vector scores 0. Rows
    that repeat an id count once, by the smallest of their vectors. Scores beyond a long
    raise. Other columns aren't read. No rows give no rows.

    Blocks of rows meet blocks of queries: a row is sent once for every ``block_queries``
    queries and a query once for every ``block_rows`` rows, k rows a query and block
    return. Memory is bounded by the block sizes; nothing is broadcast.
    """
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    rows = (
        vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("whole"), is_query.alias("asks"))
        .groupBy("vec_id").agg(F.min("whole").alias("whole"), F.max("asks").alias("asks"))
        .withColumn("width", F.size("whole"))
    )
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    row_blocks, query_blocks = -(-n // block_rows) or 1, -(-asking // block_queries) or 1
    dealt = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    key = ["width", "row_block", "query_block"]
    held = rows.withColumn("row_block", dealt(row_blocks)).withColumn("query_block", every(query_blocks))
    asked = rows.where("asks").withColumn("query_block", dealt(query_blocks)).withColumn("row_block", every(row_blocks))
    met = (
        held.select(*key, "vec_id", "whole").groupBy(*key)
        .cogroup(asked.select(*key, "vec_id", "whole").groupBy(*key))
        .applyInArrow(_meet(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
