"""Exact top-k search by inner product with a vector-approximation file.

Every component is quantised into one of ``cells`` equal cells between the
smallest and largest value of its dimension over all vectors. A query's score
against a cell vector has an upper and a lower bound; the scan of the cells
keeps the vectors whose upper bound reaches the k-th largest lower bound. Exact
vectors are then read in order of their bounds, best first, until the k-th exact
score is at least the next bound: then the result is certain.

Layout: vectors lie in stripes of bounded size, the stated query set meets each
stripe in Arrow batches, and the best k of each stripe (k rows a query) meet in
one ranking per query. Parts of the query set and stripes are spread over tasks;
no task holds more than one stripe and one batch of queries.

Defined cases: vectors that are null or hold null or non-finite components take
no part; vectors of other dimension than the query aren't its candidates; rows
with the query's own id aren't either; equal query rows ask once, and repeated
candidate rows show once each; ties go to the smaller id; rows without an id and empty vectors take no part; a
query without candidates has no rows. Integer scores are exact: double products
while they fit 53 bits, 64-bit integers beyond (larger ones wrap).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.llm.common import stage

STRIPE_MIN, STRIPE_MAX = 4096, 131_072  # vectors of a stripe
QUERY_ROWS = 256  # queries scored at once


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def grid(vectors: DataFrame, cells: int) -> DataFrame:
    """(dim, low, width): arrays over the dimensions, from the extremes of all vectors."""
    parts = vectors.select("dim", F.posexplode("vec").alias("at", "x"))
    sides = parts.groupBy("dim", "at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(cells))).cast("long")
    sides = sides.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("at", "lo", width.alias("w")))).alias("s"))
    return sides.select("dim", F.col("s.lo").alias("low"), F.col("s.w").alias("width"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Stripe:
    """The candidates of one stripe: cells for the scan, exact vectors for the verification."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.middle = (low + cells * width + (width - 1) / 2.0).astype(np.float32)
        self.half = ((width - 1) / 2.0).astype(np.float64)
        self.read = 0  # exact vectors read, for tests

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query row, candidate rows, scores) of the best k, ties included up to k by id."""
        middle = queries.astype(np.float32) @ self.middle.T
        # float32 sums err by less than this: dimension * unit roundoff * sum of magnitudes
        slack = np.abs(queries) @ self.half + 1 + np.abs(queries).astype(np.float64) @ np.abs(self.middle).max(0) * (len(self.half) + 2) * 2.0 ** -23
        exact = np.abs(queries).astype(np.float64) @ np.abs(self.vectors).max(0) < 2.0 ** 53
        for i in range(len(queries)):
            bound = middle[i].astype(np.float64)
            bound[self.ids == own[i]] = -np.inf
            n = int(np.isfinite(bound).sum())
            if not n:
                continue
            kth = np.partition(bound, len(bound) - min(k, n))[len(bound) - min(k, n)] - slack[i]  # lower bound of the kth
            near = np.flatnonzero(np.isfinite(bound) & (bound + slack[i] >= kth))
            near = near[np.argsort(-bound[near], kind="stable")]
            rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for at in range(0, len(near), 4 * k):
                if len(rows) >= k and scores[-1] > bound[near[at]] + slack[i]:
                    break  # no unread vector can reach the kth score
                more = near[at:at + 4 * k]
                self.read += len(more)
                if exact[i]:
                    got = np.rint(self.vectors[more].astype(np.float64) @ queries[i].astype(np.float64)).astype(np.int64)
                else:
                    got = self.vectors[more].astype(np.int64) @ queries[i].astype(np.int64)
                rows, scores = np.concatenate([rows, more]), np.concatenate([scores, got])
                best = np.lexsort((self.ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            yield i, rows, scores


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by stripe, the grid first, then its candidates, then the queries that meet it."""
        now, held, stripe, side = None, [], None, None
        for batch in batches:
            keys = batch.column("stripe").to_numpy()
            kinds = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if hi <= lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if keys[lo] != now:
                    now, held, stripe, side = keys[lo], [], None, None
                if kinds[lo] == 0:
                    dim = part.column("dim")[0].as_py()
                    side = [_matrix(part.column(c).slice(0, 1), dim)[0] for c in ("vec", "cells")]
                elif kinds[lo] == 1:
                    held.append([part.column("id").to_numpy(), _matrix(part.column("vec"), dim), _matrix(part.column("cells"), dim)])
                elif held:
                    if stripe is None:
                        stripe = Stripe(*(np.concatenate(x) for x in zip(*held)), *side)
                    own, vectors = part.column("id").to_numpy(), _matrix(part.column("vec"), dim)
                    query_key = part.column("query").to_numpy()
                    for at in range(0, len(own), QUERY_ROWS):
                        out = [(np.full(len(rows), query_key[at + i]), np.full(len(rows), own[at + i]), stripe.ids[rows], scores)
                               for i, rows, scores in stripe.search(own[at:at + QUERY_ROWS], vectors[at:at + QUERY_ROWS], k)]
                        if out:
                            yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                  names=["query", "query_id", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, cells: int = 32) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best candidates.

    Both sides have ``id`` (long) and ``vec`` (array<long>, without nulls).
    """
    spark = candidates.sparkSession
    vectors = stage(candidates.select("id", "vec", F.size("vec").alias("dim")).filter("id is not null and dim > 0"), "va-vectors")
    sides = stage(grid(vectors, cells), "va-grid")
    n = vectors.count()
    per_stripe = max(STRIPE_MIN, min(STRIPE_MAX, -(-n // (2 * spark.sparkContext.defaultParallelism))))
    n_stripes = max(1, -(-n // per_stripe))
    cell = F.transform(F.arrays_zip("vec", "low", "width"), lambda z: F.floor((z["vec"] - z["low"]) / z["width"]).cast("long"))
    spot = F.pmod(F.xxhash64("id", "vec"), F.lit(n_stripes))
    no_cells = F.lit(None).cast("array<bigint>")
    approximations = stage(vectors.join(sides, "dim").select(
        F.xxhash64("dim", spot).alias("stripe"), F.lit(1).alias("kind"), "dim", F.lit(0).cast("long").alias("query"), "id", "vec",
        cell.alias("cells")), "va-cells")
    stripes = approximations.select("stripe", "dim").distinct()
    asked = queries.select("id", "vec", F.size("vec").alias("dim"), F.xxhash64("id", "vec").alias("query")).distinct()
    rows = (approximations
            .union(stripes.join(sides, "dim").select("stripe", F.lit(0), "dim", F.lit(0).cast("long"), F.lit(0).cast("long"), "low", "width"))
            .union(asked.join(stripes, "dim").select("stripe", F.lit(2), "dim", "query", "id", "vec", no_cells)))
    found = (rows.repartition(n_stripes, "stripe").sortWithinPartitions("stripe", "kind")
             .mapInArrow(_search(k), "query long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
