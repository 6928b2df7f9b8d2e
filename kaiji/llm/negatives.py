"""Hard negatives for retrieval training, found with an inverted multi-index.

Vectors are cut into two halves; a codebook for each half (k-means on a bounded
sample) makes cells of code pairs. Over a stripe of vectors each code has a
radius, the largest distance of its members, so a cell's members score at most
the sum of two half bounds: half query times centre plus half norm times radius.
A heap over the two sorted bound lists (multi-sequence) visits cells by that sum;
cells are read until the next bound is below what still counts: then the window
is certified and the result exact.

An anchor's positives are its best rows of the same label. The negatives of a
positive are the best rows of other labels whose score lies between ``low`` and
``high`` percent of the positive's. Both searches run twice: in one stripe for a
first bound, then with that bound in all stripes. Stripes are dealt by hash, so
a cell, label or vector that holds a third of the rows is spread over all.

Defined cases: rows without id or label, null or empty vectors and vectors with
null or non-finite components take no part; nor do vectors of another dimension, or with
the anchor's own id, for an anchor; equal anchors ask once; other rows that repeat count once
each; ties go to the smaller id; an anchor without positives, or a positive
without negatives, has no rows; components so large that a score could exceed 64 bits
end the job with an error. Other columns take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.llm.common import stage

STRIPE_MIN, STRIPE_MAX = 4096, 131_072  # vectors of a stripe
SAMPLE = 4096  # vectors of a dimension that the codebooks are fitted on; all are indexed
READ_ROWS = 256  # vectors scored at once


# ---- codebooks ------------------------------------------------------------

def codebook(x: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of the rows of ``x``, started from the first rows."""
    centres = x[np.arange(codes) % len(x)].copy()
    for _ in range(rounds):
        near = (((centres ** 2).sum(1) - 2 * (x @ centres.T))).argmin(1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(0)
    return centres


def _codebooks(vectors: DataFrame, n: int, codes: int) -> DataFrame:
    """(dim, centres): both codebooks of each dimension, one after the other, from about ``SAMPLE`` of all ``n`` vectors."""
    draw = F.pmod(F.xxhash64("vec", "id"), F.lit(1 << 30))
    sample = vectors.select("id", "vec", "dim", draw.alias("draw")).filter(F.col("draw") <= F.lit(int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows.sort_values(["draw", "id"])["vec"].to_list()).astype(np.float64)
        half = x.shape[1] // 2
        books = [codebook(part, codes).ravel() for part in (x[:, :half], x[:, half:])]
        return pd.DataFrame({"dim": [x.shape[1]], "centres": [np.concatenate(books)]})

    return sample.dropDuplicates(["id", "draw", "dim"]).groupBy("dim").applyInPandas(fit, "dim int, centres array<double>")


# ---- one stripe -----------------------------------------------------------

class MultiIndex:
    """The cells of one stripe, and the searches in it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, centres: np.ndarray):
        dim = vectors.shape[1]
        self.half, codes = dim // 2, len(centres) // dim
        books = centres[:codes * self.half].reshape(codes, -1), centres[codes * self.half:].reshape(codes, -1)
        code, self.radius = [], []
        for part, book in zip((vectors[:, :self.half], vectors[:, self.half:]), books):
            part = part.astype(np.float64)
            near = ((book ** 2).sum(1) - 2 * (part @ book.T)).argmin(1)
            radius = np.full(codes, -np.inf)  # a code without members has no bound
            np.maximum.at(radius, near, np.sqrt(((part - book[near]) ** 2).sum(1)))
            code.append(near)
            self.radius.append(radius)
        self.books, self.codes = books, codes
        cell = code[0] * codes + code[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.start = np.searchsorted(cell[order], np.arange(codes * codes + 1))
        self.most = int(np.abs(vectors).max())
        self.norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max()))
        self.read = 0  # vectors read, for tests

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, first row, end) of the cells with members, best upper bound first."""
        q = query.astype(np.float64)
        slack = 1e-9 * (np.sqrt(q @ q) * self.norm + 1)  # over the rounding of the sums below
        upper, lower, order = [], [], []
        for part, book, radius in zip((q[:self.half], q[self.half:]), self.books, self.radius):
            middle, reach = book @ part, np.sqrt(part @ part) * np.maximum(radius, 0) + slack
            used = np.flatnonzero(radius >= 0)
            best = used[np.argsort(-(middle + reach)[used], kind="stable")]
            order.append(best)
            upper.append((middle + reach)[best])
            lower.append((middle - reach)[best])
        heap = [(-(upper[0][0] + upper[1][0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(order[1]):
                heapq.heappush(heap, (-(upper[0][i] + upper[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(order[0]):
                heapq.heappush(heap, (-(upper[0][i + 1] + upper[1][0]), i + 1, 0))
            cell = order[0][i] * self.codes + order[1][j]
            if self.start[cell] < self.start[cell + 1]:
                yield -bound, lower[0][i] + lower[1][j], self.start[cell], self.start[cell + 1]

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        self.read += len(rows)
        most = int(np.abs(query).max()) * self.most * len(query)
        if most >= 1 << 63:
            raise ValueError("components too large: a score may exceed 64 bits")
        if most < 1 << 53:
            return np.rint(self.vectors[rows].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def search(self, own: int, label: int, query: np.ndarray, k: int, same: bool, ranges: list[tuple[int | None, int | None]]) -> list[list]:
        """The best k (score, id) of each range [least, most] of scores, among rows of the same label or of others."""
        found: list[list] = [[] for _ in ranges]
        least = [lo for lo, _ in ranges]
        most = None if any(hi is None for _, hi in ranges) else max(hi for _, hi in ranges)
        waiting: list[np.ndarray] = []

        def settle():
            rows = np.concatenate(waiting)
            waiting.clear()
            rows = rows[((self.labels[rows] == label) == same) & (self.ids[rows] != own)]
            if not len(rows):
                return
            score = self.scores(query, rows)
            for w, (lo, hi) in enumerate(ranges):
                inside = np.ones(len(rows), bool)
                if least[w] is not None:
                    inside &= score >= least[w]
                if hi is not None:
                    inside &= score <= hi
                if inside.any():
                    more = rows[inside]
                    best = np.lexsort((self.ids[more], -score[inside]))[:k]
                    found[w] = sorted(found[w] + list(zip((-score[inside][best]).tolist(), self.ids[more][best].tolist())))[:k]
                    if len(found[w]) == k:
                        kth = -found[w][-1][0]
                        least[w] = kth if least[w] is None else max(least[w], kth)

        held = 0
        for upper, lower, start, end in self.cells(query):
            if all(lo is not None and upper < lo for lo in least):
                break  # certified: no unread cell reaches any range
            if most is not None and lower > most:
                continue
            waiting.append(np.arange(start, end))
            held += end - start
            if held >= READ_ROWS:
                settle()
                held = 0
        if waiting:
            settle()
        return [[(-s, i) for s, i in x] for x in found]


# ---- all stripes ----------------------------------------------------------

FOUND = "ask long, at int, vec_id long, score long"


def _search_stripes(k: int, same: bool):
    def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by stripe: the codebooks, the vectors, then the anchors that meet them."""
        now, centres, held, index = None, None, [], None
        for batch in batches:
            stripes, kinds = column(batch, "stripe"), column(batch, "kind")
            cuts = [0, *(np.flatnonzero((np.diff(stripes) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(stripes)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi <= lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if stripes[lo] != now:
                    now, centres, held, index = stripes[lo], None, [], None
                if kinds[lo] == 0:
                    centres = np.array(part.column("centres")[0].as_py())
                    continue
                vectors = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1)
                ids, labels = column(part, "id"), column(part, "label")
                if kinds[lo] == 1:
                    held.append((ids, labels, vectors))
                    continue
                if not held:
                    continue
                if index is None:  # a dimension too rare for the sample has one code, the origin
                    index = MultiIndex(*(np.concatenate(x) for x in zip(*held)), np.zeros(vectors.shape[1]) if centres is None else centres)
                out = [(ask, w, i, s) for ask, own, label, query, ranges in zip(column(part, "ask"), ids, labels, vectors, part.column("ranges").to_pylist())
                       for w, best in enumerate(index.search(own, label, query, k, same, [(r["least"], r["most"]) for r in ranges]))
                       for s, i in best]
                if out:
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                          names=["ask", "at", "vec_id", "score"])

    return run


class _Stripes:
    """Vectors dealt to stripes of bounded size, with their codebooks."""

    def __init__(self, vectors: DataFrame, codes: int):
        n = vectors.count()
        size = max(STRIPE_MIN, min(STRIPE_MAX, -(-n // (2 * vectors.sparkSession.sparkContext.defaultParallelism))))
        self.n = max(1, -(-n // size))
        self.rows = vectors.withColumn("spot", F.pmod(F.xxhash64("id", "vec"), F.lit(self.n)).cast("int"))
        self.books = stage(_codebooks(vectors, n, codes), "negatives-books").withColumn("spot", self._everywhere())

    def _everywhere(self) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(self.n - 1)))

    def _search(self, asks: DataFrame, k: int, same: bool) -> DataFrame:
        """The best k (ask, at, vec_id, score) of each range of the asks, stripe by stripe; ``asks`` have a spot."""
        none = lambda t: F.lit(None).cast(t)
        ranges, stripe = "array<struct<least:bigint,most:bigint>>", F.xxhash64("dim", "spot").alias("stripe")
        rows = (self.books.select(stripe, F.lit(0).alias("kind"), none("long").alias("ask"), none("long").alias("id"), none("long").alias("label"),
                                  none("array<bigint>").alias("vec"), none(ranges).alias("ranges"), "centres")
                .union(self.rows.select(stripe, F.lit(1), none("long"), "id", "label", "vec", none(ranges), none("array<double>")))
                .union(asks.select(stripe, F.lit(2), "ask", "id", "label", "vec", F.col("ranges").cast(ranges), none("array<double>"))))
        found = rows.repartition(self.n, "stripe").sortWithinPartitions("stripe", "kind").mapInArrow(_search_stripes(k, same), FOUND)
        best = Window.partitionBy("ask", "at").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    def best(self, asks: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """The best k of each range of the asks (ask, id, label, vec, dim, ranges) over all stripes."""
        home = asks.withColumn("spot", F.pmod(F.xxhash64("ask"), F.lit(self.n)).cast("int"))
        first = self._search(home, k, same).filter(F.col("rank") == k)
        kth = stage(first.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("at", "score"))).alias("kth")), name + "-first")
        bounded = F.transform("ranges", lambda r, i: F.struct(F.greatest(r["least"], F.try_element_at("kth", i)).alias("least"), r["most"].alias("most")))
        asks = asks.join(kth, "ask", "left").select("ask", "id", "label", "vec", "dim", bounded.alias("ranges"), self._everywhere().alias("spot"))
        return stage(self._search(asks, k, same), name)


def hard_negatives(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                   codes: int = 16) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both sides have ``id`` and ``label`` (long) and ``vec`` (array<long> without nulls).
    """
    dim = F.size("vec").alias("dim")
    some = "id is not null and label is not null and dim > 0"
    vectors = stage(rows.select("id", "label", "vec", dim).filter(some), "negatives-vectors")
    stripes = _Stripes(vectors, codes)
    asks = stage(anchors.select("id", "label", "vec", dim).filter(some).withColumn("ask", F.xxhash64("id", "label", "vec")).dropDuplicates(["ask"]), "negatives-asks")
    no = F.lit(None).cast("long")
    anyhow = F.array(F.struct(no.alias("least"), no.alias("most")))
    positives = stripes.best(asks.withColumn("ranges", anyhow), n_positives, True, "negatives-positives")
    window = F.expr(f"""struct((score * {low} + pmod(-score * {low}, 100L)) div 100 AS least,
                               (score * {high} - pmod(score * {high}, 100L)) div 100 AS most)""")  # rounded up and down
    windows = positives.select("ask", window.alias("w")).filter("w.least <= w.most").groupBy("ask").agg(F.sort_array(F.collect_set("w")).alias("ranges"))
    negatives = stripes.best(asks.join(windows, "ask").select("ask", "id", "label", "vec", "dim", "ranges"), n_negatives, False, "negatives")
    numbered = windows.select("ask", F.posexplode("ranges").alias("at", "w"))
    pairs = positives.select("ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), window.alias("w"))
    out = pairs.join(numbered, ["ask", "w"]).join(negatives, ["ask", "at"]).join(asks.select("ask", F.col("id").alias("anchor_id")), "ask")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))
