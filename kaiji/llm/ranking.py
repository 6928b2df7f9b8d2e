"""Quality classifier by Bradley-Terry pairwise ranking.

Every preference pair (a document labelled 1 before one labelled 0) gives a
difference of feature vectors; the weights minimise the logistic loss of the
differences plus a ridge penalty (Newton steps, convex). A document's strength
is its weighted feature sum; the cut is a quantile of the strengths of the
training documents (the share labelled 0), and the score maps strengths to 0..1
so that the cut falls on ``threshold``.

Features are counts of the text alone. They are computed for all rows, and the fit
uses every labelled document, with ``PAIRS_EACH`` pairs per document of the
larger side: the pairs are a table, each Newton step sums their gradient and
Hessian in the tasks, and the driver gets one row of sums a task. The steps start from
the weights of a bounded sample (at most ``MAX_LABELLED`` documents of each label), which
the loss, being convex, doesn't depend on. The cut is an exact order statistic of all strengths.

Defined cases: a null or empty text has the features of no words and a finite
score; ids with contradicting labels, null labels and null ids teach nothing;
without both labels the weights are zero and all scores are equal; equal texts
score alike; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.llm.common import stage
from kaiji.llm.quality import COMMON_WORDS
from kaiji.llm.textstats import CLASSES, Slice, slices

MAX_LABELLED = 10_000  # documents of each label that the first weights are of
GROUP_ROWS = 2_000  # documents numbered by one window
PAIRS_EACH = 2
FUNCTION_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
NAMES = ("log_words", "word_length", "distinct", "repeated", "duplicate_lines", "lines", "function_words", *CLASSES)


def feature_table(texts: pa.Array) -> np.ndarray:
    """Documents by NAMES, for one slice of texts."""
    s = Slice(texts)
    n = np.maximum(s.n_words, 1)
    lines, same = s.line_counts()
    classes = s.class_counts()
    function = pc.is_in(s.bare_words(), pa.array(FUNCTION_WORDS, pa.large_string())).to_numpy(zero_copy_only=False).astype(float)
    cols = [np.log1p(s.n_words), s.word_chars() / n, s.n_distinct() / n, s.repeat_words() / n, same / np.maximum(lines, 1),
            np.log1p(lines / n), s.per_word(function) / n]
    return np.column_stack([*cols, classes / np.maximum(classes.sum(1, keepdims=True), 1)])


def features(text: Column) -> Column:
    """array<double> of NAMES for each whole text."""
    @F.arrow_udf("array<double>")
    def ranking_features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [feature_table(texts) for _, texts in slices(batch)]
            table = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            offsets = np.arange(len(table) + 1, dtype=np.int32) * len(NAMES)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))

    return ranking_features(text)


@dataclass
class Ranking:
    """Strength = weights . (x - mean) / spread; score 1 / (1 + exp(-(strength - cut) - logit(threshold)))."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    @classmethod
    def fit(cls, good: np.ndarray, bad: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> Ranking:
        both = np.concatenate([good, bad])
        if not len(good) or not len(bad):
            return cls(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(len(NAMES)), 0.0)
        mean, spread = both.mean(0), np.maximum(both.std(0), 1e-6)
        good, bad = (good - mean) / spread, (bad - mean) / spread
        n = PAIRS_EACH * max(len(good), len(bad))
        at = np.arange(n)
        # round r of the pairing shifts one side, so the pairs of a document differ
        diff = good[at % len(good)] - bad[(at + at // len(good) + at // len(bad)) % len(bad)]
        w = np.zeros(diff.shape[1])
        for _ in range(steps):  # Newton on mean log(1 + exp(-w.d)) + ridge/2 |w|^2
            p = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))
            grad = -(p[:, None] * diff).mean(0) + ridge * w
            hess = (diff * (p * (1 - p))[:, None]).T @ diff / n + ridge * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-9:
                break
        strength = np.concatenate([good, bad]) @ w
        # the quantile, and halfway to the next strength above it
        low = np.sort(strength)[max(0, len(bad) - 1):len(bad) + 1]
        return cls(mean, spread, w, float(low.mean()))

    @classmethod
    def fit_all(cls, known: DataFrame, labels: DataFrame, ridge: float = 1e-3, steps: int = 30, most: int = MAX_LABELLED) -> Ranking:
        """``fit`` over all labelled documents, by sums of tables (``known``: id, x; ``labels``: id, label)."""
        start = cls.fit(*training_tables(known, labels, most), ridge, steps)
        taught, counts = numbered(taught_rows(known, labels))
        n_good, n_bad = counts.get(1, 0), counts.get(0, 0)
        if not n_good or not n_bad:
            return start
        k, n, every = len(NAMES), PAIRS_EACH * max(n_good, n_bad), n_good + n_bad
        mean = sums(taught, "x", lambda x: x.sum(0), k) / every
        spread = np.maximum(np.sqrt(sums(taught, "x", lambda x: ((x - mean) ** 2).sum(0), k) / every), 1e-6)
        at = F.col("at")
        pairs = taught.sparkSession.range(n).select(F.col("id").alias("at")).select(
            (at % n_good).alias("good"), ((at + F.floor(at / n_good) + F.floor(at / n_bad)) % n_bad).alias("bad"))
        side = lambda label, name: taught.filter(F.col("label") == label).select(F.col("no").alias(name), F.col("x").alias(f"{name}_x"))
        diff = stage(pairs.join(side(1, "good"), "good").join(side(0, "bad"), "bad")
                     .select(F.zip_with("good_x", "bad_x", lambda g, b: g - b).alias("d")), "ranking-pairs")
        w = start.weights * (spread / start.spread)  # the same weights of the features themselves

        def loss(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            """mean log(1 + exp(-w.d)) + ridge/2 |w|^2, its gradient and Hessian."""
            def partial(d: np.ndarray) -> np.ndarray:
                d = d / spread
                z = np.clip(d @ w, -50, 50)
                p = 1 / (1 + np.exp(z))
                return np.concatenate([[np.log1p(np.exp(-z)).sum()], -(p[:, None] * d).sum(0), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
            total = sums(diff, "d", partial, 1 + k + k * k) / n
            return total[0] + ridge / 2 * w @ w, total[1:k + 1] + ridge * w, total[k + 1:].reshape(k, k) + ridge * np.eye(k)

        now = loss(w)
        if now[0] > np.log(2):  # the sample misleads: no weights are better
            w = np.zeros(k)
            now = loss(w)
        for _ in range(steps):
            step = np.linalg.solve(now[2], now[1])
            if np.abs(step).max() < 1e-9:
                w = w - step
                break
            new = loss(w - step)
            while new[0] > now[0] + 1e-12 and np.abs(step).max() >= 1e-9:
                step = step / 2
                new = loss(w - step)
            w, now = w - step, new
        strength = F.lit(0.0)
        for i in range(k):
            strength = strength + F.lit(float(w[i] / spread[i])) * (F.col("x")[i] - F.lit(float(mean[i])))
        strengths = stage(taught.select(strength.alias("s")), "ranking-strengths")
        # the quantile, and halfway to the next strength above it
        return cls(mean, spread, w, (nth(strengths, n_bad) + nth(strengths, n_bad + 1)) / 2)

    def score(self, x: Column, threshold: float) -> Column:
        """Native expression over a feature array; rounded, so that all plans agree."""
        strength = F.lit(float(-self.cut))
        for i in range(len(NAMES)):
            strength = strength + F.lit(float(self.weights[i] / self.spread[i])) * (x[i] - F.lit(float(self.mean[i])))
        logit = float(np.log(threshold / (1 - threshold)))
        return F.round(1.0 / (1.0 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), strength + F.lit(logit))))), 9)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """True for ids whose CRC-32 (of their text) ``folds`` divides; null ids aren't held out."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % folds == 0, F.lit(False))


def agreed_labels(labels: DataFrame) -> DataFrame:
    """(id, label) of the ids whose labels don't contradict."""
    return (labels.filter("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .filter("label = other").drop("other"))


def once_each(known: DataFrame) -> DataFrame:
    """(id, x): copies of a row count once."""
    return known.filter("id is not null").groupBy("id", "x").agg(F.lit(1).alias("_one")).drop("_one")


def taught_rows(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, spot, id, x) of every labelled document; ``spot`` is the hash of the id in 0 to 1."""
    spot = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(1 << 63))
    return stage(once_each(known).join(agreed_labels(labels), "id").select("label", spot.alias("spot"), "id", "x"), "ranking-taught")


def numbered(taught: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(label, x, no) with the rows of each label numbered from 0 by (spot, id, x), and the rows of each label.
    Windows number ranges of ``spot``, some ``GROUP_ROWS`` rows each; a running sum over the ranges places them."""
    counts = dict(taught.groupBy("label").count().collect())
    ranges = max(1, max(counts.values(), default=1) // GROUP_ROWS)
    ranged = taught.withColumn("part", F.floor(F.col("spot") * ranges).cast("int"))
    before = (ranged.groupBy("label", "part").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("label").orderBy("part")) - F.col("count")).drop("count"))
    at = F.row_number().over(Window.partitionBy("label", "part").orderBy("spot", "id", "x"))
    out = ranged.withColumn("at", at).join(F.broadcast(before), ["label", "part"])
    return stage(out.select("label", "x", (F.col("at") - 1 + F.col("before")).alias("no")), "ranking-numbered"), counts


def sums(rows: DataFrame, column: str, partial: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of ``partial`` (``width`` numbers of some rows of an array column) over all rows; a row a task reaches the driver."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                out += partial(np.asarray(batch.column(0).flatten(), float).reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["t"])

    parts = rows.select(column).mapInArrow(total, "t array<double>").collect()
    return np.sum([r["t"] for r in parts], axis=0) if parts else np.zeros(width)


def nth(values: DataFrame, k: int) -> float:
    """The ``k``-th smallest (from 1) of column ``s``, or the largest if there are fewer: of 1,000 equal parts of the
    range, the one that holds it is taken again, until its values are equal."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high and (high - low) / 1000 > 0:
        part = F.least(F.floor((F.col("s") - F.lit(low)) / F.lit((high - low) / 1000)), F.lit(999)).alias("p")
        parts = values.filter(F.col("s").between(low, high)).groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
        below = values.filter(F.col("s") < F.lit(low)).count()
        for r in sorted(parts.collect(), key=lambda r: r["p"]):  # 1,000 rows
            low, high = r["low"], r["high"]
            below += r["n"]
            if below >= k:
                break
    return float(low if low == high else high)


def training_tables(known: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features of labelled documents (label 1, label 0): of each all, or about nine tenths of ``most`` by a hash of the id.

    ``known``: id, x; ``labels``: id, label. Copies of a row count once, and at most ``most`` rows of each label reach the driver.
    """
    agreed = agreed_labels(labels)
    counts = dict(agreed.groupBy("label").count().collect())
    spot, parts = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(1 << 63)), F.lit(False)
    for label, n in counts.items():
        parts = parts | ((F.col("label") == label) & (spot < F.lit(1.0 if n <= most else 0.9 * most / n)))
    met = once_each(known).join(agreed.filter(parts), "id").select("label", spot.alias("spot"), "id", "x")
    first = [met.filter(F.col("label") == label).orderBy("spot", "id", "x").limit(most) for label in (1, 0)]
    rows = first[0].unionAll(first[1]).collect()
    rows.sort(key=lambda r: (r["spot"], r["id"], r["x"]))
    return tuple(np.array([r["x"] for r in rows if r["label"] == label], float).reshape(-1, len(NAMES)) for label in (1, 0))


def rank_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for each row; learns only from labels that aren't held out."""
    known = stage(docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), features(F.col(text_col)).alias("x")), "ranking")
    taught = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(~held_out(F.col("id")))
    model = Ranking.fit_all(known, taught)
    return known.select("id", "held_out", model.score(F.col("x"), threshold).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
