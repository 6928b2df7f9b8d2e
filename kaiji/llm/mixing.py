"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in hash order, each as often as it may repeat.
A copy's virtual finish time is the number of its source's tokens up to its end
divided by the source's target, so at time 1 every source has sent its target. All copies
are range-sorted by finish time and the queue is cut at the total budget; the
copy in which the budget ends is taken in part.

Running sums never put a source into one task: a source is split into hash
ranges of about ``rows_per_range`` documents, and the global sort into sampled
ranges; windows run inside a range, and totals of earlier ranges are added.

Defined cases: null sources are one source, last in order; a null or empty text
has size 0, and 0 words of it are taken; a null id queues like any other; equal
rows are interchangeable; an empty table gives an empty mix.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.llm.common import WORD_RE, fresh, row_hash, running_totals, stage

WHITE = " \t\n\x0b\x0c\r"  # what WORD_RE leaves out


def word_count(text: Column) -> Column:
    """Words of the whole text: each becomes one letter, so no array of the words of a long text is built."""
    marks = F.regexp_replace(F.ltrim(text, F.lit(WHITE)), f"{WORD_RE}[{WHITE}]*", "w")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights: tuple[float, ...], share: Fraction, max_repeats: int) -> tuple[DataFrame, int]:
    """Per source: rank, source_size, n_docs, target; and the total budget.

    Weights go to the sources in code-point order, repeating. A target stops at
    ``max_repeats`` times its source; the excess is shared anew by weight until
    none is above (water filling: each round only sums the source table).
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = sources.withColumn("order", F.struct(F.col("source").isNull().alias("none"), "source")).withColumn("one", F.lit(1))
    sources = running_totals(sources, "order", "one", "rank", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    sources = stage(sources.select("source", "rank", "source_size", "n_docs", weight.alias("weight"),
                                   (F.col("source_size") * max_repeats).alias("most")), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    while total:
        capped, open_weight = sources.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
                                          F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight:  # every source is at its most
            break
        now = (total * share.numerator / share.denominator - capped) / open_weight
        if now == level:
            break
        level = now
        full = F.col("most") < F.lit(level) * F.col("weight")
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.select("source", "rank", "source_size", "n_docs", target.alias("target")), total * share.numerator // share.denominator


def mix(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: Fraction = Fraction(3, 2), max_repeats: int = 2,
        seed: str = "mix", rows_per_range: int = 10_000) -> DataFrame:
    """``rows`` (id, source, size, and any others) with source_size, target and taken.

    Weighted shares of ``share`` times all sizes; ``taken`` counts repeats.
    """
    shuffled = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"))), 1, 16)
    rows = stage(rows.withColumn("shuffle", shuffled), "mix-rows")
    sources, budget = targets(rows, weights, share, max_repeats)
    ranges = (F.lit(1) + F.floor(F.col("n_docs") / rows_per_range)).alias("ranges")
    known = stage(sources.select("source", "rank", "source_size", "target", ranges), "mix-targets")
    spot = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    queue = (rows.join(known, rows["source"].eqNullSafe(known["source"])).drop(known["source"])
             .withColumn("range", F.floor(spot * F.col("ranges"))))
    earlier = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = queue.groupBy("rank", "range").agg(F.sum("size").alias("range_size"))
    before = stage(sums.select("rank", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before")), "mix-ranges")
    inside = (Window.partitionBy("rank", "range").orderBy("shuffle", "id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queue = stage(queue.join(before, ["rank", "range"])
                  .withColumn("sent", F.col("before") + F.sum("size").over(inside))
                  .drop("range", "ranges", "before"), "mix-queue")

    def order(copy: int | Column) -> Column:
        finish = (F.col("sent") + F.lit(copy) * F.col("source_size")) / F.col("target")
        return F.struct(finish.alias("finish"), "rank", F.lit(copy).cast("int").alias("copy"), "sent")

    copies = (queue.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
              .select(order(F.col("copy")).alias("order"), "size"))
    sorted_copies = running_totals(copies, "order", "size", "reached", "mix-copies")
    cut = sorted_copies.filter(F.col("reached") > budget).agg(F.min(F.struct("order", "reached", "size")).alias("cut")).first()["cut"]
    if cut is None:
        taken = F.col("size") * max_repeats
    else:
        at = F.struct(F.lit(cut["order"]["finish"]).alias("finish"), F.lit(cut["order"]["rank"]).cast("long").alias("rank"),
                      F.lit(cut["order"]["copy"]).alias("copy"), F.lit(cut["order"]["sent"]).cast("long").alias("sent"))
        rest = budget - (cut["reached"] - cut["size"])
        each = [F.when(order(c) < at, F.col("size")).when(order(c) == at, F.lit(rest)).otherwise(F.lit(0)) for c in range(max_repeats)]
        taken = sum(each[1:], each[0])
    return queue.withColumn("taken", F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).cast("long")).drop("sent", "rank", "shuffle")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them.

    The one document that the budget's end cuts stays whole if half of it is taken.
    A row without its text is small, so the queue's rows are rebalanced: ``mix`` stages a few files, not one per part of ``docs``.
    """
    key, copies = fresh("row_key", docs), fresh("copies", docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       row_hash(docs).alias("key")).hint("rebalance")
    taken = mix(rows, **how).withColumn("copies", F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int"))
    taken = stage(taken.groupBy("key").agg(F.sum("copies").alias(copies)).filter(F.col(copies) > 0)
                  .withColumnRenamed("key", key), "mix-taken")  # equal rows are interchangeable: their copies add up
    return (docs.withColumn(key, row_hash(docs)).join(taken, key).dropDuplicates([key])
            .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[docs[c] for c in docs.columns]))
