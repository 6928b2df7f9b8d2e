"""Helpers shared by the operators: table access, staged tables, row identity, ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kaiji.session import checkpoint_dir

#: Separators of words in every contract: space and the ASCII controls 9 to 13.
WORD_RE = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/kaiji-llm/{name}-{uuid.uuid4().hex[:16]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts lineage durably (a lost executor loses nothing) and gives later plans
    real sizes, so Spark itself decides whether a side is small enough to broadcast.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns of a row; equal rows are interchangeable."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until no column of ``df`` (in any case) has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def running_totals(df: DataFrame, key: str, value: str, out: str, name: str,
                   rows_per_range: int = 1_000_000) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one in the order of ``key``.

    The rows are range-partitioned on ``key`` and staged with their range
    number; a window then runs inside each range and takes the total of the
    earlier ranges from a table of one row per range. No task sees more than
    one range. Rows with equal keys are ordered at random among themselves.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, -(-df.count() // rows_per_range))
    ranged = stage(df.repartitionByRange(n, F.col(key)).withColumn("_range", F.spark_partition_id()), name)
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = stage(sums.select("_range", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_before")), name + "-ranges")
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.join(before, "_range")
            .withColumn(out, F.sum(value).over(inside) + F.col("_before")).drop("_range", "_before"))
