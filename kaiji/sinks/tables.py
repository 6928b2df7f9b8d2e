"""Table sinks.

Writes go through the Spark writers: zstd Parquet with a declared schema,
hive-style partitions with dynamic partition overwrite, success markers as
rows of a marker table, and versioned folders with a manifest table whose
newest verified entry is the published version.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from kaiji.fs import exists
from kaiji.operators.audit import conform

FILE_ROWS = 1_000_000  # rows of one file of a partition
CELLS = 64  # hash cells of a partition, whose largest bounds the rows of any key in it


def write_table(df: DataFrame, path: str, schema: StructType | None = None, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """K1: schema-enforced zstd Parquet (an empty frame still writes its columns)."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(incoming: DataFrame, path: str, part: str, merged: Callable[[DataFrame], DataFrame],
                       file_rows: int = FILE_ROWS, spread: list[str] | None = None) -> None:
    """Merge rows into the partitions of a plain Parquet table that they touch, with one write.

    Only touched partitions are read (pruned at planning time by their list) and united with the
    incoming rows; ``merged`` makes of both what the partitions shall hold. Dynamic partition
    overwrite writes new files beside the old ones and swaps each partition after the job, so the old
    files may be read by the same job, and a failed job leaves them. A histogram of the
    rows of each partition sets into how many parts it is dealt, one for each ``file_rows``, by the hash of
    ``spread`` (else of all columns), so a hot partition isn't one task; no file has more than ``file_rows``.

    With ``spread``, the columns within a partition by which ``merged`` groups, rows are dealt before they are merged, so they move
    once; ``merged`` then groups by a column ``_split`` too, if there is one. Where a key may have more rows than a file (by
    the histogram's hash cells), it is merged first, which reduces its rows before they move."""
    spark = incoming.sparkSession
    cols, rows = incoming.columns, incoming

    def sizes_of(df: DataFrame) -> dict:  # rows, and those of the largest cell, of each touched partition
        cell = [F.pmod(F.xxhash64(*spread), F.lit(CELLS)).alias("_cell")] if spread else []
        of_part = df.groupBy(part, *cell).count().groupBy(part).agg(F.sum("count"), F.max("count"))
        return {value: (n, most) for value, n, most in of_part.collect()}

    sizes = sizes_of(incoming)
    if exists(spark, path):
        here = F.col(part).isin([t for t in sizes if t is not None]) | (F.col(part).isNull() if None in sizes else F.lit(False))
        cur = spark.read.schema(incoming.schema).parquet(path).filter(here).select(*cols)
        rows = cur.unionByName(incoming)
        for value, old in sizes_of(cur).items():
            sizes[value] = tuple(map(sum, zip(sizes[value], old)))
    large = [(value, -(-n // file_rows)) for value, (n, _) in sizes.items() if n > file_rows]

    def dealt(df: DataFrame) -> DataFrame:
        if not large:
            return df.repartition(part)
        # a row for each partition over the size of a file
        files = spark.createDataFrame(large, StructType([incoming.schema[part], StructField("_files", IntegerType())]))
        split = F.pmod(F.xxhash64(*(spread or [c for c in cols if c != part])), F.coalesce("_files", F.lit(1)))
        return df.join(files, part, "left").withColumn("_split", split).drop("_files").repartition(part, "_split")

    if spread and all(most <= file_rows for _, most in sizes.values()):
        done = merged(dealt(rows)).select(*cols)
    else:
        done = dealt(merged(rows).select(*cols)).select(*cols)
    (done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", file_rows).option("compression", "zstd").partitionBy(part).parquet(path))


def upsert_bins(incoming: DataFrame, table_path: str, keys: list[str], newest_first: list, bin_col: str = "bin") -> None:
    """K2: merge incoming rows into the bins they touch, newest first (G2), with one write of those bins.

    The bin comes last in the key: it is shared by many rows, so sorts by it first would compare them all column by column."""
    from kaiji.operators.facts import dedupe_facts

    def newest(rows: DataFrame) -> DataFrame:
        return dedupe_facts(rows, [*keys, *[c for c in ("_split",) if c in rows.columns], bin_col], newest_first)

    replace_partitions(incoming, table_path, bin_col, newest, spread=keys)


def write_delta_chunk(df: DataFrame, staging: str, run_id: str, chunk_id: str, source: str,
                      mark_success: bool = True) -> None:
    """K4: a staged chunk under (source, run_id, chunk_id) plus a success
    marker row; an empty frame writes nothing. A retried chunk replaces itself."""
    if df.isEmpty():
        return
    (df.withColumn("source", F.lit(source)).withColumn("run_id", F.lit(run_id)).withColumn("chunk_id", F.lit(chunk_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "run_id", "chunk_id").parquet(os.path.join(staging, "data")))
    if mark_success:
        spark = df.sparkSession
        spark.createDataFrame([(source, run_id, chunk_id)], "source string, run_id string, chunk_id string") \
            .write.mode("append").parquet(os.path.join(staging, "markers"))


def publish(tables: dict[str, DataFrame], root: str, version: int) -> DataFrame:
    """K5: write every table of a release under ``v=<version>``, read the
    counts back in one aggregate per table, and append the release to the
    manifest only when every read-back count is at least the expected one.
    Returns the check rows (table, expected, read_back, ok)."""
    spark = next(iter(tables.values())).sparkSession
    checks = []
    for name, df in tables.items():
        seen = Observation()
        write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), os.path.join(root, name, f"v={version}"))
        expected = seen.get["n"]  # rows handed to the writer, counted on the way
        got = spark.read.parquet(os.path.join(root, name, f"v={version}")).count()
        checks.append((name, expected, got, got >= expected))
    rows = spark.createDataFrame(checks, "table string, expected long, read_back long, ok boolean")
    if all(c[3] for c in checks):
        spark.createDataFrame([(version, len(checks))], "version long, n_tables long") \
            .write.mode("append").parquet(os.path.join(root, "_manifest"))
    return rows


def published_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest verified release (rollback = the manifest is never
    advanced past a failed release)."""
    return spark.read.parquet(os.path.join(root, "_manifest")).agg(F.max("version").alias("version"))


def retention_plan(runs: DataFrame, as_of_ts: str, max_age_hours: int = 24, current_run: str | None = None) -> DataFrame:
    """K6: staged runs to expire. A ``YYYY-MM-DD`` date inside the run id, else
    an integer epoch id, must be older than the age limit; an id that is
    neither expires too (a date-like id that does not parse is kept). With
    ``current_run`` only that run is targeted."""
    rid = F.col("run_id")
    date_txt = F.regexp_extract(rid, r"(\d{4}-\d{2}-\d{2})", 1)
    by_date = F.try_to_timestamp(date_txt, F.lit("yyyy-MM-dd"))
    by_epoch = F.when(rid.rlike(r"^-?\d+$"), F.timestamp_seconds(rid.try_cast("bigint")))
    limit = F.to_timestamp(F.lit(as_of_ts)) - F.make_dt_interval(hours=F.lit(max_age_hours))
    ts = F.when(date_txt != "", by_date).otherwise(by_epoch)
    expired = (F.when(date_txt != "", F.coalesce(by_date < limit, F.lit(False)))
               .when(by_epoch.isNotNull(), by_epoch < limit).otherwise(F.lit(True)))
    if current_run is not None:
        expired = rid == F.lit(current_run)
    return runs.withColumn("run_ts", ts.cast("timestamp_ntz")).withColumn("expired", expired)


def export_jsonl(df: DataFrame, path: str) -> None:
    """K7: JSON lines export."""
    df.write.mode("overwrite").json(path)
