"""Rows of bins move once on their way into the bin table, and facts get their bins once in a run."""

from pyspark.sql import functions as F

from kaiji.fs import files
from kaiji.sinks import tables as K


def test_rows_of_a_bin_are_dealt_once_unless_a_key_is_hot(spark, tmp_path):
    plans, table = [], str(tmp_path / "t")

    def merged(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows.groupBy("k", *[c for c in ("_split",) if c in rows.columns], "p").agg(F.max("v").alias("v"))

    def put(rows):
        K.replace_partitions(rows.select("p", "k", "v"), table, "p", merged, 500, ["k"])
        return {(r["p"], r["k"]): r["v"] for r in spark.read.schema("k long, v long, p string").parquet(table).collect()}

    bins = F.when(F.col("k") == 3, F.lit(None)).when(F.col("k") % 10 == 1, "small").otherwise("large").alias("p")
    rows = spark.range(4000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v")).select("*", bins)
    want = {(None if k == 3 else "small" if k % 10 == 1 else "large", k): k + 2000 for k in range(2000)}
    assert put(rows) == want and "RepartitionByExpression [p" in plans[-1] and "_split" in plans[-1]
    assert len([f for f, _ in files(table) if "p=large" in f]) >= 4
    hot = spark.range(900).select(F.lit("large").alias("p"), F.lit(7).cast("long").alias("k"), (F.col("id") + 9000).alias("v"))
    assert put(hot) == want | {("large", 7): 9899} and "RepartitionByExpression" not in plans[-1]


def test_order_columns_of_facts_move_once(spark):
    from kaiji.operators import facts as FT
    from kaiji.plans.facts import newest_first
    rows = spark.createDataFrame([("d", 1, 2, "2024-01-02", "new"), ("d", 1, 1, "2024-01-02", "newest"), ("d", 0, 0, "2024-01-01", "old")],
                                 "docid string, src_part int, src_supp int, at string, v string").withColumn("loaded_at", F.col("at").cast("timestamp"))
    got = FT.dedupe_facts(rows, ["docid"], newest_first())
    assert [r["v"] for r in got.collect()] == ["newest"] and got.columns == rows.columns
    assert "_o1" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_run_derives_facts_with_their_bins_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from kaiji.plans import files as P
    from kaiji.plans import merge as M
    plans, write = [], K.write_delta_chunk
    monkeypatch.setattr(M.K, "write_delta_chunk", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a)))
    got = M._bins(spark, SF_SMALL, "texts", P.filing_bins(spark, SF_SMALL))
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert got.count() == P.fact_bins(spark, SF_SMALL, "texts").select("bin", "docid", "key").distinct().count()
