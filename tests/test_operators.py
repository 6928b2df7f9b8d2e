"""Operator-level checks: edge tables of FIXTURES.md section 5 and metamorphic
properties (upsert twice = once, diff(x, x) is empty, input order does not
matter, stream = batch)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from kaiji.operators import audit as AU
from kaiji.operators import catalog as C
from kaiji.operators import indices as IX
from kaiji.operators import master as M
from kaiji.operators import ranges as RG
from kaiji.operators import verdict as V


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_status_precedence(spark):
    df = spark.createDataFrame([(1, "success", 1), (1, "english_empty", 2), (1, "failure", 3),
                                (2, "attachment_empty", 1), (2, "english_empty", 2)], "k int, s string, o int")
    got = rows(C.status_precedence(df, "k", "s", ["o"]), "k", "final_status")
    assert got == [(1, "failure"), (2, "english_empty")]


def test_latest_wins_is_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    once = C.latest_wins(df, ["k"], ["o"])
    twice = C.latest_wins(once.unionByName(df), ["k"], ["o"])
    assert rows(once, "k", "o", "v") == rows(twice, "k", "o", "v") == [(1, 2, "b"), (2, 1, "c")]


def test_latest_wins_ignores_input_order(spark):
    data = [(i % 7, i, str(i)) for i in range(200)]
    a = spark.createDataFrame(data, "k int, o int, v string")
    b = spark.createDataFrame(list(reversed(data)), "k int, o int, v string").repartition(5)
    assert rows(C.latest_wins(a, ["k"], ["o"]), "k", "v") == rows(C.latest_wins(b, ["k"], ["o"]), "k", "v")


def test_index_diff_edges(spark):
    # 0.250001 - 0.25 is just below 1e-6 in binary floating point: no event.
    old = spark.createDataFrame([("I", "A", 0.25), ("I", "B", 0.3), ("I", "C", 0.2)], "i string, code string, weight double")
    new = spark.createDataFrame([("I", "A", 0.250001), ("I", "B", 0.35), ("I", "D", 0.15)],
                                "i string, code string, weight double")
    got = rows(IX.diff_pair(old, new, ["i"]), "code", "type")
    assert got == [("B", "UPDATE"), ("C", "REMOVE"), ("D", "ADD")]
    assert IX.diff_pair(old, old, ["i"]).count() == 0


def test_index_events_first_snapshot_has_no_baseline(spark):
    s = spark.createDataFrame([("I", "2024-01", "A", 0.5), ("I", "2024-02", "A", 0.6), ("I", "2024-02", "B", 0.4)],
                              "index_name string, snap_date string, code string, weight double")
    got = rows(IX.index_events(s, min_rows=1), "date", "code", "type")
    assert got == [("2024-02", "A", "UPDATE"), ("2024-02", "B", "ADD")]


def test_scd2_merge(spark):
    ex = spark.createDataFrame([("size", "1", "Small", "2024-01-01", None), ("size", "2", "Mid", "2024-01-01", None),
                                ("size", "9", "Old", "2023-01-01", "2023-12-31")],
                               "type string, code string, name string, valid_from string, valid_to string")
    inc = spark.createDataFrame([("size", "1", "Small"), ("size", "2", "Medium"), ("size", "3", "Large")],
                                "type string, code string, name string")
    got = rows(M.scd2_merge(ex, inc, "2024-06-01"), "code", "name", "valid_from", "valid_to")
    assert got == [("1", "Small", "2024-01-01", None), ("2", "Medium", "2024-06-01", None),
                   ("2", "Mid", "2024-01-01", "2024-05-31"), ("3", "Large", "2024-06-01", None),
                   ("9", "Old", "2023-01-01", "2023-12-31")]


def test_backfill_windows_edges(spark):
    c = spark.createDataFrame([("2024-02-28",), ("2024-02-24",), ("2024-02-10",), (None,), ("2014-03-01",)],
                              "cursor string")
    got = {r["cursor"]: r for r in RG.backfill_windows(c, "2024-02-29").collect()}
    assert got[dt.date(2024, 2, 28)]["state"] == "FINISHED"            # start >= yesterday
    assert got[dt.date(2024, 2, 24)]["end_date"] == dt.date(2024, 2, 27)  # clipped before yesterday
    assert got[dt.date(2024, 2, 10)]["end_date"] == dt.date(2024, 2, 16)  # a full 7-day window
    first = got[None]
    assert first["start_date"] == dt.date(2014, 2, 23)       # 2014-02-28 minus 5 days (Feb 29 -> 28)
    assert first["retry_start"] is None                      # nothing before the limit
    assert got[dt.date(2014, 3, 1)]["retry_start"] == dt.date(2014, 2, 23)


def test_verdict_branches(spark):
    base = dict(submit_at="2024-01-01 09:00", filer_name="A", doc_type="120", sec_code="7203", xbrl_flag="1",
                withdrawal_status="0", doc_info_edit_status="0", is_processed=False, local_status="unknown")
    cases = [
        (dict(filer_name=""), "skip_out_of_scope", "invalid_metadata"),
        (dict(is_processed=True, local_status="success"), "skip_already_processed", "already_processed"),
        (dict(is_processed=True, local_status="success", withdrawal_status="1"), "skip_withdrawn", "withdrawn"),
        (dict(is_processed=True, local_status="retracted", withdrawal_status="1"), "skip_already_processed",
         "already_processed"),
        (dict(doc_info_edit_status="2"), "skip_out_of_scope", "already_processed"),
        (dict(), "parse", "none"),
        (dict(xbrl_flag="0"), "save_raw", "none"),
    ]
    schema = ("submit_at string, filer_name string, doc_type string, sec_code string, xbrl_flag string, "
              "withdrawal_status string, doc_info_edit_status string, is_processed boolean, local_status string")
    keys = list(base)
    data = [tuple({**base, **c}[k] for k in keys) for c, _, _ in cases]
    got = V.verdict(spark.createDataFrame(data, schema), "All").select("verdict", "reason").collect()
    assert [(r[0], r[1]) for r in got] == [(v, r) for _, v, r in cases]
    listed = spark.createDataFrame([tuple({**base, "sec_code": s}[k] for k in keys) for s in ("", "12", "7203")], schema)
    got = [r[0] for r in V.verdict(listed, "Listed").select("reason").collect()]
    assert got == ["no_sec_code", "invalid_code_length", "none"]


def test_audit_report_clean_run(spark):
    empty = spark.createDataFrame([], "layer string, object_id string")
    got = AU.audit_report(empty, repair=False).collect()
    assert [(r["layer"], r["n_anomalies"], r["status"]) for r in got] == [("ALL", 0, "PASSED")]


def test_identity_keys_prefer_corporate_number(spark):
    df = spark.createDataFrame([(1, "E00001", None, "1234567890123"), (2, None, "JP:72030", "1234567890123"),
                                (3, "E00002", "JP:72030", None)],
                               "pos int, edinet_code string, code string, jcn string")
    got = rows(M.identity_keys(df), "pos", "identity_key")
    assert got == [(1, "E00001"), (2, "E00001"), (3, "E00001")]


def test_stream_equals_batch(spark):
    from kaiji.plans import registry
    qs = registry.queries()
    s = rows(qs["stream_upsert"](spark, SF_SMALL), "user_id", "event_id")
    b = rows(qs["catalog_upsert"](spark, SF_SMALL), "user_id", "event_id")
    assert s == b


def test_upsert_bins_twice_is_once(spark, tmp_path):
    from kaiji.sinks import tables as K
    df = spark.createDataFrame([("b1", "d1", "k", "c", 1, "x"), ("b1", "d1", "k", "c", 2, "y"),
                                ("b2", "d2", "k", "c", 1, "z")],
                               "bin string, docid string, key string, context_ref string, ts int, v string")
    order = [-F.col("ts")]
    K.upsert_bins(df, str(tmp_path / "t"), ["docid", "key", "context_ref"], order)
    K.upsert_bins(df, str(tmp_path / "t"), ["docid", "key", "context_ref"], order)
    got = rows(spark.read.parquet(str(tmp_path / "t")), "bin", "docid", "v")
    assert got == [("b1", "d1", "y"), ("b2", "d2", "z")]


def _skewed(spark):
    import random
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)          # key 0 holds a third of the rows
        v = None if rnd.random() < 0.3 else f"n{rnd.randint(0, 5)}"
        data.append((key, i, rnd.randint(0, 30), v))
    return spark.createDataFrame(data, "k int, seq int, day int, v string")


def test_previous_value_matches_plain_lag_under_skew(spark):
    from pyspark.sql import Window
    from kaiji.operators.sequence import previous_value
    df = _skewed(spark)
    split = previous_value(df, "k", ["day", "seq"], "v", F.col("day"), out="p")
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("day", "seq")))
    assert rows(split, "k", "seq", "p") == rows(plain, "k", "seq", "p")


def test_fill_forward_matches_plain_window_under_skew(spark):
    from pyspark.sql import Window
    from kaiji.operators.facts import fill_forward
    df = _skewed(spark)
    split = fill_forward(df, "k", ["day", "seq"], ["v"], F.col("day"))
    w = Window.partitionBy("k").orderBy("day", "seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert rows(split, "k", "seq", "v") == rows(plain, "k", "seq", "v")


def test_fill_forward_ranges_deals_rows_once_and_fills_alike(spark, tmp_path):
    """a hot key, a NULL key and small keys; neither the rows nor the ranges are written."""
    from pyspark.sql import Window
    from kaiji.operators.facts import RANGES, SAMPLED, fill_forward_ranges
    n = RANGES * SAMPLED * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(3 * n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("double")).alias("x"), F.col("id").alias("seq"),
        F.when(F.col("id") % 101 == 0, F.col("id").cast("string")).alias("v"))
    staged = []

    def stage(d):
        staged.append(str(tmp_path / str(len(staged))))
        d.write.parquet(staged[-1])
        return spark.read.schema(d.schema).parquet(staged[-1])

    got = fill_forward_ranges(df, "k", ["x", "seq"], ["v"], stage)
    w = Window.partitionBy("k").orderBy("x", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sum(spark.read.parquet(p).count() for p in staged) < n  # borders and summaries alone
    assert spark.read.parquet(staged[0]).count() == 2


def test_golden_record_builds_each_order_once(spark):
    """one order a row, whatever the number of attributes."""
    from kaiji.operators.master import golden_record
    attrs = [f"a{i}" for i in range(8)]
    df = spark.range(20).select(
        (F.col("id") % 4).alias("identity_key"), F.when(F.col("id") > 3, "t").alias("ts"), F.lit(1).alias("priority"), F.col("id").alias("pos"),
        *[F.when(F.col("id") % (i + 2) == 0, F.col("id")).alias(a) for i, a in enumerate(attrs)], F.lit("E1").alias("edinet_code"),
        F.lit(True).alias("is_listed_edinet"), F.lit(False).alias("source_jpx"))
    out = golden_record(df, attrs, ts="ts")
    assert [r.a0 for r in out.orderBy("identity_key").collect()] == [4, None, 6, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("isnotnull(ts") == 1


def test_catalog_partitions_follow_the_rows(spark):
    """as many leading characters of the ids as the rows ask for."""
    from kaiji.streaming.jobs import PART_ROWS, _leading_chars
    ids = spark.range(4 * PART_ROWS).select(F.format_string("S%07d", "id").alias("doc_id"))
    assert _leading_chars(ids, "doc_id") == 4  # by five characters, partitions would have 1,000 rows
    assert _leading_chars(ids.limit(0), "doc_id") == 5


def test_asset_audit_spreads_rows_that_expect_no_file(spark):
    """ghosts have no path to look up; they don't meet in one task as rows without a key."""
    docs = spark.range(4_000).select(F.format_string("S%07d", "id").alias("doc_id"), F.lit("1997-01-01").cast("timestamp_ntz").alias("submit_at"),
                                     (F.col("id") % 100 == 0).alias("xbrl_flag"), F.format_string("raw/%d.zip", "id").alias("raw_zip_path"))
    odd = spark.createDataFrame([(None, None, False, "raw/x.zip"), (None, None, None, "raw/y.zip"), ("S1", None, False, None), ("S2", None, True, None)], "doc_id string, submit_at timestamp_ntz, xbrl_flag boolean, raw_zip_path string")
    listing = spark.createDataFrame([("raw/0.zip",), ("raw/0.zip",), (None,)], "path string")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("-1", "false")):
        spark.conf.set(n, v)
    try:
        got = AU.asset_audit(docs.union(odd), listing, "2008-06-01")
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert sum(tasks) == 3_999 + 2 and max(tasks) < 2_000
    kinds = {(r.issue, r.repaired_status): r["count"] for r in got.groupBy("issue", "repaired_status").count().collect()}
    assert kinds == {("ghost", "invalid"): 3_961, ("missing", "unrecoverable"): 39, ("missing", "pending"): 1}


def test_bin_upsert_derives_facts_once(spark, monkeypatch):
    """both loads read facts that stand with their bins in a table, instead of joining them for each step."""
    from kaiji.plans import files
    plans, upsert = [], files.K.upsert_bins
    monkeypatch.setattr(files.K, "upsert_bins", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), upsert(df, *a)))
    out = files.q_bin_upsert(spark, SF_SMALL)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert out.count() == files.fact_bins(spark, SF_SMALL, "numbers").select("bin", "docid", "key", "context_ref").distinct().count()
