"""Source and sink round trips: files derived from the driver tables are
written with the Spark writers to a fresh folder under the shared
checkpoint folder, read back with the kaiji readers, and checked against
SQL over the original tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from kaiji.functions.codes import bin_id, normalize_code
from kaiji.operators.catalog import catalog_record
from kaiji.plans import sqlfrag as Q
from kaiji.plans.audit import catalog_schema
from kaiji.plans.facts import NEWEST_SQL, newest_first
from kaiji.plans.filings import CATALOG_CTE
from kaiji.plans.registry import register
from kaiji.plans.tables import table, view, with_views
from kaiji.session import work_dir
from kaiji.sinks import tables as K
from kaiji.sources import files as S
from kaiji.sources import indices as X3


RESPONSE_SIZE = 1000


@register("response_jsonl", with_views("""SELECT CAST(CAST(submit_at AS DATE) AS VARCHAR) AS access_date,
  doc_id AS docID, sec_code AS secCode, filer_name AS filerName, doc_type AS docTypeCode FROM v_filings
WHERE day(submit_at) % 10 <> 0 AND day(submit_at) <> 15""", "v_filings"))
def q_response_jsonl(spark, sf_dir):
    """K7 -> S3 + S4: filings exported as daily API responses (JSON lines; day
    10/20/30 failed, day 15 without results), read back as one row per filing
    of the successful days. Responses are chunked by a hash of the id, so no
    day is gathered into a single row of unbounded size."""
    f = view(spark, sf_dir, "v_filings").withColumn("date", F.to_date("submit_at").cast("string"))
    dom = F.dayofmonth(F.to_date("date"))
    item = F.struct(F.col("doc_id").alias("docID"), F.col("sec_code").alias("secCode"),
                    F.col("filer_name").alias("filerName"), F.col("doc_type").alias("docTypeCode"))
    # Responses hold about RESPONSE_SIZE filings: a day is split into
    # ceil(rows / RESPONSE_SIZE) hash chunks, so no day becomes one huge row.
    days = f.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    f = f.join(days, "date").withColumn(
        "chunk", F.pmod(F.hash("doc_id"), F.greatest(F.lit(1), F.ceil(F.col("_n") / RESPONSE_SIZE).cast("int"))))
    resp = (f.groupBy("date", "chunk")
            .agg(F.collect_list(item).alias("results"))
            .withColumn("status", F.when(dom % 10 == 0, "failure").otherwise("success"))
            .withColumn("message", F.when(dom % 10 == 0, F.lit("server error")))
            .withColumn("results", F.when((dom % 10 == 0) | (dom == 15), F.lit(None)).otherwise(F.col("results"))))
    path = work_dir(spark, "responses")
    K.export_jsonl(resp.drop("chunk"), path)
    result_schema = f.select(item.alias("r")).schema["r"].dataType
    return S.read_responses(spark, path, result_schema)


_VARIANTS = (("ウエイト", "index_name < 'M'"), ("ウエート", "index_name >= 'M' AND index_name < 'S'"),
             ("Weight", "index_name >= 'S'"))


@register("index_csv", with_views("""SELECT index_name, CAST(CAST(snap_month AS DATE) AS VARCHAR) AS snap_key, code,
  CAST(printf('%.4f', weight * 100) AS DOUBLE) AS weight FROM v_index_snapshots""", "v_index_snapshots"))
def q_index_csv(spark, sf_dir):
    """S5 + X3 + P7: index constituent files in the legacy Japanese encoding
    with three header spellings and a footnote line per file, read back by
    header discovery."""
    s = view(spark, sf_dir, "v_index_snapshots").withColumn("snap_key", F.to_date("snap_month").cast("string"))
    base = work_dir(spark, "index-csv")
    out = None
    for i, (wname, cond) in enumerate(_VARIANTS):
        part = s.filter(cond)
        rows = part.select("snap_key", F.col("snap_key").alias("日付"), F.concat(F.lit("銘柄 "), "code").alias("銘柄名"),
                           F.col("code").alias("コード"), F.col("index_name").alias("業種"),
                           F.format_string("%.4f%%", F.col("weight") * 100).alias(wname))
        notes = part.select("snap_key").distinct().select(
            "snap_key", F.lit("※ 注記").alias("日付"), *[F.lit(None).cast("string").alias(c)
                                                      for c in ("銘柄名", "コード", "業種", wname)])
        path = os.path.join(base, f"variant={i}")
        (rows.unionByName(notes).write.mode("overwrite").option("header", True)
         .option("encoding", S.CSV_ENCODING).partitionBy("snap_key").csv(path))
        got = S.read_index_csv(spark, path).select(F.col("業種").alias("index_name"), "snap_key", "code", "weight")
        out = got if out is None else out.unionByName(got)
    return out.withColumn("snap_key", F.col("snap_key").cast("string"))


_INDEX_NO = "(length(index_name) + ascii(right(index_name, 1))) % 5"
_INDEX_HEADERS = (("コード", "ウエイト"), ("コード", "ウエート"), ("Code", "Weight"), ("銘柄コード", "ウェイト"),
                  ("コード", "TOPIXに占める個別銘柄のウエイト"))


@register("index_sources", with_views(f"""SELECT ['{"', '".join(X3.INDICES)}'][{_INDEX_NO} + 1] AS index_name,
  CAST(CAST(snap_month AS DATE) AS VARCHAR) AS snap_key, 'JP:13' || lpad(regexp_replace(code, '[^0-9]', '', 'g'), 2, '0') || '0' AS code,
  CAST(printf('%.4f', weight * 100) AS DOUBLE) AS weight FROM v_index_snapshots""", "v_index_snapshots"))
def q_index_sources(spark, sf_dir):
    """X3 + S5: files of five indices, each with its own header words, read back by the registered reader of each."""
    s = view(spark, sf_dir, "v_index_snapshots").withColumn("snap_key", F.to_date("snap_month").cast("string"))
    code = F.concat(F.lit("13"), F.lpad(F.regexp_replace("code", "[^0-9]", ""), 2, "0"))
    base, out = work_dir(spark, "index-sources"), None
    for no, (index, (code_head, weight_head)) in enumerate(zip(X3.INDICES, _INDEX_HEADERS)):
        part = s.filter(F.expr(_INDEX_NO) == no)
        mark = F.when((F.length("index_name") % 2 == 0) & F.lit(X3.INDICES[index].decimal_codes), ".0").otherwise("")
        rows = part.select("snap_key", F.col("snap_key").alias("日付"), F.lit("銘柄").alias("銘柄名"), F.concat(code, mark).alias(code_head),
                           F.format_string("%.4f%%", F.col("weight") * 100).alias(weight_head))
        notes = part.select("snap_key").distinct().select("snap_key", F.lit("※ 注記").alias("日付"),
                                                          *[F.lit(None).cast("string").alias(c) for c in ("銘柄名", code_head, weight_head)])
        (rows.unionByName(notes).repartition("snap_key").write.mode("overwrite").option("header", True)
         .option("encoding", S.CSV_ENCODING).partitionBy("snap_key").csv(f"{base}/{index}"))
        got = X3.read_index(spark, index, f"{base}/{index}")
        out = got if out is None else out.unionByName(got)
    return out


def _code_list_lines(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ecode = F.when(k % 13 == 0, F.concat(F.lit("E"), k.cast("string"))).otherwise(
        F.concat(F.lit("E"), F.lpad(k.cast("string"), 5, "0")))
    sec = (F.when(k % 11 == 0, F.lit("0")).when(k % 17 == 0, F.lit("00000"))
           .when(k % 7 == 0, F.concat(F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("0.0")))
           .when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("0"))))
    jcn = F.concat((F.lit(1000000000000) + k).cast("string"), F.when(k % 2 == 0, F.lit(".0")).otherwise(F.lit("")))
    listed = F.when(k % 3 == 0, F.lit("非上場")).when(k % 3 == 1, F.lit("上場")).otherwise(F.lit(""))
    consolidated = F.when(k % 4 == 0, F.lit("無")).when(k % 4 == 1, F.lit("-")).otherwise(F.lit("有"))
    cols = [ecode, F.lit("内国法人"), listed, consolidated, F.lit("100"), F.lit("3月31日"), F.col("c_name"),
            F.lit(""), F.lit(""), F.lit("東京都"), F.col("c_mktsegment"), sec, jcn]
    data = c.select(F.concat_ws(",", *cols).alias("value"))
    head = spark.createDataFrame([("ダウンロード実行日,2024年06月01日,件数,1",),
                                  ("ＥＤＩＮＥＴコード,提出者種別,上場区分,連結の有無,資本金,決算日,提出者名,"
                                   "提出者名（英字）,提出者名（ヨミ）,所在地,提出者業種,証券コード,提出者法人番号",)], "value string")
    return head.coalesce(1), data


@register("code_list", """SELECT edinet_code, '内国法人' AS submitter_type,
  c_custkey % 3 = 1 AS is_listed_edinet,
  CASE WHEN c_custkey % 4 = 0 THEN false WHEN c_custkey % 4 = 1 THEN NULL ELSE true END AS is_consolidated,
  '100' AS capital, '3月31日' AS settlement_date, c_name AS company_name, CAST(NULL AS VARCHAR) AS company_name_en,
  '東京都' AS address, CASE WHEN s IS NULL OR trim(s) = '' THEN NULL ELSE coalesce(CAST(CAST(TRY_CAST(s AS DOUBLE) AS BIGINT) AS VARCHAR), s)
  END AS p6, CASE WHEN p6 IN ('0', '0000', '00000') THEN NULL ELSE p6 END AS sec_code, j AS jcn,
  c_mktsegment AS industry FROM (
  SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_custkey % 13 = 0 THEN 'E' || CAST(c_custkey AS VARCHAR)
    ELSE 'E' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS edinet_code,
  CASE WHEN c_custkey % 11 = 0 THEN '0' WHEN c_custkey % 17 = 0 THEN '00000'
       WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '0'
       WHEN c_custkey % 5 = 0 THEN NULL
       ELSE lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '0' END AS s,
  CAST(1000000000000 + c_custkey AS VARCHAR) AS j FROM customer)
WHERE length(edinet_code) = 6""".replace("SELECT edinet_code,", "SELECT * EXCLUDE (p6) FROM (SELECT edinet_code,", 1) + ")")
def q_code_list(spark, sf_dir):
    """S7 + P6: the official code list (preamble line, 13 columns) read back:
    short codes dropped, zero security codes blanked, numbers as safe integers."""
    path = work_dir(spark, "code-list")
    head, data = _code_list_lines(spark, sf_dir)
    data.write.mode("overwrite").text(path)
    head.write.mode("append").text(path)  # a file of its own, so the data are written by many tasks
    return S.read_code_list(spark, path, encoding="UTF-8").select(
        "edinet_code", "submitter_type", "is_listed_edinet", "is_consolidated", "capital", "settlement_date", "company_name",
        "company_name_en", "address", "sec_code", "jcn", "industry")


@register("aggregation_list", """WITH a AS (
  SELECT CAST(c_custkey * 10 AS BIGINT) AS pos, 'E' || CAST(c_custkey % 90000 + 10000 AS VARCHAR) AS old_code,
    CASE WHEN c_custkey % 5 = 0 THEN 'E' || CAST(c_custkey % 90000 + 10000 AS VARCHAR)
         ELSE 'E' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS new_code FROM customer
  UNION ALL SELECT CAST(c_custkey * 10 + 5 AS BIGINT), 'E' || CAST(c_custkey % 90000 + 10000 AS VARCHAR), 'E99999'
    FROM customer WHERE c_custkey % 4 = 0)
SELECT old_code, arg_max(new_code, pos) AS new_code FROM a
WHERE old_code <> new_code GROUP BY old_code""")
def q_aggregation_list(spark, sf_dir):
    """Code aggregation list (preamble, positional columns); self maps
    dropped, a repeated old code keeps its last row. The lines are sorted by ranges
    into many files, whose names keep the order."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    old = F.concat(F.lit("E"), (k % 90000 + 10000).cast("string"))
    new = F.when(k % 5 == 0, old).otherwise(F.concat(F.lit("E"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0")))
    day = F.lit("2024年06月01日")
    rows = c.select((k * 10).alias("pos"), day.alias("a"), old.alias("b"), new.alias("c")).unionByName(
        c.filter(k % 4 == 0).select((k * 10 + 5).alias("pos"), day.alias("a"), old.alias("b"), F.lit("E99999").alias("c")))
    head = spark.createDataFrame([("集約一覧", "2024年06月01日", None), ("集約日", "旧コード", "新コード")], "a string, b string, c string")
    path = work_dir(spark, "agg-list")
    rows.orderBy("pos").drop("pos").write.mode("overwrite").option("encoding", S.CSV_ENCODING).csv(path)
    head.coalesce(1).write.mode("append").option("encoding", S.CSV_ENCODING).csv(path)  # preamble and header: a file of their own
    return S.read_aggregation_list(spark, path)


@register("staged_delta_merge", """SELECT event_id, user_id, event_type,
  CASE WHEN event_type IN ('view', 'click') THEN 'local' ELSE 'remote' END AS source FROM events
WHERE event_type <> 'error' UNION ALL
SELECT event_id, user_id, event_type, 'remote' FROM events WHERE event_type IN ('signup', 'view')""")
def q_staged_delta_merge(spark, sf_dir):
    """K4 -> S9: event chunks (one per type) staged remotely; view and click of
    the same run also staged locally (local wins); the error chunk lacks its
    success marker and is ignored; a later run reuses two chunk ids and both
    runs' chunks stay; a retried chunk isn't doubled."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    staging = work_dir(spark, "staging")
    types = ["view", "click", "purchase", "signup", "error"]
    for t in types:
        K.write_delta_chunk(e.filter(F.col("event_type") == t), staging, "run_2024-06-01", t, "remote",
                            mark_success=(t != "error"))
    for t in ("view", "click"):
        K.write_delta_chunk(e.filter(F.col("event_type") == t), staging, "run_2024-06-01", t, "local")
    for t in ("signup", "view", "view"):
        K.write_delta_chunk(e.filter(F.col("event_type") == t), staging, "run_2024-06-02", t, "remote")
    return S.staged_deltas(spark, staging).select("event_id", "user_id", "event_type", "source")


@register("publish_verify", with_views("""SELECT 'catalog' AS "table", count(*) AS expected, count(*) AS read_back,
  true AS ok FROM v_filings UNION ALL SELECT 'facts', count(*), count(*), true FROM v_facts""", "v_filings", "v_facts"))
def q_publish_verify(spark, sf_dir):
    """K5: a two-table release written, read back and counted before the
    manifest points at it."""
    root = work_dir(spark, "publish")
    rel = {"catalog": catalog_record(view(spark, sf_dir, "v_filings")), "facts": view(spark, sf_dir, "v_facts")}
    return K.publish(rel, root, 1)


@register("retention_plan", """WITH r AS (SELECT DISTINCT CASE o_orderkey % 3
    WHEN 0 THEN 'run_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    WHEN 1 THEN CAST(epoch(o_orderdate) AS BIGINT)::VARCHAR
    ELSE 'tmp' || CAST(o_orderkey % 50 AS VARCHAR) END AS run_id FROM orders)
SELECT run_id, CASE WHEN regexp_extract(run_id, '(\\d{4}-\\d{2}-\\d{2})', 1) <> ''
    THEN CAST(try_strptime(regexp_extract(run_id, '(\\d{4}-\\d{2}-\\d{2})', 1), '%Y-%m-%d') AS TIMESTAMP)
  WHEN regexp_full_match(run_id, '-?[0-9]+') THEN make_timestamp(CAST(run_id AS BIGINT) * 1000000) END AS run_ts,
  CASE WHEN run_ts IS NULL THEN regexp_extract(run_id, '(\\d{4}-\\d{2}-\\d{2})', 1) = ''
       ELSE run_ts < TIMESTAMP '1998-06-01 00:00:00' - INTERVAL 24 HOUR END AS expired FROM r""")
def q_retention_plan(spark, sf_dir):
    """K6: staged run ids (date-named, epoch-named and unparseable) planned for expiry."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    rid = (F.when(k == 0, F.concat(F.lit("run_"), F.to_date("o_orderdate").cast("string")))
           .when(k == 1, F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"))
           .otherwise(F.concat(F.lit("tmp"), (F.col("o_orderkey") % 50).cast("string"))))
    runs = o.select(rid.alias("run_id")).distinct()
    return K.retention_plan(runs, "1998-06-01 00:00:00")


FACT_KINDS = {"numbers": (0, ["docid", "key", "context_ref"]), "texts": (1, ["docid", "key"])}  # flag, row key in a bin


def filing_bins(spark, sf_dir):
    """The bin of every filing."""
    return (view(spark, sf_dir, "v_filings").withColumn("code", normalize_code("sec_code", "JP"))
            .select(F.col("doc_id").alias("docid"), bin_id("edinet_code", "code", "jcn").alias("bin")))


def fact_bins(spark, sf_dir, kind: str, bins=None):
    """The facts of one kind with the bin of their filing; ``bins``: ``filing_bins`` if they stand in a table."""
    fb = filing_bins(spark, sf_dir) if bins is None else bins
    return view(spark, sf_dir, "v_facts").filter(F.col("isTextBlock_flg") == FACT_KINDS[kind][0]).join(fb, "docid")


def _upserted_bins(spark, sf_dir, kind: str):
    """Facts loaded before 1999 form the bin table of their kind; then every
    fact arrives and is upserted into the touched bins only. The facts are written with their bins
    first, as both loads read them twice (their sizes, then their rows)."""
    keys, root = FACT_KINDS[kind][1], work_dir(spark, f"bins-{kind}")
    facts = fact_bins(spark, sf_dir, kind)
    facts.write.parquet(os.path.join(root, "incoming"))
    facts = spark.read.schema(facts.schema).parquet(os.path.join(root, "incoming"))
    tbl = os.path.join(root, "table")
    first = facts.filter(F.col("loaded_at") < F.to_timestamp(F.lit("1999-01-01")))
    K.upsert_bins(first, tbl, keys, newest_first())
    K.upsert_bins(facts, tbl, keys, newest_first())
    return spark.read.parquet(tbl).select(*facts.columns)


def _listed_bins(spark, sf_dir, kind: str):
    root = work_dir(spark, f"listing-{kind}")
    K.write_table(fact_bins(spark, sf_dir, kind), root, partition_by=["bin"])
    return S.repo_listing(spark, root).select("bin").distinct()


@register("bin_upsert", with_views(f"""WITH b AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')},
  {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin FROM v_filings)
SELECT f.*, b.bin FROM v_facts f JOIN b ON f.docid = b.doc_id WHERE isTextBlock_flg = 0
QUALIFY row_number() OVER (PARTITION BY b.bin, docid, key, context_ref ORDER BY {NEWEST_SQL}) = 1""",
                                   "v_facts", "v_filings"))
def q_bin_upsert(spark, sf_dir):
    """K2 (+G2), number facts: one per (docid, key, context_ref) in a bin."""
    return _upserted_bins(spark, sf_dir, "numbers")


@register("bin_upsert_text", with_views(f"""WITH b AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')},
  {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin FROM v_filings)
SELECT f.*, b.bin FROM v_facts f JOIN b ON f.docid = b.doc_id WHERE isTextBlock_flg = 1
QUALIFY row_number() OVER (PARTITION BY b.bin, docid, key ORDER BY {NEWEST_SQL}) = 1""",
                                        "v_facts", "v_filings"))
def q_bin_upsert_text(spark, sf_dir):
    """K2 (+G2), text facts: one per (docid, key) in a bin."""
    return _upserted_bins(spark, sf_dir, "texts")


@register("repo_listing", with_views(f"""WITH b AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')},
  {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin FROM v_filings)
SELECT DISTINCT b.bin FROM v_facts f JOIN b ON f.docid = b.doc_id WHERE isTextBlock_flg = 0""",
                                     "v_facts", "v_filings"))
def q_repo_listing(spark, sf_dir):
    """The number bin table's files listed as a table; bins parsed from paths."""
    return _listed_bins(spark, sf_dir, "numbers")


@register("repo_listing_text", with_views(f"""WITH b AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')},
  {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin FROM v_filings)
SELECT DISTINCT b.bin FROM v_facts f JOIN b ON f.docid = b.doc_id WHERE isTextBlock_flg = 1""",
                                          "v_facts", "v_filings"))
def q_repo_listing_text(spark, sf_dir):
    """The text bin table's files, listed in the same way."""
    return _listed_bins(spark, sf_dir, "texts")


@register("table_roundtrip", with_views(f"WITH {CATALOG_CTE} SELECT * FROM cat", "v_filings"))
def q_table_roundtrip(spark, sf_dir):
    """K1 + S1: the catalog written with its declared schema (zstd) and read
    back; a table that was never written loads as an empty typed table."""
    path = work_dir(spark, "catalog")
    K.write_table(catalog_record(view(spark, sf_dir, "v_filings")), path, catalog_schema())
    back = S.load_table(spark, path, catalog_schema())
    missing = S.load_table(spark, os.path.join(path + "-absent"), catalog_schema())
    return back.unionByName(missing)


@register("exchange_sheet", """SELECT 'JP:' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '0' AS code,
  p_name AS company_name, p_type AS sector_jpx_33,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS sector_33_code,
  'S17-' || p_type AS sector_jpx_17, CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_size % 17 AS VARCHAR) END
  AS sector_17_code, p_brand AS market, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size % 5 AS VARCHAR) END
  AS size_code, 'Size-' || substr(p_name, 1, 3) AS size_category FROM part""")
def q_exchange_sheet(spark, sf_dir):
    """The exchange master list exported from parts and read back."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    dash = F.lit("-")
    sheet = p.select(
        F.lpad((k % 10000).cast("string"), 4, "0").alias("コード"), F.col("p_name").alias("銘柄名"),
        F.when(k % 6 == 0, dash).otherwise(F.col("p_size").cast("string")).alias("33業種コード"),
        F.col("p_type").alias("33業種区分"),
        F.when(k % 8 == 0, dash).otherwise((F.col("p_size") % 17).cast("string")).alias("17業種コード"),
        F.concat(F.lit("S17-"), "p_type").alias("17業種区分"), F.col("p_brand").alias("市場・商品区分"),
        F.when(k % 9 == 0, F.lit(" - ")).otherwise((F.col("p_size") % 5).cast("string")).alias("規模コード"),
        F.concat(F.lit("Size-"), F.substring("p_name", 1, 3)).alias("規模区分"))
    path = work_dir(spark, "exchange")
    sheet.write.mode("overwrite").option("header", True).csv(path)
    return S.read_exchange_sheet(spark, path).select(
        "code", "company_name", "sector_jpx_33", "sector_33_code", "sector_jpx_17", "sector_17_code", "market",
        "size_code", "size_category")


def _staged_catalog(spark, sf_dir):
    """Catalog deltas of two runs: every filing staged as pending by the first
    run, XBRL filings re-staged as success by the second run."""
    cat = catalog_record(view(spark, sf_dir, "v_filings"))
    staging = work_dir(spark, "catalog-deltas")
    K.write_delta_chunk(cat.withColumn("processed_status", F.lit("pending")).withColumn("batch", F.lit(1)),
                        staging, "run_2024-06-01_a", "catalog_1", "remote")
    K.write_delta_chunk(cat.filter("xbrl_flag").withColumn("processed_status", F.lit("success"))
                        .withColumn("batch", F.lit(2)), staging, "run_2024-06-02_b", "catalog_2", "remote")
    return S.staged_deltas(spark, staging)


@register("delta_merge", with_views(f"""WITH {CATALOG_CTE}
SELECT doc_id, code, CASE WHEN xbrl_flag THEN 'success' ELSE 'pending' END AS processed_status,
  CASE WHEN xbrl_flag THEN 2 ELSE 1 END AS batch FROM cat""", "v_filings"))
def q_delta_merge(spark, sf_dir):
    """M12 (catalog part): staged catalog chunks with success markers are
    collected (S9) and upserted by doc id, the later batch winning (G1)."""
    from kaiji.operators.catalog import latest_wins
    d = _staged_catalog(spark, sf_dir).select("doc_id", "code", "processed_status", "batch")
    return latest_wins(d, ["doc_id"], ["batch"])


@register("index_pipeline", with_views("""WITH s AS (SELECT index_name, CAST(CAST(snap_month AS DATE) AS VARCHAR)
  AS snap_date, code, CAST(printf('%.4f', weight * 100) AS DOUBLE) AS weight FROM v_index_snapshots),
sz AS (SELECT index_name, snap_date FROM s GROUP BY 1, 2 HAVING count(*) >= 24),
pr AS (SELECT index_name, snap_date, lag(snap_date) OVER (PARTITION BY index_name ORDER BY snap_date) AS prev FROM sz),
pairs AS (SELECT * FROM pr WHERE prev IS NOT NULL),
n AS (SELECT s.* FROM s JOIN pairs p ON s.index_name = p.index_name AND s.snap_date = p.snap_date),
o AS (SELECT s.index_name, p.snap_date, s.code, s.weight FROM s JOIN pairs p
      ON s.index_name = p.index_name AND s.snap_date = p.prev),
j AS (SELECT coalesce(o.index_name, n.index_name) AS index_name, coalesce(o.snap_date, n.snap_date) AS snap_date,
        coalesce(o.code, n.code) AS code, o.weight AS old_value, n.weight AS new_value
      FROM o FULL OUTER JOIN n ON o.index_name = n.index_name AND o.snap_date = n.snap_date AND o.code = n.code),
t AS (SELECT *, CASE WHEN old_value IS NULL AND new_value IS NOT NULL THEN 'ADD'
        WHEN new_value IS NULL AND old_value IS NOT NULL THEN 'REMOVE'
        WHEN abs(old_value - new_value) > 1.0 THEN 'UPDATE' END AS type FROM j)
SELECT snap_date AS date, index_name, code, type, old_value, new_value FROM t WHERE type IS NOT NULL""",
                                     "v_index_snapshots"))
def q_index_pipeline(spark, sf_dir):
    """M5 end to end: constituent files (S5) -> size guard (F7) -> snapshot
    table partitioned by index and date (K3) -> diff of consecutive accepted
    snapshots (J9, weights in percent, tolerance 1 point) -> history (U2)."""
    from kaiji.operators import indices as IX
    snaps = q_index_csv(spark, sf_dir).withColumnRenamed("snap_key", "snap_date")
    root = work_dir(spark, "index-snapshots")
    K.write_table(snaps, root, partition_by=["index_name", "snap_date"])
    stored = spark.read.parquet(root).withColumn("snap_date", F.col("snap_date").cast("string"))
    # The history stored by an earlier run covered the series up to 1999.
    earlier = IX.index_events(stored.filter(F.col("snap_date") < "1999-01-01"), min_rows=24, tol=1.0)
    return IX.append_history(earlier, IX.index_events(stored, min_rows=24, tol=1.0))


@register("version_read", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_totalprice FROM orders
WHERE year(o_orderdate) <= (SELECT max(year(o_orderdate)) - 2 FROM orders)""")
def q_version_read(spark, sf_dir):
    """A table of which every year's run stored a whole new version, read as of two versions before the newest."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("o_orderdate"), "o_totalprice")
    year = F.year("o_orderdate")
    newest = o.agg(F.max(year)).first()[0]
    if newest is None:
        return o
    root = work_dir(spark, "revisions")
    for v in range(newest - 3, newest + 1):
        o.filter(year <= v).write.mode("overwrite").parquet(f"{root}/v={v}")
    return S.load_version(spark, root, S.versions(spark, root)[-3], o.schema)


@register("latest_healthy_version", """SELECT year(o_orderdate) - 1994 AS version, count(*) AS n_rows FROM orders
WHERE year(o_orderdate) - 1994 = (SELECT max(year(o_orderdate) - 1994) FROM orders) GROUP BY 1""")
def q_latest_healthy_version(spark, sf_dir):
    """A table kept as versions, one per order year and 20 empty ones
    after them. The walk starts at the second-newest version and goes down to
    the first one that has rows, however far."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate",
                                              (F.year("o_orderdate") - 1994).alias("v"))
    root = work_dir(spark, "versions")
    o.write.mode("overwrite").partitionBy("v").parquet(root)
    empty = spark.createDataFrame([], o.select("o_orderkey", "o_orderdate").schema)
    for v in range(101, 121):
        empty.write.mode("overwrite").parquet(f"{root}/v={v}")
    return S.latest_healthy_version(spark, root)
