"""Filing-level queries: verdicts, catalog projection, cleanup, targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kaiji.functions.codes import bin_id, normalize_code
from kaiji.operators import verdict as V
from kaiji.plans import sqlfrag as Q
from kaiji.plans.registry import register
from kaiji.plans.tables import view, with_views


def known_status(filings: DataFrame) -> DataFrame:
    """Fixture catalog of already known statuses: every 10th filing retracted,
    every other 5th a success, the rest unknown (absent)."""
    return (filings.filter(F.col("seq_number") % 5 == 0)
            .select("doc_id", F.when(F.col("seq_number") % 10 == 0, "retracted")
                    .otherwise("success").alias("processed_status")))


KNOWN_STATUS_SQL = """known AS (SELECT doc_id, CASE WHEN seq_number % 10 = 0 THEN 'retracted' ELSE 'success' END
  AS processed_status FROM v_filings WHERE seq_number % 5 = 0)"""


def decided_filings(spark: SparkSession, sf_dir: str, scope: str) -> DataFrame:
    f = view(spark, sf_dir, "v_filings")
    return V.verdict(V.with_status(f, known_status(f)), scope)


def _verdict_sql(scope: str) -> str:
    scope_rules = ""
    if scope == "Listed":
        scope_rules = """
    WHEN n_code IS NULL THEN 'skip_out_of_scope|no_sec_code'
    WHEN length(regexp_extract(n_code, '[^:]*$')) < 4 THEN 'skip_out_of_scope|invalid_code_length'"""
    elif scope == "Unlisted":
        scope_rules = """
    WHEN n_code IS NOT NULL AND length(regexp_extract(n_code, '[^:]*$')) >= 4 THEN 'skip_out_of_scope|has_sec_code'"""
    return f"""d AS (
  SELECT f.*, coalesce(k.processed_status, 'unknown') AS local_status,
    local_status IN ('success', 'retracted', 'english_empty', 'attachment_empty') AS is_processed,
    coalesce(withdrawal_status = '1', false) AS wd,
    {Q.norm_code_cols('sec_code', 'n')},
    CASE
    WHEN submit_at IS NULL OR filer_name IS NULL OR filer_name = '' OR doc_type IS NULL OR doc_type = ''
      THEN 'skip_out_of_scope|invalid_metadata'
    WHEN is_processed AND NOT (wd AND local_status IS DISTINCT FROM 'retracted')
      THEN 'skip_already_processed|already_processed'
    WHEN wd THEN 'skip_withdrawn|withdrawn'
    WHEN doc_info_edit_status = '2' THEN 'skip_out_of_scope|already_processed'{scope_rules}
    WHEN doc_type IN ('120', '130', '140', '150', '160', '170', '180', '190')
         AND coalesce(nullif(xbrl_flag, ''), '0') = '1' THEN 'parse|none'
    ELSE 'save_raw|none' END AS vr,
    split_part(vr, '|', 1) AS verdict, split_part(vr, '|', 2) AS reason
  FROM v_filings f LEFT JOIN known k ON f.doc_id = k.doc_id)"""


def _verdict_counts_sql(scope: str) -> str:
    return with_views(f"""WITH {KNOWN_STATUS_SQL},
{_verdict_sql(scope)}
SELECT verdict, reason, {Q.counter_class()} AS counter, verdict IN ('parse', 'save_raw') AS adopted,
  count(*) AS n_docs, count(DISTINCT {Q.bin_id('edinet_code', 'n_code', 'jcn')}) AS n_bins
FROM d GROUP BY verdict, reason""", "v_filings")


def _verdict_counts(scope: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = (decided_filings(spark, sf_dir, scope)
             .withColumn("code", normalize_code("sec_code", "JP"))
             .withColumn("bin", bin_id("edinet_code", "code", "jcn")))
        return V.verdict_counts(d, [F.countDistinct("bin").alias("n_bins")]) \
            .select("verdict", "reason", "counter", "adopted", "n_docs", "n_bins")
    return run


register("filing_verdict_counts", _verdict_counts_sql("All"), headline=True)(_verdict_counts("All"))
register("filing_verdict_counts_listed", _verdict_counts_sql("Listed"))(_verdict_counts("Listed"))
register("filing_verdict_counts_unlisted", _verdict_counts_sql("Unlisted"))(_verdict_counts("Unlisted"))


# ---------------------------------------------------------------- catalog
from kaiji.operators import catalog as C  # noqa: E402
from kaiji.operators import ranges as RG  # noqa: E402
from kaiji.plans.tables import table  # noqa: E402

CATALOG_CTE = f"cat AS (SELECT {Q.CATALOG_COLS} FROM ({Q.catalog_record_select()}))"


@register("catalog_project", with_views(f"WITH {CATALOG_CTE} SELECT * FROM cat", "v_filings"))
def q_catalog_project(spark, sf_dir):
    return C.catalog_record(view(spark, sf_dir, "v_filings"))


@register("catalog_decided", with_views(f"""WITH {KNOWN_STATUS_SQL},
{_verdict_sql("All")}, {CATALOG_CTE}
SELECT cat.* REPLACE (CASE WHEN d.verdict = 'skip_withdrawn' THEN 'retracted' ELSE 'success' END AS processed_status), d.verdict
FROM cat JOIN d ON cat.doc_id = d.doc_id WHERE d.verdict IN ('parse', 'save_raw', 'skip_withdrawn')""", "v_filings"))
def q_catalog_decided(spark, sf_dir):
    """F1 -> P13: the records of saved and withdrawn filings with their first status."""
    d = decided_filings(spark, sf_dir, "All").filter(F.col("verdict").isin("parse", "save_raw", "skip_withdrawn"))
    return C.catalog_record(d).join(d.select("doc_id", "verdict"), "doc_id")


@register("catalog_cleanup", with_views(
    f"WITH {CATALOG_CTE} SELECT * REPLACE (CASE WHEN {Q.strip('code')} = 'JP:' THEN NULL ELSE code END AS code) "
    "FROM cat WHERE submit_at IS NOT NULL", "v_filings"))
def q_catalog_cleanup(spark, sf_dir):
    return C.cleanup(C.catalog_record(view(spark, sf_dir, "v_filings")))


@register("catalog_cleanup_strict", with_views(
    f"WITH {CATALOG_CTE} SELECT * REPLACE (CASE WHEN {Q.strip('code')} = 'JP:' THEN NULL ELSE code END AS code) "
    f"FROM cat WHERE submit_at IS NOT NULL AND {Q.strip('company_name')} NOT IN ('', 'Unknown') "
    f"AND doc_type IS NOT NULL AND {Q.strip('doc_type')} <> ''", "v_filings"))
def q_catalog_cleanup_strict(spark, sf_dir):
    return C.cleanup(C.catalog_record(view(spark, sf_dir, "v_filings")), strict=True)


def _catalog_with_status(spark, sf_dir):
    f = view(spark, sf_dir, "v_filings")
    st = known_status(f)
    return C.catalog_record(f).drop("processed_status").join(st, "doc_id", "left").withColumn(
        "processed_status", F.coalesce("processed_status", F.lit("pending")))


CAT_STATUS_CTE = (f"{CATALOG_CTE}, {KNOWN_STATUS_SQL}, cs AS (SELECT cat.* EXCLUDE (processed_status), coalesce(known.processed_status, 'pending') "
                  "AS processed_status FROM cat LEFT JOIN known ON cat.doc_id = known.doc_id)")


@register("backfill_targets", with_views(
    f"WITH {CAT_STATUS_CTE} SELECT * FROM cs WHERE xbrl_flag AND doc_type IN "
    "('120', '130', '140', '150', '160', '170', '180', '190') AND processed_status NOT IN ('success', 'retracted') "
    "AND raw_zip_path IS NOT NULL AND raw_zip_path <> ''", "v_filings"))
def q_backfill_targets(spark, sf_dir):
    return V.backfill_targets(_catalog_with_status(spark, sf_dir))


@register("backfill_targets_first", with_views(
    f"WITH {CAT_STATUS_CTE} SELECT * FROM cs WHERE xbrl_flag AND doc_type IN "
    "('120', '130', '140', '150', '160', '170', '180', '190') AND processed_status NOT IN ('success', 'retracted') "
    "AND raw_zip_path IS NOT NULL AND raw_zip_path <> '' ORDER BY doc_id LIMIT 50", "v_filings"))
def q_backfill_targets_first(spark, sf_dir):
    """L2: the first N targets is the feature here (a bounded work batch)."""
    return V.backfill_targets(_catalog_with_status(spark, sf_dir), limit=50)


def sector_table(spark, sf_dir):
    """Fixture 33-sector list: a customer's padded code with its nation as sector."""
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    return (cust.join(nat, cust.c_nationkey == nat.n_nationkey)
            .select(normalize_code(F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), "JP").alias("s_code"),
                    F.col("n_name").alias("sector_33"))
            .groupBy("s_code").agg(F.min("sector_33").alias("sector_33")))


SECTOR_SQL = """sec AS (SELECT 'JP:' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '0' AS s_code,
  min(n_name) AS sector_33 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""


@register("annual_reports_with_sector", with_views(f"""WITH {SECTOR_SQL},
a AS (SELECT *, {Q.norm_code_cols('sec_code', 'n')} FROM v_filings
      WHERE doc_type = '120' AND ordinance_code = '010' AND form_code = '030000'
        AND NOT coalesce(doc_info_edit_status = '2', false))
SELECT doc_id, n_code AS code, filer_name, sector_33 FROM a LEFT JOIN sec ON n_code = s_code""", "v_filings"))
def q_annual_reports_with_sector(spark, sf_dir):
    """F4 + J16: annual reports with their 33-sector label by normalised code.
    The sector list has one row per listed code."""
    a = V.annual_reports(view(spark, sf_dir, "v_filings")).withColumn("code", normalize_code("sec_code", "JP"))
    sec = sector_table(spark, sf_dir)
    return (a.join(sec, a.code == sec.s_code, "left")
            .select("doc_id", "code", "filer_name", "sector_33"))


@register("catalog_upsert", """SELECT user_id, ts, event_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_catalog_upsert(spark, sf_dir):
    """G1: events as successive upserts keyed by user; the latest (ts, event_id) wins."""
    ev = table(spark, sf_dir, "events")
    return C.latest_wins(ev, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "ts", "event_id", "event_type", "value", "props")


@register("master_freshness", with_views(f"""WITH {CATALOG_CTE},
latest AS (SELECT code, max(CAST(submit_at AS VARCHAR)) AS lt FROM cat
           WHERE code IS NOT NULL AND {Q.strip('code')} <> '' AND submit_at IS NOT NULL GROUP BY code),
keys AS (SELECT ordinal, code AS alias FROM v_entities WHERE code IS NOT NULL AND {Q.strip('code')} <> ''
         UNION SELECT ordinal, CASE WHEN strpos(code, ':') > 0 THEN regexp_extract(code, '[^:]*$') ELSE 'JP:' || code END
         FROM v_entities WHERE code IS NOT NULL AND {Q.strip('code')} <> ''),
hits AS (SELECT ordinal, max(lt) AS lt FROM keys JOIN latest ON alias = latest.code GROUP BY ordinal)
SELECT e.ordinal, e.code,
  (hits.lt IS NOT NULL AND (e.last_submitted_at IS NULL OR e.last_submitted_at = '' OR hits.lt > e.last_submitted_at)) AS updated,
  CASE WHEN updated THEN hits.lt ELSE e.last_submitted_at END AS last_submitted_at
FROM v_entities e LEFT JOIN hits ON e.ordinal = hits.ordinal""", "v_filings", "v_entities"))
def q_master_freshness(spark, sf_dir):
    """A1 on the entity table as master and the projected catalog."""
    cat = C.catalog_record(view(spark, sf_dir, "v_filings"))
    m = view(spark, sf_dir, "v_entities").select("ordinal", "code", "last_submitted_at")
    return C.master_freshness(m, cat).select("ordinal", "code", "updated", "last_submitted_at")


@register("high_water_mark", with_views("""SELECT max(try_strptime(ope_date_time, '%Y-%m-%d %H:%M')) AS max_ope,
  max_ope - INTERVAL 1 HOUR AS fetch_from FROM v_filings""", "v_filings"))
def q_high_water_mark(spark, sf_dir):
    """A2: the catalog's latest operation time, an hour back."""
    return C.high_water_mark(C.catalog_record(view(spark, sf_dir, "v_filings")))


# Fixture mapping of event types onto processing statuses.
EVENT_STATUS = {"error": "failure", "purchase": "success", "view": "parsed",
                "click": "english_empty", "signup": "attachment_empty"}


def _event_status_col():
    e = F.col("event_type")
    out = F.col("event_type")
    for k, v in EVENT_STATUS.items():
        out = F.when(e == k, F.lit(v)).otherwise(out)
    return out


_EVENT_STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_STATUS.items()) + \
    " ELSE event_type END"


@register("status_precedence", f"""WITH s AS (SELECT user_id, ts, event_id, {_EVENT_STATUS_SQL} AS status FROM events),
r AS (SELECT *, {Q.status_rank('status')} AS rk FROM s)
SELECT user_id, arg_min(status, (rk, ts, event_id)) AS final_status, min(rk) AS status_rank,
  count(*) AS n_updates FROM r GROUP BY user_id""")
def q_status_precedence(spark, sf_dir):
    """Per document (user) the most severe of its statuses; ties keep the first."""
    ev = table(spark, sf_dir, "events").withColumn("status", _event_status_col())
    return C.status_precedence(ev, "user_id", "status", ["ts", "event_id"])


@register("transactional_promotion", with_views(f"""WITH b AS (
  SELECT doc_id, CASE WHEN xbrl_flag = '1' THEN 'parsed' ELSE 'success' END AS st,
    {Q.norm_code_cols('sec_code', 'n')},
    {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin_id FROM v_filings)
SELECT doc_id, bin_id, CASE WHEN st = 'parsed' THEN CASE WHEN suffix(bin_id, '7') THEN 'failure' ELSE 'success' END
  ELSE st END AS processed_status FROM b""", "v_filings"))
def q_transactional_promotion(spark, sf_dir):
    """G14 + P4: XBRL documents end a worker run as ``parsed``; bins whose id
    ends in 7 stand for failed bin writes (fixture rule)."""
    f = (view(spark, sf_dir, "v_filings")
         .withColumn("code", normalize_code("sec_code", "JP"))
         .select("doc_id", bin_id("edinet_code", "code", "jcn").alias("bin_id"),
                 F.when(F.col("xbrl_flag") == "1", "parsed").otherwise("success").alias("processed_status")))
    failed = f.select("bin_id").filter(F.col("bin_id").endswith("7")).distinct()
    return C.promote_parsed(f, failed).select("doc_id", "bin_id", "processed_status")


H_START = "1998-01-01"


@register("discovery_matrix", with_views(f"""WITH {KNOWN_STATUS_SQL},
{_verdict_sql('All')}
SELECT doc_id AS id, n_code AS code, edinet_code AS edinet, coalesce(xbrl_flag = '1', false) AS xbrl,
  doc_type AS type, ordinance_code AS ord, form_code AS form,
  CASE WHEN CAST(submit_at AS DATE) < DATE '{H_START}' THEN 'retry' ELSE 'primary' END AS list
FROM d WHERE verdict IN ('parse', 'save_raw')""", "v_filings"))
def q_discovery_matrix(spark, sf_dir):
    """Adopted filings as primary/retry work rows, one per id."""
    return C.work_list(decided_filings(spark, sf_dir, "All"), H_START)


@register("worker_balance", with_views(f"""WITH {KNOWN_STATUS_SQL},
{_verdict_sql('All')}
SELECT count(*) AS assigned, count(*) FILTER (WHERE verdict LIKE 'skip%') AS skipped,
  count(*) FILTER (WHERE verdict = 'save_raw') AS saved, count(*) FILTER (WHERE verdict = 'parse') AS attempted,
  count(*) FILTER (WHERE verdict = 'parse' AND seq_number % 8 <> 0) AS parse_ok,
  count(*) FILTER (WHERE verdict = 'parse' AND seq_number % 8 = 0) AS parse_failed,
  assigned = skipped + saved + attempted AND attempted = parse_ok + parse_failed AS balanced FROM d""", "v_filings"))
def q_worker_balance(spark, sf_dir):
    """Worker counters balance; every 8th parse attempt fails (fixture rule)."""
    d = decided_filings(spark, sf_dir, "All").withColumn(
        "outcome", F.when(F.col("verdict") == "parse",
                          F.when(F.col("seq_number") % 8 == 0, "failed").otherwise("ok")))
    return V.worker_balance(d)


@register("requested_not_found", with_views("""SELECT r.doc_id FROM
(SELECT concat('S', lpad(CAST(o_orderkey * 2 AS VARCHAR), 7, '0')) AS doc_id FROM orders) r
WHERE r.doc_id NOT IN (SELECT doc_id FROM v_filings)""", "v_filings"))
def q_requested_not_found(spark, sf_dir):
    """F8: requested ids (every even id up to twice the range) missing from the list."""
    return _requested(spark, sf_dir)[1]


def _requested(spark, sf_dir):
    req = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.lpad((F.col("o_orderkey") * 2).cast("string"), 7, "0")).alias("doc_id"))
    return V.requested_docs(view(spark, sf_dir, "v_filings"), req)


@register("requested_found", with_views("""SELECT doc_id, sec_code, filer_name, doc_type FROM v_filings
WHERE doc_id IN (SELECT concat('S', lpad(CAST(o_orderkey * 2 AS VARCHAR), 7, '0')) FROM orders)""", "v_filings"))
def q_requested_found(spark, sf_dir):
    """F8: the listed filings among the requested ids."""
    return _requested(spark, sf_dir)[0].select("doc_id", "sec_code", "filer_name", "doc_type")


@register("fetch_ranges", """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
  UNION SELECT DATE '2001-12-24'),
g AS (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS grp FROM d)
SELECT CAST(min(d) AS VARCHAR) AS range_start, CAST(max(d) AS VARCHAR) AS range_end,
  CAST(count(*) AS INTEGER) AS n_days FROM g GROUP BY grp""")
def q_fetch_ranges(spark, sf_dir):
    """Order dates plus the as-of day merged into consecutive ranges."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d"))
    today = spark.range(1).select(F.to_date(F.lit("2001-12-24")).alias("d"))
    r = RG.date_islands(o.unionByName(today))
    return r.select(F.col("range_start").cast("string").alias("range_start"),
                    F.col("range_end").cast("string").alias("range_end"), "n_days")


BACKFILL_AS_OF = "2000-02-29"


@register("backfill_windows", f"""WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS cursor FROM orders),
p AS (SELECT cursor, DATE '{BACKFILL_AS_OF}' - INTERVAL 1 DAY AS yest,
  CAST(DATE '1990-02-28' - INTERVAL 5 DAY AS DATE) AS lim FROM c),
q AS (SELECT cursor, CAST(yest AS DATE) AS yest, lim, coalesce(cursor, lim) AS st FROM p),
r AS (SELECT *, st >= yest AS fin, CAST(st + INTERVAL 6 DAY AS DATE) AS e0,
  greatest(CAST(st - INTERVAL 60 DAY AS DATE), lim) AS rs FROM q)
SELECT CAST(cursor AS VARCHAR) AS cursor, CASE WHEN fin THEN 'FINISHED' ELSE 'RUN' END AS state,
  CAST(CASE WHEN NOT fin THEN st END AS VARCHAR) AS start_date,
  CAST(CASE WHEN NOT fin THEN CASE WHEN e0 >= yest THEN CAST(yest - INTERVAL 1 DAY AS DATE) ELSE e0 END END AS VARCHAR)
    AS end_date,
  CAST(CASE WHEN NOT fin AND rs < st THEN rs END AS VARCHAR) AS retry_start,
  CAST(CASE WHEN NOT fin AND rs < st THEN CAST(st - INTERVAL 1 DAY AS DATE) END AS VARCHAR) AS retry_end FROM r""")
def q_backfill_windows(spark, sf_dir):
    """Each distinct order date taken as a cursor, planned at a leap-day as-of."""
    c = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("cursor")).distinct()
    r = RG.backfill_windows(c, BACKFILL_AS_OF)
    return r.select(*[F.col(x).cast("string").alias(x) if x != "state" else F.col(x) for x in r.columns])
