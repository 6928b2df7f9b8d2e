"""Integrity-audit queries over the filing / fact / index adapters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kaiji.functions.codes import bin_id, normalize_code
from kaiji.functions.dates import repo_path
from kaiji.operators import audit as AU
from kaiji.operators import digest as D
from kaiji.operators import indices as IX
from kaiji.operators.catalog import catalog_record
from kaiji.plans import sqlfrag as Q
from kaiji.plans.filings import CATALOG_CTE, KNOWN_STATUS_SQL, known_status
from kaiji.plans.history import _index_events_sql
from kaiji.plans.registry import register
from kaiji.plans.tables import table, view, with_views
from kaiji.session import checkpoint_dir

AS_OF = "2008-06-01"


def _filings(spark, sf_dir, filings=None):
    return filings if filings is not None else view(spark, sf_dir, "v_filings")


def _catalog(spark, sf_dir, filings=None):
    return catalog_record(_filings(spark, sf_dir, filings))


def _listing(spark, sf_dir):
    """Repository listing: one archive per order that has line items."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("raw/"), F.col("l_orderkey").cast("string"), F.lit(".zip")).alias("path")).distinct()


LISTING_SQL = "lst AS (SELECT DISTINCT 'raw/' || CAST(l_orderkey AS VARCHAR) || '.zip' AS p FROM lineitem)"
ASSETS_SQL = f"""{CATALOG_CTE}, {LISTING_SQL},
ac AS (SELECT cat.*, CASE WHEN xbrl_flag THEN coalesce(raw_zip_path, zip_repo_path) END AS ex FROM cat),
aj AS (SELECT ac.*, lst.p AS listed, NOT xbrl_flag AND raw_zip_path IS NOT NULL AS ghost,
  xbrl_flag AND lst.p IS NULL AS missing FROM ac LEFT JOIN lst ON ac.ex = lst.p),
assets AS (SELECT doc_id, CASE WHEN ghost THEN 'ghost' ELSE 'missing' END AS issue, ex AS expected_path,
  CASE WHEN ghost THEN 'invalid' WHEN CAST(submit_at AS DATE) < DATE '1998-06-01' THEN 'unrecoverable'
       ELSE 'pending' END AS repaired_status,
  CASE WHEN ghost THEN NULL ELSE raw_zip_path END AS repaired_path FROM aj WHERE ghost OR missing)"""


def _assets(spark, sf_dir, filings=None):
    return AU.asset_audit(_catalog(spark, sf_dir, filings), _listing(spark, sf_dir), AS_OF)


@register("audit_assets", with_views(f"WITH {ASSETS_SQL} SELECT * FROM assets", "v_filings"))
def q_audit_assets(spark, sf_dir):
    """M7 + J12: ghost paths and missing archives with their repaired status."""
    return _assets(spark, sf_dir)


BINS_SQL = f"""{KNOWN_STATUS_SQL},
fb AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')}, {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin_id
  FROM v_filings),
exp AS (SELECT DISTINCT fb.bin_id, fb.doc_id FROM fb JOIN known ON fb.doc_id = known.doc_id
  WHERE known.processed_status = 'success'),
act AS (SELECT DISTINCT fb.bin_id, fb.doc_id FROM (SELECT DISTINCT docid FROM v_facts) f JOIN fb ON f.docid = fb.doc_id),
bins AS (SELECT bin_id, doc_id, 'missing' AS kind FROM exp WHERE (bin_id, doc_id) NOT IN (SELECT (bin_id, doc_id) FROM act)
  UNION ALL SELECT bin_id, doc_id, 'orphan' FROM act WHERE (bin_id, doc_id) NOT IN (SELECT (bin_id, doc_id) FROM exp)
  UNION ALL SELECT DISTINCT bin_id, CAST(NULL AS VARCHAR), 'missing_bin' FROM exp
    WHERE bin_id <> 'No' AND bin_id NOT IN (SELECT bin_id FROM act))"""


def _filing_bins(spark, sf_dir, filings=None):
    f = _filings(spark, sf_dir, filings)
    return f, (f.withColumn("code", normalize_code("sec_code", "JP"))
               .select("doc_id", bin_id("edinet_code", "code", "jcn").alias("bin_id")))


def _bin_sides(spark, sf_dir, filings=None):
    f, fb = _filing_bins(spark, sf_dir, filings)
    ok = known_status(f).filter(F.col("processed_status") == "success").select("doc_id")
    expected = fb.join(ok, "doc_id")
    docs = view(spark, sf_dir, "v_facts").select(F.col("docid").alias("doc_id")).distinct()
    return expected, fb.join(docs, "doc_id")


def _bins(spark, sf_dir, filings=None):
    return AU.bin_audit(*_bin_sides(spark, sf_dir, filings))


@register("audit_bins", with_views(f"WITH {BINS_SQL} SELECT * FROM bins", "v_filings", "v_facts"))
def q_audit_bins(spark, sf_dir):
    """M8 + J11 + A4: successful documents per bin against the documents found in the bin's facts."""
    return _bins(spark, sf_dir)


@register("audit_bins_digest", with_views(f"WITH {BINS_SQL} SELECT * FROM bins", "v_filings", "v_facts"))
def q_audit_bins_digest(spark, sf_dir):
    """M8 + J11 by digests: bins whose documents agree never reach the join."""
    return D.bin_audit_by_digest(*_bin_sides(spark, sf_dir))


REPO_SQL = """repo AS (SELECT DISTINCT {path} AS p FROM v_filings, (VALUES ('zip', 3), ('pdf', 4)) k(kind, n)
  WHERE seq_number % n <> 0)"""
REPO_PATH_SQL = f"CASE WHEN kind = 'zip' THEN {Q.repo_path('doc_id', 'submit_at')} ELSE {Q.repo_path('doc_id', 'submit_at', 'pdf')} END"


def _repository(spark, sf_dir):
    """Files of the repository: some archives and PDFs are lost."""
    f = view(spark, sf_dir, "v_filings")
    kinds = [f.filter(F.col("seq_number") % n != 0).select(repo_path("doc_id", "submit_at", kind).alias("path"))
             for kind, n in (("zip", 3), ("pdf", 4))]
    return kinds[0].union(kinds[1])


@register("audit_assets_repair", with_views(f"""WITH {CATALOG_CTE}, {KNOWN_STATUS_SQL}, {REPO_SQL.format(path=REPO_PATH_SQL)},
c AS (SELECT cat.doc_id, submit_at, raw_zip_path, pdf_path, known.processed_status AS st,
  xbrl_flag AND zip_repo_path NOT IN (SELECT p FROM repo) AS zm, NOT xbrl_flag AND raw_zip_path IS NOT NULL AS zg,
  pdf_flag AND {Q.repo_path('cat.doc_id', 'submit_at', 'pdf')} NOT IN (SELECT p FROM repo) AS pm,
  NOT pdf_flag AND pdf_path IS NOT NULL AS pg FROM cat LEFT JOIN known ON cat.doc_id = known.doc_id)
SELECT doc_id, CASE WHEN NOT zg THEN raw_zip_path END AS raw_zip_path, CASE WHEN NOT pg THEN pdf_path END AS pdf_path,
  CASE WHEN (zm OR pm) AND CAST(submit_at AS DATE) < DATE '1998-06-01' THEN 'unrecoverable' WHEN zm OR pm THEN 'pending'
       WHEN zg THEN 'invalid' ELSE st END AS processed_status,
  concat_ws(', ', CASE WHEN zm THEN 'missing zip' END, CASE WHEN zg THEN 'ghost zip' END, CASE WHEN pm THEN 'missing pdf' END,
    CASE WHEN pg THEN 'ghost pdf' END) AS issues FROM c""", "v_filings"))
def q_audit_assets_repair(spark, sf_dir):
    """M7 repair: archives and PDFs against the repository; paths and statuses of every catalog row."""
    f = view(spark, sf_dir, "v_filings")
    cat = _catalog(spark, sf_dir, f).drop("processed_status").join(known_status(f), "doc_id", "left")
    return AU.repair_assets(cat, _repository(spark, sf_dir), AS_OF)


@register("audit_bins_repair_status", with_views(f"""WITH {BINS_SQL},
l AS (SELECT m.doc_id, bool_or(g.bin_id IS NOT NULL) AS whole FROM bins m LEFT JOIN (SELECT bin_id FROM bins WHERE kind = 'missing_bin') g
  ON m.bin_id = g.bin_id WHERE m.kind = 'missing' GROUP BY m.doc_id)
SELECT v.doc_id, CASE WHEN whole THEN 'pending' WHEN l.doc_id IS NULL OR submit_at IS NULL THEN known.processed_status
  WHEN CAST(submit_at AS DATE) < DATE '1998-06-01' THEN 'unrecoverable' ELSE 'pending' END AS processed_status
FROM v_filings v LEFT JOIN known ON v.doc_id = known.doc_id LEFT JOIN l ON v.doc_id = l.doc_id""", "v_filings", "v_facts"))
def q_audit_bins_repair_status(spark, sf_dir):
    """M8 repair: the status of every document after the bins were audited."""
    f = view(spark, sf_dir, "v_filings")
    cat = f.select("doc_id", "submit_at").join(known_status(f), "doc_id", "left")
    return AU.repair_bin_status(cat, _bins(spark, sf_dir, f), AS_OF).select("doc_id", "processed_status")


@register("audit_bins_repair_facts", with_views(f"""WITH {BINS_SQL}
SELECT fb.bin_id, f.docid AS doc_id, f.key, f.context_ref, f.src_part, f.src_supp FROM v_facts f JOIN fb ON f.docid = fb.doc_id
WHERE (fb.bin_id, fb.doc_id) IN (SELECT (bin_id, doc_id) FROM exp)""", "v_filings", "v_facts"))
def q_audit_bins_repair_facts(spark, sf_dir):
    """M8 repair: the facts that stay once documents foreign to their bin are purged."""
    f, fb = _filing_bins(spark, sf_dir)
    facts = view(spark, sf_dir, "v_facts").withColumnRenamed("docid", "doc_id").join(fb, "doc_id")
    return AU.purge_orphans(facts, _bins(spark, sf_dir, f)).select("bin_id", "doc_id", "key", "context_ref", "src_part", "src_supp")


DUP_SQL = """dups AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)"""


def _dups(spark, sf_dir):
    return AU.duplicate_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("audit_duplicates", f"WITH {DUP_SQL} SELECT * FROM dups")
def q_audit_duplicates(spark, sf_dir):
    """Repeated (order, line number) groups in the line table."""
    return _dups(spark, sf_dir)


@register("audit_duplicates_repair", """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def q_audit_duplicates_repair(spark, sf_dir):
    """G13 repair: one line per (order, line number) stays."""
    return AU.remove_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


def _api(f):
    s = F.col("seq_number")
    return f.select(
        "doc_id",
        F.when(s % 37 == 0, F.col("submit_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("submit_at")).alias("submit_at"),
        F.when(s % 41 == 0, F.lit("999")).otherwise(F.col("doc_type")).alias("doc_type"),
        "ordinance_code",
        F.when(s % 43 == 0, F.concat(F.lit(" "), F.col("form_code"))).otherwise(F.col("form_code")).alias("form_code"),
        F.when(s % 23 == 0, F.lit(None).cast("string")).when(s % 47 == 0, F.lit("1"))
        .otherwise(F.col("withdrawal_status")).alias("withdrawal_status"))


API_SQL = """api AS (SELECT doc_id,
  CASE WHEN seq_number % 37 = 0 THEN submit_at + INTERVAL 1 DAY ELSE submit_at END AS submit_at,
  CASE WHEN seq_number % 41 = 0 THEN '999' ELSE doc_type END AS doc_type, ordinance_code,
  CASE WHEN seq_number % 43 = 0 THEN ' ' || form_code ELSE form_code END AS form_code,
  CASE WHEN seq_number % 23 = 0 THEN NULL WHEN seq_number % 47 = 0 THEN '1' ELSE withdrawal_status END
    AS withdrawal_status FROM v_filings)"""


def _unpivot_sql(src: str, val: str) -> str:
    parts = [f"SELECT doc_id, '{f}' AS field, coalesce(trim(CAST({f} AS VARCHAR)), '') AS {val} FROM {src}"
             for f in AU.DRIFT_FIELDS]
    return " UNION ALL ".join(parts)


DRIFT_SQL = f"""{API_SQL},
lo AS ({_unpivot_sql('v_filings', 'local_value')}), ap AS ({_unpivot_sql('api', 'api_value')}),
drift AS (SELECT lo.doc_id, lo.field, local_value, api_value FROM lo JOIN ap ON lo.doc_id = ap.doc_id
  AND lo.field = ap.field WHERE local_value <> api_value AND NOT (lo.field = 'withdrawal_status'
  AND local_value IN ('', '0', 'None') AND api_value IN ('', '0', 'None')))"""


def _drift(spark, sf_dir, filings=None):
    f = _filings(spark, sf_dir, filings)
    return AU.drift(f, _api(f))


@register("audit_drift", with_views(f"WITH {DRIFT_SQL} SELECT * FROM drift", "v_filings"))
def q_audit_drift(spark, sf_dir):
    """M9 + J10: field-level drift between the catalog and the API listing."""
    return _drift(spark, sf_dir)


@register("audit_drift_digest", with_views(f"WITH {DRIFT_SQL} SELECT * FROM drift", "v_filings"))
def q_audit_drift_digest(spark, sf_dir):
    """M9 + J10 by digests of each day: days on which catalog and API agree are not joined."""
    f = view(spark, sf_dir, "v_filings")
    catalog, api = (d.withColumn("day", F.to_date("submit_at")) for d in (f, _api(f)))
    return D.drift_by_digest(catalog, api, "day")


@register("audit_drift_repair", with_views(f"""WITH {DRIFT_SQL},
fx AS (SELECT doc_id, {", ".join(f"max(CASE WHEN field = '{f}' THEN api_value END) AS fx_{f}" for f in AU.DRIFT_FIELDS)}
  FROM drift GROUP BY doc_id)
SELECT v.doc_id, {", ".join(f"coalesce(fx_{f}, CAST(v.{f} AS VARCHAR)) AS {f}" for f in AU.DRIFT_FIELDS)}
FROM v_filings v LEFT JOIN fx ON v.doc_id = fx.doc_id""", "v_filings"))
def q_audit_drift_repair(spark, sf_dir):
    """M9 repair: drifted fields take the API value."""
    f = view(spark, sf_dir, "v_filings")
    return AU.repair_drift(f.select("doc_id", *AU.DRIFT_FIELDS), AU.drift(f, _api(f)))


def catalog_schema() -> T.StructType:
    """The declared types of a catalog record."""
    other = {"submit_at": T.TimestampNTZType(), "seq_number": T.LongType(), "fiscal_year": T.LongType(), "num_months": T.LongType(),
             "is_amendment": T.BooleanType()}
    names = """doc_id jcn code company_name company_name_en company_name_kana edinet_code issuer_edinet_code subject_edinet_code
        subsidiary_edinet_code fund_code submit_at seq_number fiscal_year period_start period_end num_months accounting_standard
        doc_type title form_code ordinance_code is_amendment parent_doc_id withdrawal_status doc_info_edit_status disclosure_status
        legal_status current_report_reason xbrl_flag pdf_flag csv_flag english_flag attachment_flag raw_zip_path pdf_path
        english_path attach_path processed_status source ope_date_time zip_repo_path""".split()
    return T.StructType([T.StructField(n, T.BooleanType() if n.endswith("_flag") else other.get(n, T.StringType())) for n in names])


@register("schema_conform", with_views(f"""WITH {CATALOG_CTE}
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS title, TRY_CAST(CAST(fiscal_year AS VARCHAR) AS BIGINT) AS fiscal_year)
FROM cat""", "v_filings"))
def q_schema_conform(spark, sf_dir):
    """M6 + U4 + X4: a damaged catalog (title missing, a stray column, the
    fiscal year stored as text) conformed back to the declared schema."""
    return AU.conform(_damaged_catalog(spark, sf_dir), catalog_schema())


def _damaged_catalog(spark, sf_dir):
    return (_catalog(spark, sf_dir).drop("title").withColumn("stray", F.lit(1))
            .withColumn("fiscal_year", F.col("fiscal_year").cast("string")))


INDEX_EVENT_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType()), T.StructField("index_name", T.StringType()),
    T.StructField("code", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("old_value", T.DoubleType()), T.StructField("new_value", T.DoubleType())])


@register("audit_index_schema", with_views(f"SELECT * FROM ({_index_events_sql(24, 0.01)})", "v_index_snapshots"))
def q_audit_index_schema(spark, sf_dir):
    """The index-event history stored with text weights and an extra
    column is conformed to the event schema."""
    return AU.conform(_damaged_events(spark, sf_dir), INDEX_EVENT_SCHEMA)


def _damaged_events(spark, sf_dir):
    s = view(spark, sf_dir, "v_index_snapshots").withColumnRenamed("snap_month", "snap_date")
    ev = IX.index_events(s, min_rows=24, tol=0.01)
    return ev.withColumn("old_value", F.col("old_value").cast("string")).withColumn("note", F.lit("x"))


@register("audit_report", with_views(f"""WITH {ASSETS_SQL}, {BINS_SQL}, {DUP_SQL}, {DRIFT_SQL},
an AS (SELECT 'Layer2_Physical' AS layer, doc_id AS object_id FROM assets
  UNION ALL SELECT 'Layer3_Bins', coalesce(doc_id, bin_id) FROM bins
  UNION ALL SELECT 'Layer3_Duplicates', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) FROM dups
  UNION ALL SELECT 'Layer4_Catalog', doc_id FROM drift
  UNION ALL SELECT 'Layer1_Schema', unnest(['title missing', 'stray extra', 'fiscal_year type'])
  UNION ALL SELECT 'Layer5_Index', unnest(['note extra', 'old_value type', 'date type'])),
per AS (SELECT layer, count(*) AS n_anomalies, count(DISTINCT object_id) AS n_objects FROM an GROUP BY layer
  UNION ALL SELECT 'ALL', count(*), count(DISTINCT object_id) FROM an)
SELECT *, CASE WHEN n_anomalies = 0 THEN 'PASSED' ELSE 'REPAIRED' END AS status, n_objects AS n_repaired FROM per""",
                                    "v_filings", "v_facts"))
def q_audit_report(spark, sf_dir):
    """M11 + A12: the five audit layers in one report, run in repair mode. The
    filing table every layer reads is materialised once (reliable checkpoint
    in the shared folder), so the source is scanned once for all layers."""
    checkpoint_dir(spark)
    f = view(spark, sf_dir, "v_filings").checkpoint(eager=True)
    an = (_assets(spark, sf_dir, f).select(F.lit("Layer2_Physical").alias("layer"), F.col("doc_id").alias("object_id"))
          .unionByName(_bins(spark, sf_dir, f).select(F.lit("Layer3_Bins").alias("layer"),
                                                   F.coalesce("doc_id", "bin_id").alias("object_id")))
          .unionByName(_dups(spark, sf_dir).select(
              F.lit("Layer3_Duplicates").alias("layer"),
              F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("object_id")))
          .unionByName(_drift(spark, sf_dir, f).select(F.lit("Layer4_Catalog").alias("layer"),
                                                    F.col("doc_id").alias("object_id"))))
    for layer, df, schema in (("Layer1_Schema", _damaged_catalog(spark, sf_dir), catalog_schema()),
                              ("Layer5_Index", _damaged_events(spark, sf_dir), INDEX_EVENT_SCHEMA)):
        found = AU.schema_issues(df, schema)
        if found:
            an = an.unionByName(spark.createDataFrame([(layer, f"{c} {issue}") for c, issue in found], "layer string, object_id string"))
    return AU.audit_report(an, repair=True)


@register("asset_sample", with_views(f"""WITH {CATALOG_CTE}
SELECT doc_id, raw_zip_path FROM cat WHERE raw_zip_path IS NOT NULL ORDER BY md5(raw_zip_path), doc_id LIMIT 50""",
                                     "v_filings"))
def q_asset_sample(spark, sf_dir):
    """L3: a repeatable sample of at most 50 stored archives for the deep
    check (ordered by a hash of the path; the limit is the feature). Spark
    plans this as a distributed top-k (TakeOrderedAndProject)."""
    c = _catalog(spark, sf_dir).filter(F.col("raw_zip_path").isNotNull())
    return c.orderBy(F.md5("raw_zip_path"), "doc_id").limit(50).select("doc_id", "raw_zip_path")


@register("sorted_history", with_views(f"""SELECT * FROM ({_index_events_sql(24, 0.01)})
ORDER BY date DESC, code, index_name, type""", "v_index_snapshots"))
def q_sorted_history(spark, sf_dir):
    """L1: event history sorted by date (newest first), then code (D8: the sort is kept)."""
    s = view(spark, sf_dir, "v_index_snapshots").withColumnRenamed("snap_month", "snap_date")
    ev = IX.index_events(s, min_rows=24, tol=0.01)
    return ev.orderBy(F.col("date").desc(), "code", "index_name", "type")
