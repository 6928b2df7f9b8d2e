"""Fact-table queries over the v_facts / v_account_list adapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from kaiji.functions.codes import bin_id, normalize_code
from kaiji.operators import facts as FT
from kaiji.operators import verdict as V
from kaiji.operators.catalog import catalog_record
from kaiji.plans import sqlfrag as Q
from kaiji.plans.registry import register
from kaiji.plans.tables import table, view, with_views
from kaiji.session import work_dir
from kaiji.sinks.tables import write_table

def newest_first():
    """Total order of fact rows, newest submission first."""
    return [(-F.unix_micros(F.col("loaded_at").cast("timestamp"))), "src_part", "src_supp"]
NEWEST_SQL = "loaded_at DESC, src_part, src_supp"


def _facts(spark, sf_dir):
    return view(spark, sf_dir, "v_facts")


def _accounts(spark, sf_dir):
    return view(spark, sf_dir, "v_account_list")


@register("fact_dedupe", with_views(f"""SELECT * FROM v_facts WHERE isTextBlock_flg = 0
QUALIFY row_number() OVER (PARTITION BY docid, key, context_ref ORDER BY {NEWEST_SQL}) = 1""", "v_facts"))
def q_fact_dedupe(spark, sf_dir):
    """G2 numbers: one per (docid, key, context_ref), newest submission first."""
    f = _facts(spark, sf_dir).filter(F.col("isTextBlock_flg") == 0)
    return FT.dedupe_facts(f, ["docid", "key", "context_ref"], newest_first())


@register("text_dedupe", with_views(f"""SELECT * FROM v_facts WHERE isTextBlock_flg = 1
QUALIFY row_number() OVER (PARTITION BY docid, key ORDER BY {NEWEST_SQL}) = 1""", "v_facts"))
def q_text_dedupe(spark, sf_dir):
    """G2 text: one per (docid, key), newest submission first."""
    f = _facts(spark, sf_dir).filter(F.col("isTextBlock_flg") == 1)
    return FT.dedupe_facts(f, ["docid", "key"], newest_first())


@register("fact_bins", with_views(f"""WITH b AS (SELECT doc_id, {Q.norm_code_cols('sec_code', 'n')},
  {Q.bin_id('edinet_code', 'n_code', 'jcn')} AS bin_id FROM v_filings)
SELECT bin_id, count(*) AS n_facts, count(DISTINCT docid) AS n_docs,
  count(*) FILTER (WHERE isTextBlock_flg = 1) AS n_text FROM v_facts JOIN b ON docid = doc_id GROUP BY bin_id""",
                                   "v_facts", "v_filings"))
def q_fact_bins(spark, sf_dir):
    """P4 + K2 layout: facts routed to their filing's immutable bin, counted per bin.
    The bin is computed on the filing list first, so the fact side only
    carries (docid) into the join."""
    b = (view(spark, sf_dir, "v_filings").withColumn("code", normalize_code("sec_code", "JP"))
         .select(F.col("doc_id").alias("docid"), bin_id("edinet_code", "code", "jcn").alias("bin_id")))
    f = _facts(spark, sf_dir).join(b, "docid")
    return f.groupBy("bin_id").agg(F.count(F.lit(1)).alias("n_facts"), F.countDistinct("docid").alias("n_docs"),
                                   F.count_if(F.col("isTextBlock_flg") == 1).alias("n_text"))


FLAGS_SQL = """CAST(coalesce(contains(context_ref, 'NonConsolidated'), false) AS INTEGER) AS non_consolidated_flg,
  CAST(coalesce(contains(context_ref, 'CurrentYear'), false) AS INTEGER) AS current_flg,
  CAST(coalesce(contains(context_ref, 'Prior1Year'), false) AS INTEGER) AS prior_flg"""

LINKED_SQL = """SELECT f.*, a.role, a.label_en, a.ord FROM v_facts f JOIN v_account_list a ON f.key = a.key"""
UNLINKED_SQL = """SELECT f.*, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS VARCHAR) AS label_en, CAST(NULL AS DOUBLE) AS ord
FROM v_facts f WHERE f.key NOT IN (SELECT key FROM v_account_list)"""
TABLE_SQL = f"""SELECT * REPLACE (coalesce(label_en, regexp_extract(key, '[^:]*$')) AS label_en), {FLAGS_SQL}
FROM ({LINKED_SQL} UNION ALL {UNLINKED_SQL})"""


@register("fact_role_join", with_views(f"SELECT *, {FLAGS_SQL} FROM ({LINKED_SQL})", "v_facts", "v_account_list"))
def q_fact_role_join(spark, sf_dir):
    """J4 + P15: one row per fact and role it belongs to."""
    return FT.context_flags(FT.role_join(_facts(spark, sf_dir), _accounts(spark, sf_dir)))


@register("fact_unlinked", with_views(f"SELECT *, {FLAGS_SQL} FROM ({UNLINKED_SQL})", "v_facts", "v_account_list"))
def q_fact_unlinked(spark, sf_dir):
    """Facts in no role (zero drop)."""
    return FT.context_flags(FT.unlinked(_facts(spark, sf_dir), _accounts(spark, sf_dir)))


def _instance_label():
    return F.regexp_extract(F.col("key"), "[^:]*$", 0)


def _fact_table(spark, sf_dir):
    return FT.fact_table(_facts(spark, sf_dir), _accounts(spark, sf_dir), _instance_label())


@register("fact_table", with_views(TABLE_SQL, "v_facts", "v_account_list"))
def q_fact_table(spark, sf_dir):
    """M4 core: linked + unlinked facts, flags, label fallback."""
    return _fact_table(spark, sf_dir)


@register("fact_quality", with_views(f"""WITH t AS ({TABLE_SQL}),
p AS (SELECT docid, count(*) AS n_rows, count(*) FILTER (WHERE role IS NOT NULL) AS n_matched,
  count(*) FILTER (WHERE role IS NULL) AS n_unlinked, count(*) FILTER (WHERE label_en IS NOT NULL) AS n_labelled,
  count(*) FILTER (WHERE isTextBlock_flg = 1) AS n_text, count(*) FILTER (WHERE isTextBlock_flg <> 1) AS n_number
  FROM t GROUP BY docid),
r AS (SELECT key, count(*) AS n_roles FROM v_account_list GROUP BY key),
s AS (SELECT docid, count(*) AS n_facts, sum(coalesce(n_roles, 1))::BIGINT AS n_expected
  FROM v_facts f LEFT JOIN r ON f.key = r.key GROUP BY docid)
SELECT p.*, s.n_facts, s.n_expected, round(n_labelled / n_rows, 6) AS label_rate, n_labelled / n_rows < 0.5 AS label_alert,
  n_matched + n_unlinked = n_expected AS balanced FROM p LEFT JOIN s ON p.docid = s.docid""", "v_facts", "v_account_list"))
def q_fact_quality(spark, sf_dir):
    """A5 + A6 + A7 per document."""
    return FT.fact_quality(_fact_table(spark, sf_dir), _facts(spark, sf_dir), _accounts(spark, sf_dir))


@register("day_folder_load", with_views(f"""WITH c AS (SELECT {Q.repo_path('doc_id', 'submit_at')} AS p FROM v_filings)
SELECT regexp_extract(p, '^(.*/day=[^/]+)/', 1) AS folder, count(*) AS n_files FROM c
WHERE regexp_extract(p, '^(.*/day=[^/]+)/', 1) <> '' GROUP BY 1 HAVING count(*) > 12""", "v_filings"))
def q_day_folder_load(spark, sf_dir):
    """Day folders holding more than 12 archives (fixture threshold)."""
    return FT.day_folder_load(catalog_record(view(spark, sf_dir, "v_filings")), limit=12)


DOMAIN_RULES = {"doc_type": ("120", "130", "140", "150", "160", "170", "180", "190", "361"),
                "withdrawal_status": ("0", "1", "2"), "doc_info_edit_status": ("0", "1", "2", "3"),
                "xbrl_flag": ("0", "1")}


@register("domain_checks", with_views("""SELECT CASE
  WHEN NOT coalesce(doc_type IN ('120','130','140','150','160','170','180','190','361'), false) THEN 'bad_doc_type'
  WHEN NOT coalesce(withdrawal_status IN ('0','1','2'), false) THEN 'bad_withdrawal_status'
  WHEN NOT coalesce(doc_info_edit_status IN ('0','1','2','3'), false) THEN 'bad_doc_info_edit_status'
  WHEN NOT coalesce(xbrl_flag IN ('0','1'), false) THEN 'bad_xbrl_flag' END AS reject_reason,
  reject_reason IS NULL AS is_valid, count(*) AS n FROM v_filings GROUP BY ALL""", "v_filings"))
def q_domain_checks(spark, sf_dir):
    """validity per record with the first failing rule; counted."""
    d = V.domain_checks(view(spark, sf_dir, "v_filings"), DOMAIN_RULES)
    return d.groupBy("reject_reason", "is_valid").agg(F.count(F.lit(1)).alias("n"))


def _rule_sql(column, values, null_passes):
    allowed = ", ".join(f"'{v}'" for v in values)
    return f"NOT coalesce(CAST({column} AS VARCHAR) IN ({allowed}), {null_passes})"


def _reasons_sql(rules) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {_rule_sql(*r)} THEN '{r[0]}' END" for r in rules) + ")"


def _rule_counts_sql(rules, src: str) -> str:
    return " UNION ALL ".join(f"SELECT '{r[0]}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {_rule_sql(*r)}) AS n_broken FROM {src}"
                              for r in rules)


def _rule_counts(spark, rules, metrics):
    return spark.createDataFrame([(c, metrics["rows"], metrics[c]) for c, _, _ in rules], "rule string, n_rows long, n_broken long")


FILING_CHECKED = ["doc_id", *[c for c, _, _ in V.FILING_RULES]]
FACT_CHECKED = ["docid", "key", "context_ref", "src_part", "src_supp", *[c for c, _, _ in V.FACT_RULES]]
# Fixture flags, some out of their domain, in the same text for both engines.
FACT_FLAGS = {"current_flg": "CASE WHEN src_supp % 31 = 0 THEN 2 WHEN src_supp % 7 = 0 THEN NULL ELSE src_supp % 2 END",
              "non_consolidated_flg": "CASE WHEN src_part % 37 = 0 THEN -1 ELSE src_part % 2 END",
              "prior_flg": "CASE WHEN src_supp % 7 = 0 THEN NULL ELSE src_part % 2 END",
              "abstract_flg": "CASE WHEN src_part % 41 = 0 THEN 10 ELSE 0 END",
              "period_type": "CASE WHEN src_part % 23 = 0 THEN 'forever' WHEN src_part % 29 = 0 THEN NULL "
                             "WHEN src_part % 2 = 0 THEN 'instant' ELSE 'duration' END"}
FACT_FLAGS_SQL = ("SELECT docid, key, context_ref, src_part, src_supp, isTextBlock_flg, "
                  + ", ".join(f"{e} AS {c}" for c, e in FACT_FLAGS.items()) + " FROM v_facts")


def _split_filings(spark, sf_dir):
    return V.split_by_rules(view(spark, sf_dir, "v_filings").select(*FILING_CHECKED), V.FILING_RULES, work_dir(spark, "filing-rules"))


def _split_facts(spark, sf_dir):
    facts = _facts(spark, sf_dir).select("docid", "key", "context_ref", "src_part", "src_supp", "isTextBlock_flg",
                                         *[F.expr(e).alias(c) for c, e in FACT_FLAGS.items()])
    return V.split_by_rules(facts.select(*FACT_CHECKED), V.FACT_RULES, work_dir(spark, "fact-rules"))


def _sides_sql(src: str, rules, columns) -> str:
    return f"SELECT {', '.join(columns)}, {_reasons_sql(rules)} AS broken_rules FROM {src}"


def _sides(good, rejects):
    return good.withColumn("broken_rules", F.lit("")).unionByName(rejects.withColumn("broken_rules", F.concat_ws(",", "broken_rules")))


@register("filing_rules", with_views(_sides_sql("v_filings", V.FILING_RULES, FILING_CHECKED), "v_filings"))
def q_filing_rules(spark, sf_dir):
    """good filings, and rejects with every rule that they break."""
    good, rejects, _ = _split_filings(spark, sf_dir)
    return _sides(good, rejects)


@register("filing_rule_counts", with_views(_rule_counts_sql(V.FILING_RULES, "v_filings"), "v_filings"))
def q_filing_rule_counts(spark, sf_dir):
    """breaks of each rule, observed by the write that splits the filings."""
    return _rule_counts(spark, V.FILING_RULES, _split_filings(spark, sf_dir)[2])


@register("fact_rules", with_views(_sides_sql(f"({FACT_FLAGS_SQL})", V.FACT_RULES, FACT_CHECKED), "v_facts"))
def q_fact_rules(spark, sf_dir):
    """F13 over fact flags and period type: good facts, and rejects with every rule that they break."""
    good, rejects, _ = _split_facts(spark, sf_dir)
    return _sides(good, rejects)


@register("fact_rule_counts", with_views(_rule_counts_sql(V.FACT_RULES, f"({FACT_FLAGS_SQL})"), "v_facts"))
def q_fact_rule_counts(spark, sf_dir):
    """breaks of each fact rule, observed by the write that splits the facts."""
    return _rule_counts(spark, V.FACT_RULES, _split_facts(spark, sf_dir)[2])


@register("fact_impute", with_views("""SELECT docid, key, context_ref, data_str, decimals,
  TRY_CAST(data_str AS DOUBLE) AS data, len(string_split(context_ref, '_')) AS context_ref_len,
  CASE WHEN data IS NULL THEN 0.0 WHEN data = 0 THEN 0.5 * pow(10.0, -TRY_CAST(decimals AS DOUBLE)) ELSE data END
    AS data_imputed FROM v_facts""", "v_facts"))
def q_fact_impute(spark, sf_dir):
    """P16 + P17 + P18 over all facts."""
    return FT.numeric_prep(_facts(spark, sf_dir)).select(
        "docid", "key", "context_ref", "data_str", "decimals", "data", "context_ref_len", "data_imputed")


# Fixture columns with gaps, in the same text for both engines.
GAPS = {
    "decimals": "CASE WHEN src_part % 4 <> 0 THEN CAST(src_part % 4 AS STRING) END",
    "precision": "CASE WHEN src_supp % 3 <> 0 THEN CAST(src_supp % 5 AS STRING) END",
    "context_ref": "CASE WHEN src_part % 6 <> 0 THEN context_ref END",
    "unit": "CASE WHEN src_supp % 2 <> 0 THEN concat('U', CAST(src_part % 3 AS STRING)) END",
    "period_start": "CASE WHEN src_part % 5 <> 0 THEN concat(CAST(2000 + src_part % 20 AS STRING), '-04-01') END",
    "period_end": "CASE WHEN src_part % 7 <> 0 THEN concat(CAST(2001 + src_part % 20 AS STRING), '-03-31') END",
    "instant_date": "CASE WHEN src_part % 5 = 0 THEN concat(CAST(2001 + src_part % 20 AS STRING), '-03-31') END",
    "non_consolidated_flg": "CASE WHEN src_part % 6 <> 0 THEN non_consolidated_flg END",
    "current_flg": "CASE WHEN src_part % 6 <> 0 THEN current_flg END",
    "prior_flg": "CASE WHEN src_part % 6 <> 0 THEN prior_flg END",
    "filer_name": "CASE WHEN src_supp % 4 <> 0 THEN concat('Filer ', CAST(src_supp % 10 AS STRING)) END",
    "sector_label_33": "CASE WHEN src_supp % 4 = 1 THEN concat('Sector ', CAST(src_supp % 33 AS STRING)) END",
    "element_name": "CASE WHEN src_part % 3 <> 0 THEN concat('El', CAST(src_part % 9 AS STRING)) END",
    "isTextBlock_flg": "CASE WHEN src_supp % 5 <> 0 THEN isTextBlock_flg END",
    "abstract_flg": "CASE WHEN src_part % 8 <> 0 THEN src_part % 2 END",
    "label_jp": "CASE WHEN src_part % 2 <> 0 THEN concat('Label ', CAST(src_part % 12 AS STRING)) END",
}
GAPS_SQL = ", ".join(f'{e} AS "{c}"' for c, e in GAPS.items())


def _last(cols, by: str) -> str:
    return ", ".join(f'last_value("{c}" IGNORE NULLS) OVER {by} AS "{c}"' for c in cols)


@register("fact_ffill", with_views(f"""WITH g AS (SELECT docid, key, src_part, src_supp, loaded_at, context_ref AS ctx, role,
  role AS r0, ord AS "order", TRY_CAST(data_str AS DOUBLE) AS data, {GAPS_SQL} FROM ({TABLE_SQL})),
a AS (SELECT docid, key, src_part, src_supp, loaded_at, ctx, r0, data, {_last(FT.FILL_BY_DOCUMENT, "w")},
  {", ".join(FT.FILL_BY_KEY)} FROM g WINDOW w AS (PARTITION BY docid ORDER BY data NULLS LAST, key, ctx, src_part, src_supp, loaded_at,
  r0 NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT docid, key, src_part, src_supp, data, {", ".join(f'"{c}"' for c in FT.FILL_BY_DOCUMENT)}, {_last(FT.FILL_BY_KEY, "w")} FROM a
  WINDOW w AS (PARTITION BY key ORDER BY data NULLS LAST, docid, ctx, src_part, src_supp, loaded_at, r0 NULLS LAST
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "v_facts", "v_account_list"))
def q_fact_ffill(spark, sf_dir):
    """Fourteen columns carried forward in value order within a document (D12), then four within a key."""
    def stage(df):
        path = work_dir(spark, "ffill")
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)

    t = _fact_table(spark, sf_dir)
    t = t.select("docid", "key", "src_part", "src_supp", "loaded_at", F.col("context_ref").alias("ctx"), "role", F.col("role").alias("r0"),
                 F.col("ord").alias("order"), F.col("data_str").try_cast("double").alias("data"),
                 *[F.expr(e).alias(c) for c, e in GAPS.items()])
    t = t.withColumn("_dn", F.col("data").isNull()).withColumn("_rn", F.col("r0").isNull())
    rest = ["ctx", "src_part", "src_supp", "loaded_at", "_rn", "r0"]
    # neither fill changes what the other one reads, so the second takes its borders from the table as well
    sample = stage(FT.range_sample(t, ["docid", "key", "_dn", "data", *rest]))
    by_doc = FT.fill_forward_ranges(t, "docid", ["_dn", "data", "key", *rest], list(FT.FILL_BY_DOCUMENT), stage, sample=sample)
    t = FT.fill_forward_ranges(by_doc, "key", ["_dn", "data", "docid", *rest], list(FT.FILL_BY_KEY), stage, t, sample)
    return t.select("docid", "key", "src_part", "src_supp", "data", *FT.FILL_BY_DOCUMENT, *FT.FILL_BY_KEY)


STD_KEY = "jppfs_cor:Acct7"


@register("accounting_standard", with_views(f"""WITH s AS (SELECT docid, arg_min(data_str, (-epoch_us(loaded_at),
  src_part, src_supp)) AS accounting_standard FROM v_facts WHERE key = '{STD_KEY}' GROUP BY docid)
SELECT doc_id, accounting_standard FROM v_filings LEFT JOIN s ON doc_id = docid""", "v_facts", "v_filings"))
def q_accounting_standard(spark, sf_dir):
    """The value of a document's standard fact copied onto its catalog row."""
    cat = view(spark, sf_dir, "v_filings").select("doc_id")
    return FT.accounting_standard(_facts(spark, sf_dir), cat, STD_KEY, newest_first())


_FAMS = "[" + ", ".join(f"'{f}'" for f in FT.TAXONOMY_FAMILIES) + "]"
_MARKS = "[" + ", ".join(f"'{p}'" for p, _ in FT.TAXONOMY_DATES) + "]"
_PAT_SQL = " UNION ALL ".join(f"SELECT {i} AS pat_rank, '{p}' AS marker, '{y}' AS year"
                              for i, (p, y) in enumerate(FT.TAXONOMY_DATES))
_FAM_SQL = " UNION ALL ".join(f"SELECT {i} AS fam_rank, '{f}' AS family" for i, f in enumerate(FT.TAXONOMY_FAMILIES))


def _heads(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    fams = F.array(*[F.lit(x) for x in FT.TAXONOMY_FAMILIES])
    marks = F.array(*[F.lit(p) for p, _ in FT.TAXONOMY_DATES])
    k = F.col("s_suppkey")

    def head(fi, mi):
        return F.concat(F.lit("http://example.org"), F.element_at(fams, (fi % 6 + 1).cast("int")), F.lit("/"),
                        F.element_at(marks, (mi % 24 + 1).cast("int")), F.lit("/schema.xsd"))
    other = F.lit("http://example.org/other/1999-01-01/schema.xsd")
    hs = F.when(k % 5 == 0, F.array(other)).otherwise(F.array(head(k, k), head(k + 3, k * 7)))
    return s.select(k.alias("doc"), F.explode(hs).alias("head"))


@register("taxonomy_year", f"""WITH h AS (SELECT s_suppkey AS doc, UNNEST(CASE WHEN s_suppkey % 5 = 0
  THEN ['http://example.org/other/1999-01-01/schema.xsd']
  ELSE ['http://example.org' || {_FAMS}[s_suppkey % 6 + 1] || '/' || {_MARKS}[s_suppkey % 24 + 1] || '/schema.xsd',
        'http://example.org' || {_FAMS}[(s_suppkey + 3) % 6 + 1] || '/' || {_MARKS}[(s_suppkey * 7) % 24 + 1]
        || '/schema.xsd'] END) AS head FROM supplier),
fam AS ({_FAM_SQL}), pat AS ({_PAT_SQL}),
hits AS (SELECT doc, arg_min(year, (fam_rank, pat_rank, head)) AS y FROM h
  JOIN fam ON contains(head, family) JOIN pat ON contains(head, marker) GROUP BY doc)
SELECT d.doc, coalesce(y, '-') AS taxonomy_year FROM (SELECT DISTINCT doc FROM h) d LEFT JOIN hits ON d.doc = hits.doc""")
def q_taxonomy_year(spark, sf_dir):
    """G11 over generated schema heads of every supplier (as a document)."""
    return FT.taxonomy_year(_heads(spark, sf_dir))
