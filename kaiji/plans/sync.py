"""The full company-master sync (M1): all steps over master, code list, exchange list and aggregation list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaiji.functions.codes import listed_flag, yes_no_flag
from kaiji.operators import master as M
from kaiji.plans import sqlfrag as Q
from kaiji.plans.master import AS_OF, RANK_SQL, _defs_sql
from kaiji.plans.registry import register
from kaiji.plans.tables import view, with_views
from kaiji.session import work_dir
from kaiji.sinks.tables import write_table

MASTER_COLS = ["identity_key", "code", *M.GOLDEN_ATTRIBUTES, "last_submitted_at", "is_listed_edinet", "is_active", "is_disappeared"]


def _stage(df: DataFrame) -> DataFrame:
    path = work_dir(df.sparkSession, "sync")
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sync(spark, sf_dir):
    current = view(spark, sf_dir, "v_sync_master")
    listed = view(spark, sf_dir, "v_sync_list").select(
        "*", yes_no_flag("consolidated_mark").alias("is_consolidated"), listed_flag("listed_mark").alias("is_listed_edinet"))
    old = (M.definition_collect(current.filter(F.col("pos") % 2 == 0))
           .withColumn("valid_from", F.lit("2024-01-01")).withColumn("valid_to", F.lit(None).cast("string")))
    return M.sync_master(current, listed, view(spark, sf_dir, "v_sync_exchange"), view(spark, sf_dir, "v_sync_agg"), old, AS_OF, _stage)


# ---------------------------------------------------------------- oracle
ATTRS = [*M.GOLDEN_ATTRIBUTES, "last_submitted_at", "is_listed_edinet"]
LIST_COLS = {"edinet_code", "code", "jcn", "company_name", "company_name_en", "company_name_kana", "former_edinet_codes", "submitter_type",
             "capital", "settlement_date", "address", "industry_edinet", "industry_edinet_en"}
EXCHANGE_COLS = {"code", "company_name", "market", "sector_jpx_33", "sector_33_code", "sector_jpx_17", "sector_17_code", "size_code",
                 "size_category"}


def _pick(have: set[str], special: dict[str, str]) -> str:
    return ", ".join(f"{special.get(c, c if c in have else 'NULL')} AS {c}" for c in ["code", *ATTRS])


def _former(src: str) -> str:
    both = """list_concat(CASE WHEN former_edinet_codes IS NULL OR lower(trim(former_edinet_codes)) IN ('', 'none', 'nan') THEN []
  ELSE list_filter(list_transform(string_split(former_edinet_codes, ','), lambda x: trim(x)), lambda x: x <> '') END, inv.olds)"""
    return f"""SELECT t.* EXCLUDE (merged, new_code) REPLACE (CASE WHEN new_code IS NULL THEN former_edinet_codes
  ELSE array_to_string(list_filter(merged, lambda x, i: list_position(merged, x) = i), ',') END AS former_edinet_codes)
  FROM (SELECT s.*, inv.new_code, {both} AS merged FROM {src} s LEFT JOIN inv ON s.edinet_code = inv.new_code) t"""


def _sentinel(c: str) -> str:
    return f"CASE WHEN lower({Q.strip(c)}) IN ('nan', 'none', '', '-') THEN NULL ELSE {Q.strip(c)} END AS {c}"


def _states_sql() -> str:
    marks = {"is_consolidated": "CASE trim(consolidated_mark) WHEN '有' THEN true WHEN '無' THEN false END",
             "is_listed_edinet": "coalesce(listed_mark = '上場', false)"}
    inherited = [c for c in ATTRS if c != "parent_code"]
    return f"""inv AS (SELECT new_code, list(old_code ORDER BY pos) AS olds FROM v_sync_agg GROUP BY new_code),
cur AS ({_former("v_sync_master")}),
lst AS ({_former("v_sync_list")}),
inc0 AS (SELECT {_pick(LIST_COLS, marks)}, false AS source_jpx, (1::BIGINT << 40) + pos AS pos FROM lst
  UNION ALL BY NAME SELECT {_pick(EXCHANGE_COLS, {})}, true AS source_jpx, (2::BIGINT << 40) + pos AS pos FROM v_sync_exchange),
rev AS (SELECT n_code AS c, arg_max(edinet_code, pos) AS e FROM
  (SELECT edinet_code, pos, {Q.norm_code_cols('code', 'n')} FROM v_sync_list) WHERE n_code IS NOT NULL GROUP BY n_code),
bf AS (SELECT inc0.* REPLACE (coalesce(edinet_code, rev.e) AS edinet_code) FROM inc0 LEFT JOIN rev ON inc0.code = rev.c),
kept AS (SELECT * FROM bf WHERE contains(upper(coalesce(market, '')), 'ETF') OR contains(upper(coalesce(market, '')), 'REIT')
  OR contains(upper(coalesce(market, '')), 'PRO MARKET') OR (coalesce(code, '') <> '' AND right(code, 1) <> '0')
  OR edinet_code IS NOT NULL),
nrm AS (SELECT kept.* EXCLUDE (code, parent_code), {Q.norm_code_cols('code', 'n')} FROM kept),
run AS (SELECT DISTINCT unnest([jcn, edinet_code, n_code]) AS id FROM nrm),
mf AS (SELECT code, {", ".join(f"arg_min_null({c}, pos) AS {c}" for c in ATTRS)} FROM cur WHERE code IS NOT NULL GROUP BY code),
inh AS (SELECT nrm.n_code AS code, nrm.pos, nrm.source_jpx,
  coalesce(CASE WHEN right(n_code, 1) <> '0' THEN 'JP:' || left(regexp_extract(n_code, '[^:]*$'), 4) || '0' END, mf.parent_code) AS parent_code,
  {", ".join(f"coalesce(nrm.{c}, mf.{c}) AS {c}" for c in inherited)} FROM nrm LEFT JOIN mf ON nrm.n_code = mf.code),
inc AS (SELECT inh.* REPLACE ({", ".join(_sentinel(c) for c in M.SENTINEL_ATTRIBUTES)},
  coalesce(is_listed_edinet, false) AS is_listed_edinet) FROM inh),
states AS (SELECT code, {", ".join(ATTRS)}, false AS source_jpx, 0 AS priority, pos FROM cur
  UNION ALL BY NAME SELECT code, {", ".join(ATTRS)}, source_jpx, 1 AS priority, pos FROM inc
  WHERE company_name IS NOT NULL AND coalesce(edinet_code, code) IS NOT NULL),
s0 AS (SELECT *, coalesce(edinet_code, code, jcn) AS ik FROM states WHERE coalesce(edinet_code, code, jcn) IS NOT NULL)"""


def _sync_sql() -> str:
    rank, steps = RANK_SQL.format(x="ik"), []
    for i, key in enumerate(("jcn", "edinet_code", "code", "ik")):
        steps.append(f"""s{i + 1} AS (SELECT s{i}.* REPLACE (coalesce(c.canon, s{i}.ik) AS ik) FROM s{i} LEFT JOIN
  (SELECT {key} AS g, arg_min(ik, ({rank}, pos)) AS canon FROM s{i} WHERE {key} IS NOT NULL GROUP BY {key}) c ON s{i}.{key} = c.g)""")
    order = "(last_submitted_at IS NOT NULL, last_submitted_at, priority, -pos)"
    joined = ",\n".join(steps)
    return f"""{_states_sql()},
{joined},
gold AS (SELECT ik AS identity_key, arg_max_null(code, {order}) AS code, arg_max_null(last_submitted_at, {order}) AS last_submitted_at,
  {", ".join(f"arg_max({a}, {order}) FILTER (WHERE {a} IS NOT NULL) AS {a}" for a in M.GOLDEN_ATTRIBUTES)},
  bool_or(coalesce(is_listed_edinet, false)) AS any_listed,
  bool_or(edinet_code IS NOT NULL) AND count(is_listed_edinet) > 0 AND NOT any_listed AS unlisted,
  NOT unlisted AND (any_listed OR bool_or(coalesce(source_jpx, false))) AS active FROM s4 GROUP BY ik),
new0 AS (SELECT * EXCLUDE (any_listed, unlisted), any_listed AS is_listed_edinet,
  identity_key IN (SELECT identity_key FROM cur WHERE identity_key IS NOT NULL)
    AND identity_key NOT IN (SELECT id FROM run WHERE id IS NOT NULL) AS is_disappeared FROM gold),
new AS (SELECT * EXCLUDE (active), active AND NOT is_disappeared AS is_active FROM new0),
defs AS ({_defs_sql("(SELECT *, identity_key AS pos FROM new)")})"""


SYNC_VIEWS = ("v_sync_master", "v_sync_list", "v_sync_exchange", "v_sync_agg")


@register("master_sync", with_views(f"""WITH {_sync_sql()}
SELECT {", ".join("m." + c for c in MASTER_COLS if c not in ("sector_jpx_33", "sector_jpx_17", "size_category"))},
  coalesce(d1.name, m.sector_jpx_33) AS sector_jpx_33, coalesce(d2.name, m.sector_jpx_17) AS sector_jpx_17,
  coalesce(d3.name, m.size_category) AS size_category FROM new m
LEFT JOIN (SELECT * FROM defs WHERE type = 'sector_33') d1 ON m.sector_33_code = d1.code
LEFT JOIN (SELECT * FROM defs WHERE type = 'sector_17') d2 ON m.sector_17_code = d2.code
LEFT JOIN (SELECT * FROM defs WHERE type = 'size') d3 ON m.size_code = d3.code""", *SYNC_VIEWS))
def q_master_sync(spark, sf_dir):
    """M1: the new master, one row per identity with all 21 attributes, after every step of the sync."""
    return _sync(spark, sf_dir)[0].select(*MASTER_COLS)


@register("master_sync_events", with_views(f"""WITH {_sync_sql()},
old AS (SELECT code AS k, arg_min_null(is_active, pos) AS was FROM cur WHERE code IS NOT NULL GROUP BY code)
SELECT DISTINCT code, CASE WHEN k IS NULL THEN CASE WHEN is_active THEN 'LISTING' END
  WHEN coalesce(was, true) AND NOT is_active THEN 'DELISTING' WHEN NOT coalesce(was, true) AND is_active THEN 'LISTING' END AS type,
  '{AS_OF}' AS event_date FROM new LEFT JOIN old ON code = k WHERE code IS NOT NULL AND type IS NOT NULL""", *SYNC_VIEWS))
def q_master_sync_events(spark, sf_dir):
    """M1, M3: the listing events of the same run."""
    return _sync(spark, sf_dir)[1]


@register("master_sync_definitions", with_views(f"""WITH {_sync_sql()},
old AS ({_defs_sql("(SELECT * FROM v_sync_master WHERE pos % 2 = 0)")}),
j AS (SELECT coalesce(o.type, i.type) AS type, coalesce(o.code, i.code) AS code, o.code IS NOT NULL AS known, o.name, i.name AS new_name
  FROM old o FULL OUTER JOIN defs i ON o.type = i.type AND o.code = i.code)
SELECT type, code, name, '2024-01-01' AS valid_from, CASE WHEN name <> new_name THEN '2024-05-31' END AS valid_to FROM j WHERE known
UNION ALL SELECT type, code, new_name, '{AS_OF}', NULL FROM j WHERE NOT known OR name <> new_name""", *SYNC_VIEWS))
def q_master_sync_definitions(spark, sf_dir):
    """The definitions after the same run, changed names closed and opened again."""
    return _sync(spark, sf_dir)[2]
