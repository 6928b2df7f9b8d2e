"""Company-master queries (identity, golden record, lifecycle, definitions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kaiji.functions.codes import normalize_code
from kaiji.operators import master as M
from kaiji.operators.graph import split_identities
from kaiji.plans import sqlfrag as Q
from kaiji.plans.registry import register
from kaiji.plans.tables import table, view, with_views

# ---------------------------------------------------------------- fixtures


def _entities(spark, sf_dir):
    return view(spark, sf_dir, "v_entities").withColumn(
        "pos", F.col("priority").cast("bigint") * 1000000000 + F.col("ordinal"))


RANK_SQL = "CASE WHEN length({x}) = 13 AND regexp_full_match({x}, '[0-9]+') THEN 0 WHEN starts_with({x}, 'E') THEN 1 ELSE 2 END"


def _identity_sql() -> str:
    rk = RANK_SQL.format(x="ik")
    steps = ["s0 AS (SELECT *, priority * 1000000000 + ordinal AS pos, coalesce(edinet_code, code, jcn) AS ik "
             "FROM v_entities WHERE coalesce(edinet_code, code, jcn) IS NOT NULL)"]
    prev = "s0"
    for i, key in enumerate(("jcn", "edinet_code", "code", "ik"), start=1):
        steps.append(f"""s{i} AS (SELECT {prev}.* EXCLUDE (ik), coalesce(c.canon, {prev}.ik) AS ik FROM {prev}
  LEFT JOIN (SELECT {key} AS g, arg_min(ik, ({rk}, pos)) AS canon FROM {prev} WHERE {key} IS NOT NULL GROUP BY {key}) c
  ON {prev}.{key} = c.g)""")
        prev = f"s{i}"
    return ",\n".join(steps) + ",\nids AS (SELECT * FROM s4)"


IDS_SQL = _identity_sql()


@register("identity_keys", with_views(f"WITH {IDS_SQL} SELECT ordinal, priority, ik AS identity_key FROM ids",
                                      "v_entities"))
def q_identity_keys(spark, sf_dir):
    """G6 + F12: canonical identity of every row with at least one identifier."""
    return M.identity_keys(_entities(spark, sf_dir)).select("ordinal", "priority", "identity_key")


@register("split_identities", with_views(f"""WITH RECURSIVE {IDS_SQL},
n AS (SELECT ik, list_filter(['0:' || jcn, '1:' || edinet_code, '2:' || code], lambda x: x IS NOT NULL) AS ks FROM ids),
e AS (SELECT DISTINCT ks[1] AS u, unnest(ks) AS v FROM n), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (SELECT DISTINCT u AS node, u AS root FROM b UNION
  SELECT b.v, reach.root FROM reach JOIN b ON reach.node = b.u WHERE reach.root < b.v),
g AS (SELECT r.root AS group_key, n.ik AS identity_key, count(*) AS n_records FROM n
  JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON n.ks[1] = r.node GROUP BY 1, 2)
SELECT *, count(*) OVER (PARTITION BY group_key) AS n_identities FROM g QUALIFY n_identities > 1""", "v_entities"))
def q_split_identities(spark, sf_dir):
    """M1 check: records that their keys connect, over any chain, but that the ordered passes of G6 leave apart."""
    return split_identities(M.identity_keys(_entities(spark, sf_dir)))


@register("null_identity", with_views("""SELECT count(*) FILTER (WHERE coalesce(edinet_code, code, jcn) IS NULL)
  AS n_without_identity FROM v_entities""", "v_entities"))
def q_null_identity(spark, sf_dir):
    """rows without any identifier."""
    return M.null_identity_count(_entities(spark, sf_dir))


GOLD_ATTRS = list(M.GOLDEN_ATTRIBUTES)
ORDER_SQL = "(last_submitted_at IS NOT NULL, last_submitted_at, priority, -pos)"
GOLD_SQL = f"""gold AS (SELECT ik AS identity_key,
  arg_max_null(ordinal, {ORDER_SQL}) AS ordinal, arg_max_null(code, {ORDER_SQL}) AS code,
  arg_max_null(last_submitted_at, {ORDER_SQL}) AS last_submitted_at,
  {", ".join(f"arg_max({a}, {ORDER_SQL}) FILTER (WHERE {a} IS NOT NULL) AS {a}" for a in GOLD_ATTRS)},
  bool_or(coalesce(is_listed_edinet, false)) AS is_listed_edinet,
  CASE WHEN bool_or(edinet_code IS NOT NULL) AND count(is_listed_edinet) > 0
       AND NOT bool_or(coalesce(is_listed_edinet, false)) THEN false
       ELSE bool_or(coalesce(is_listed_edinet, false)) OR bool_or(coalesce(source_jpx, false)) END AS is_active,
  count(*) AS n_rows FROM ids GROUP BY ik)"""
GOLD_COLS = ["identity_key", "ordinal", "code", *GOLD_ATTRS, "last_submitted_at", "is_listed_edinet", "is_active", "n_rows"]


def _golden(spark, sf_dir):
    return M.golden_record(M.identity_keys(_entities(spark, sf_dir)), GOLD_ATTRS)


@register("golden_record", with_views(f"WITH {IDS_SQL}, {GOLD_SQL} SELECT {', '.join(GOLD_COLS)} FROM gold",
                                      "v_entities"))
def q_golden_record(spark, sf_dir):
    """G6 -> G5 -> A10: one master row per identity with all 21 attributes."""
    return _golden(spark, sf_dir).select(*GOLD_COLS)


@register("activity_flags", with_views(f"""WITH {IDS_SQL}, {GOLD_SQL}
SELECT identity_key, is_listed_edinet, is_active, n_rows FROM gold""", "v_entities"))
def q_activity_flags(spark, sf_dir):
    """A10: listed / active flags per identity."""
    return _golden(spark, sf_dir).select("identity_key", "is_listed_edinet", "is_active", "n_rows")


def _code_list(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("E"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("edinet_code"),
                    F.when(F.col("c_custkey") % 4 != 0, F.lpad((F.col("c_custkey") % 700).cast("string"), 4, "0"))
                    .alias("code"), F.col("c_custkey").alias("pos"), "c_nationkey")


CODE_LIST_SQL = """cl AS (SELECT 'E' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS edinet_code,
  CASE WHEN c_custkey % 4 <> 0 THEN lpad(CAST(c_custkey % 700 AS VARCHAR), 4, '0') END AS code,
  c_custkey AS pos, c_nationkey FROM customer)"""


def _exchange(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("pos"),
        F.concat(F.lit("JP:"), F.lpad((k % 700).cast("string"), 4, "0"),
                 F.when(k % 7 == 0, F.lit("1")).otherwise(F.lit("0"))).alias("code"),
        F.when(F.col("p_size") % 10 == 0, "ETF").when(F.col("p_size") % 10 == 1, "PRO Market")
        .when(F.col("p_size") % 10 == 2, "J-REIT").when(k % 4 == 0, F.lit(None).cast("string"))
        .otherwise("Prime").alias("market"),
        F.when(k % 3 == 0, F.concat(F.lit("E"), F.lpad(k.cast("string"), 5, "0"))).alias("edinet_code"),
        F.when(k % 5 != 0, F.col("p_name")).alias("company_name"))


EXCHANGE_SQL = """ex AS (SELECT p_partkey AS pos,
  'JP:' || lpad(CAST(p_partkey % 700 AS VARCHAR), 4, '0') || CASE WHEN p_partkey % 7 = 0 THEN '1' ELSE '0' END AS code,
  CASE WHEN p_size % 10 = 0 THEN 'ETF' WHEN p_size % 10 = 1 THEN 'PRO Market' WHEN p_size % 10 = 2 THEN 'J-REIT'
       WHEN p_partkey % 4 = 0 THEN NULL ELSE 'Prime' END AS market,
  CASE WHEN p_partkey % 3 = 0 THEN 'E' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS edinet_code,
  CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS company_name FROM part)"""

REV_SQL = f"""rev AS (SELECT n_code AS c, arg_max(edinet_code, pos) AS e FROM
  (SELECT edinet_code, pos, {Q.norm_code_cols('code', 'n')} FROM cl) WHERE n_code IS NOT NULL GROUP BY n_code),
bf AS (SELECT ex.pos, ex.code, coalesce(ex.edinet_code, rev.e) AS edinet_code, ex.market, ex.company_name
  FROM ex LEFT JOIN rev ON ex.code = rev.c)"""


@register("bridge_fill", f"WITH {CODE_LIST_SQL}, {EXCHANGE_SQL}, {REV_SQL} SELECT pos, code, edinet_code FROM bf")
def q_bridge_fill(spark, sf_dir):
    """Exchange rows without an EDINET code take it from the code list."""
    return M.bridge_fill(_exchange(spark, sf_dir), _code_list(spark, sf_dir)).select("pos", "code", "edinet_code")


@register("disposal", f"""WITH {CODE_LIST_SQL}, {EXCHANGE_SQL}, {REV_SQL}
SELECT pos, code, edinet_code, market FROM bf WHERE contains(upper(coalesce(market, '')), 'ETF')
  OR contains(upper(coalesce(market, '')), 'REIT') OR contains(upper(coalesce(market, '')), 'PRO MARKET')
  OR (coalesce(code, '') <> '' AND right(code, 1) <> '0') OR edinet_code IS NOT NULL""")
def q_disposal(spark, sf_dir):
    """J3 -> F10: exchange-only common shares are dropped."""
    b = M.bridge_fill(_exchange(spark, sf_dir), _code_list(spark, sf_dir))
    return M.disposal(b).select("pos", "code", "edinet_code", "market")


def _sector_master(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    core = F.concat(F.lpad((F.col("c_custkey") % 700).cast("string"), 4, "0"), F.lit("0"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("JP:"), core)).otherwise(core).alias("code"),
        F.col("n_name").alias("sector"), F.col("c_custkey").alias("pos"))


@register("sector_lookup", f"""WITH {EXCHANGE_SQL},
sm AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'JP:' ELSE '' END || lpad(CAST(c_custkey % 700 AS VARCHAR), 4, '0')
  || '0' AS code, n_name AS sector, c_custkey AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT code, arg_min(sector, pos) AS sector FROM sm GROUP BY code)
SELECT ex.pos, ex.code, CASE WHEN m1.code IS NOT NULL THEN m1.sector ELSE m2.sector END AS sector
FROM ex LEFT JOIN m m1 ON ex.code = m1.code
LEFT JOIN m m2 ON CASE WHEN strpos(ex.code, ':') > 0 THEN regexp_extract(ex.code, '[^:]*$') END = m2.code""")
def q_sector_lookup(spark, sf_dir):
    """Sector by exact code, else by the bare core of legacy master rows."""
    return M.sector_lookup(_exchange(spark, sf_dir), _sector_master(spark, sf_dir)).select("pos", "code", "sector")


@register("inherit_attributes", with_views(f"""WITH {EXCHANGE_SQL},
m AS (SELECT code, arg_min_null(company_name, ordinal) AS company_name, arg_min_null(market, ordinal) AS market
      FROM v_entities WHERE code IS NOT NULL GROUP BY code)
SELECT ex.pos, ex.code, coalesce(ex.company_name, m.company_name) AS company_name,
  coalesce(ex.market, m.market) AS market FROM ex LEFT JOIN m ON ex.code = m.code""", "v_entities"))
def q_inherit_attributes(spark, sf_dir):
    """Incoming exchange rows take missing attributes from the master row of their code."""
    m = view(spark, sf_dir, "v_entities").withColumnRenamed("ordinal", "pos")
    return M.inherit_attributes(_exchange(spark, sf_dir), m, ["company_name", "market"]) \
        .select("pos", "code", "company_name", "market")


@register("en_industry", f"""WITH {CODE_LIST_SQL}
SELECT cl.edinet_code, lower(n_name) AS industry_en FROM cl LEFT JOIN
  (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) n ON cl.c_nationkey = n.n_nationkey""")
def q_en_industry(spark, sf_dir):
    """English industry joined to the code list by industry code (some unknown)."""
    ind = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 3 != 0).select(
        F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("industry_en"))
    return _code_list(spark, sf_dir).join(ind, "c_nationkey", "left").select("edinet_code", "industry_en")


@register("former_codes", """WITH m AS (SELECT 'E' || lpad(CAST(r_regionkey AS VARCHAR), 5, '0') AS edinet_code,
  CASE WHEN r_regionkey % 2 = 0 THEN 'E19999, E10001' END AS former_edinet_codes FROM region),
am AS (SELECT 'E1' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS old_code,
  'E' || lpad(CAST(n_regionkey AS VARCHAR), 5, '0') AS new_code, n_nationkey AS pos FROM nation),
inv AS (SELECT new_code, list(old_code ORDER BY pos) AS olds FROM am GROUP BY new_code),
j AS (SELECT m.edinet_code, m.former_edinet_codes, inv.new_code, list_concat(
  CASE WHEN m.former_edinet_codes IS NULL THEN [] ELSE
    list_filter(list_transform(string_split(m.former_edinet_codes, ','), lambda x: trim(x)), lambda x: x <> '') END,
  coalesce(inv.olds, [])) AS l FROM m LEFT JOIN inv ON m.edinet_code = inv.new_code)
SELECT edinet_code, CASE WHEN new_code IS NULL THEN former_edinet_codes
  ELSE array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') END AS former_edinet_codes FROM j""")


def q_former_codes(spark, sf_dir):
    """Nations retire into their region; the region's list of former codes grows."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    m = r.select(F.concat(F.lit("E"), F.lpad(F.col("r_regionkey").cast("string"), 5, "0")).alias("edinet_code"),
                 F.when(F.col("r_regionkey") % 2 == 0, F.lit("E19999, E10001")).alias("former_edinet_codes"))
    am = n.select(F.concat(F.lit("E1"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("old_code"),
                  F.concat(F.lit("E"), F.lpad(F.col("n_regionkey").cast("string"), 5, "0")).alias("new_code"),
                  F.col("n_nationkey").alias("pos"))
    return M.former_codes(m, am).select("edinet_code", "former_edinet_codes")


# ------------------------------------------------------------ lifecycle
NEW_MASTER_SQL = """nm AS (SELECT identity_key, company_name, is_active FROM v_master_in
  UNION ALL SELECT identity_key, company_name, is_active FROM v_master_prev
  WHERE identity_key NOT IN (SELECT identity_key FROM v_master_in)),
dm0 AS (SELECT nm.identity_key, nm.company_name, nm.is_active AS was_flag,
  (nm.identity_key IN (SELECT identity_key FROM v_master_prev)
   AND nm.identity_key NOT IN (SELECT identity_key FROM v_master_in)) AS is_disappeared FROM nm),
dm AS (SELECT identity_key, company_name, is_disappeared,
  CASE WHEN is_disappeared THEN false ELSE was_flag END AS is_active FROM dm0)"""


def _new_master(spark, sf_dir):
    prev = view(spark, sf_dir, "v_master_prev")
    inc = view(spark, sf_dir, "v_master_in")
    carried = prev.join(inc.select("identity_key"), "identity_key", "left_anti")
    nm = inc.select("identity_key", "company_name", "is_active").unionByName(
        carried.select("identity_key", "company_name", "is_active"))
    run_ids = inc.select(F.col("identity_key").alias("id"))
    return M.disappeared(nm, prev, run_ids), prev


@register("disappeared", with_views(f"WITH {NEW_MASTER_SQL} SELECT * FROM dm", "v_master_prev", "v_master_in"))
def q_disappeared(spark, sf_dir):
    """M2: companies of the old master missing from this run stay, flagged and inactive."""
    return _new_master(spark, sf_dir)[0].select("identity_key", "company_name", "is_disappeared", "is_active")


AS_OF = "2024-06-01"


@register("listing_events", with_views(f"""WITH {NEW_MASTER_SQL}
SELECT DISTINCT dm.identity_key AS code, CASE WHEN p.identity_key IS NULL THEN CASE WHEN dm.is_active THEN 'LISTING' END
  WHEN coalesce(p.is_active, true) AND NOT coalesce(dm.is_active, true) THEN 'DELISTING'
  WHEN NOT coalesce(p.is_active, true) AND coalesce(dm.is_active, true) THEN 'LISTING' END AS type,
  '{AS_OF}' AS event_date
FROM dm LEFT JOIN v_master_prev p ON dm.identity_key = p.identity_key WHERE type IS NOT NULL""",
                                       "v_master_prev", "v_master_in"))
def q_listing_events(spark, sf_dir):
    """M3: LISTING / DELISTING events from the change of the active flag."""
    nm, prev = _new_master(spark, sf_dir)
    nm = nm.withColumnRenamed("identity_key", "code")
    prev = prev.withColumnRenamed("identity_key", "code").withColumn("pos", F.lit(0))
    return M.listing_events(nm, prev, AS_OF)


def _def_master(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("sector_33_code"),
                    F.col("p_type").alias("sector_jpx_33"),
                    (F.col("p_size") % 17).cast("string").alias("sector_17_code"),
                    F.concat(F.lit("S17-"), F.col("p_type")).alias("sector_jpx_17"),
                    (F.col("p_size") % 5).cast("string").alias("size_code"),
                    F.concat(F.lit("Size-"), F.substring("p_name", 1, 3)).alias("size_category"))


DEF_MASTER_SQL = """dmaster AS (SELECT p_partkey AS pos, p_brand AS sector_33_code, p_type AS sector_jpx_33,
  CAST(p_size % 17 AS VARCHAR) AS sector_17_code, 'S17-' || p_type AS sector_jpx_17,
  CAST(p_size % 5 AS VARCHAR) AS size_code, 'Size-' || substr(p_name, 1, 3) AS size_category FROM part)"""


def _defs_sql(src: str, agg: str = "arg_min_null") -> str:
    return f"""SELECT type, code, {agg}(name, pos) AS name FROM (
  SELECT 'sector_33' AS type, sector_33_code AS code, sector_jpx_33 AS name, pos FROM {src} WHERE sector_33_code IS NOT NULL
  UNION ALL SELECT 'sector_17', sector_17_code, sector_jpx_17, pos FROM {src} WHERE sector_17_code IS NOT NULL
  UNION ALL SELECT 'size', size_code, size_category, pos FROM {src} WHERE size_code IS NOT NULL) GROUP BY type, code"""


@register("definition_collect", f"WITH {DEF_MASTER_SQL} {_defs_sql('dmaster')}")
def q_definition_collect(spark, sf_dir):
    """One definition per (type, code) from the master rows."""
    return M.definition_collect(_def_master(spark, sf_dir))


@register("definition_sync", f"""WITH {DEF_MASTER_SQL}, defs AS ({_defs_sql('dmaster')})
SELECT m.pos, coalesce(d1.name, m.sector_jpx_33) AS sector_jpx_33, coalesce(d2.name, m.sector_jpx_17) AS sector_jpx_17,
  coalesce(d3.name, m.size_category) AS size_category FROM dmaster m
LEFT JOIN (SELECT * FROM defs WHERE type = 'sector_33') d1 ON m.sector_33_code = d1.code
LEFT JOIN (SELECT * FROM defs WHERE type = 'sector_17') d2 ON m.sector_17_code = d2.code
LEFT JOIN (SELECT * FROM defs WHERE type = 'size') d3 ON m.size_code = d3.code""")
def q_definition_sync(spark, sf_dir):
    """Master names replaced by the definition table's names."""
    m = _def_master(spark, sf_dir)
    return M.name_sync(m, M.definition_collect(m)).select("pos", "sector_jpx_33", "sector_jpx_17", "size_category")


@register("scd2_merge", f"""WITH {DEF_MASTER_SQL},
old AS (SELECT *, '2024-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to FROM ({_defs_sql(
    "(SELECT * FROM dmaster WHERE pos % 2 = 0)")})),
closed AS (SELECT type, code, 'old ' || name AS name, '2023-01-01' AS valid_from, '2023-12-31' AS valid_to FROM old),
inc AS ({_defs_sql('dmaster', 'arg_max_null')}),
j AS (SELECT coalesce(o.type, i.type) AS type, coalesce(o.code, i.code) AS code, o.name, o.valid_from, o.valid_to,
  i.name AS new_name FROM old o FULL OUTER JOIN inc i ON o.type = i.type AND o.code = i.code)
SELECT * FROM closed
UNION ALL SELECT type, code, name, valid_from, CASE WHEN name IS NOT NULL AND new_name IS NOT NULL
  AND name IS DISTINCT FROM new_name THEN '2024-05-31' ELSE valid_to END FROM j WHERE valid_from IS NOT NULL
UNION ALL SELECT type, code, new_name, '{AS_OF}', NULL FROM j WHERE valid_from IS NULL
  OR (name IS NOT NULL AND new_name IS NOT NULL AND name IS DISTINCT FROM new_name)""")
def q_scd2_merge(spark, sf_dir):
    """Definitions from even parts are the open rows (with a closed history
    row each); the full part list, last row winning, arrives as today's state."""
    m = _def_master(spark, sf_dir)
    old = (M.definition_collect(m.filter(F.col("pos") % 2 == 0))
           .withColumn("valid_from", F.lit("2024-01-01")).withColumn("valid_to", F.lit(None).cast("string")))
    closed = old.select("type", "code", F.concat(F.lit("old "), "name").alias("name"),
                        F.lit("2023-01-01").alias("valid_from"), F.lit("2023-12-31").alias("valid_to"))
    inc = M.definition_collect(m.withColumn("pos", -F.col("pos")))
    return M.scd2_merge(closed.unionByName(old), inc, AS_OF)
