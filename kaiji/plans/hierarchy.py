"""Hierarchy and label queries over v_links and label rows derived from its keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from kaiji.operators import hierarchy as H
from kaiji.plans.registry import register
from kaiji.plans.tables import view, with_views


def _links(spark, sf_dir):
    return view(spark, sf_dir, "v_links")


def _keys(links):
    return (links.select(F.col("parent_key").alias("key"))
            .unionByName(links.select(F.col("child_key").alias("key"))).distinct())


KEYS_SQL = "keys AS (SELECT parent_key AS key FROM v_links UNION SELECT child_key FROM v_links)"


def _locators(keys):
    """Fixture locators: every key except those whose length is a multiple of 7."""
    return keys.filter(F.length("key") % 7 != 0).select(F.concat(F.lit("loc_"), "key").alias("label_pre"), "key")


LOC_SQL = "loc AS (SELECT 'loc_' || key AS label_pre, key FROM keys WHERE length(key) % 7 <> 0)"


def _label_arcs(keys):
    """Fixture label arcs: resource label -> locator label, missing when length % 5 = 0."""
    return keys.filter(F.length("key") % 5 != 0).select(
        F.concat(F.lit("lab_"), "key").alias("label_lab"), F.concat(F.lit("loc_"), "key").alias("label_pre"))


LARC_SQL = "larc AS (SELECT 'lab_' || key AS label_lab, 'loc_' || key AS label_pre FROM keys WHERE length(key) % 5 <> 0)"


def _resources(keys):
    """Fixture label resources: 4 (role, lang) texts per key; no verbose label
    when the key length is a multiple of 3; some have a second, later text."""
    combos = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(la).alias("lang")) for r, la, _ in H.LABEL_ROLES])
    r = keys.select("key", F.explode(combos).alias("c")).select("key", "c.role", "c.lang")
    r = r.filter(~((F.col("role") == "verboseLabel") & (F.length("key") % 3 == 0)))
    r = r.select(F.concat(F.lit("lab_"), "key").alias("label_lab"), "role", "lang",
                 F.concat_ws("|", "lang", "role", "key").alias("text"), F.lit(0).alias("pos"))
    later = r.filter(F.length("label_lab") % 4 == 0).select(
        "label_lab", "role", "lang", F.concat(F.lit("zz|"), "text").alias("text"), F.lit(1).alias("pos"))
    return r.unionByName(later)


RES_SQL = """res0 AS (SELECT 'lab_' || key AS label_lab, c.role, c.lang, c.lang || '|' || c.role || '|' || key AS text
  FROM keys CROSS JOIN (VALUES ('label', 'ja'), ('verboseLabel', 'ja'), ('label', 'en'), ('verboseLabel', 'en'))
  AS c(role, lang) WHERE NOT (c.role = 'verboseLabel' AND length(key) % 3 = 0)),
res AS (SELECT *, 0 AS pos FROM res0 UNION ALL SELECT label_lab, role, lang, 'zz|' || text, 1 FROM res0 WHERE length(label_lab) % 4 = 0)"""

LABELS_SQL = """lab AS (SELECT coalesce(loc.key, larc.label_pre, res.label_lab) AS key,
  arg_min(text, pos) FILTER (WHERE res.role = 'label' AND res.lang = 'ja') AS label_jp,
  arg_min(text, pos) FILTER (WHERE res.role = 'verboseLabel' AND res.lang = 'ja') AS label_jp_long,
  arg_min(text, pos) FILTER (WHERE res.role = 'label' AND res.lang = 'en') AS label_en,
  arg_min(text, pos) FILTER (WHERE res.role = 'verboseLabel' AND res.lang = 'en') AS label_en_long
  FROM res LEFT JOIN larc ON res.label_lab = larc.label_lab LEFT JOIN loc ON larc.label_pre = loc.label_pre
  GROUP BY 1)"""


def _labels(spark, sf_dir):
    keys = _keys(_links(spark, sf_dir))
    return H.resolve_labels(_resources(keys), _label_arcs(keys), _locators(keys))


@register("label_resolution", with_views(f"WITH {KEYS_SQL}, {LOC_SQL}, {LARC_SQL}, {RES_SQL}, {LABELS_SQL} "
                                         "SELECT * FROM lab", "v_links"))
def q_label_resolution(spark, sf_dir):
    """Label texts resolved to keys and pivoted to four label columns."""
    return _labels(spark, sf_dir)


@register("arc_keys", with_views(f"""WITH {KEYS_SQL}, {LOC_SQL}
SELECT coalesce(p.key, a.parent) AS parent_key, coalesce(c.key, a.child) AS child_key, a.role, a.child_order
FROM (SELECT 'loc_' || parent_key AS parent, 'loc_' || child_key AS child, role, child_order FROM v_links) a
LEFT JOIN loc p ON a.parent = p.label_pre LEFT JOIN loc c ON a.child = c.label_pre""", "v_links"))
def q_arc_keys(spark, sf_dir):
    """Presentation arcs from locator labels back to keys."""
    links = _links(spark, sf_dir)
    arcs = links.select(F.concat(F.lit("loc_"), "parent_key").alias("parent"),
                        F.concat(F.lit("loc_"), "child_key").alias("child"), "role", "child_order")
    return H.resolve_arc_keys(arcs, _locators(_keys(links)))


@register("link_integrity", with_views(f"""WITH {KEYS_SQL}, {LOC_SQL}, {LARC_SQL}, {RES_SQL}, {LABELS_SQL}
SELECT DISTINCT parent_key AS key, 'parent' AS kind FROM v_links WHERE parent_key NOT IN (SELECT key FROM loc)
UNION ALL SELECT DISTINCT child_key, 'child' FROM v_links WHERE child_key NOT IN (SELECT key FROM loc)
UNION ALL SELECT DISTINCT key, 'label' FROM lab WHERE key NOT IN (SELECT key FROM loc)""", "v_links"))
def q_link_integrity(spark, sf_dir):
    """Arc and label keys without a locator."""
    links = _links(spark, sf_dir)
    return H.link_integrity(links, _labels(spark, sf_dir), _locators(_keys(links)))


CALC_SQL = """calc AS (SELECT parent_key, child_key, CASE WHEN child_order > 5 THEN -1.0 ELSE 1.0 END AS weight,
  child_order AS pos FROM v_links
  UNION ALL SELECT parent_key, child_key, 2.0, child_order + 100 FROM v_links WHERE length(child_key) % 4 = 0)"""


def _calc(links):
    base = links.select("parent_key", "child_key",
                        F.when(F.col("child_order") > 5, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("weight"),
                        F.col("child_order").alias("pos"))
    extra = links.filter(F.length("child_key") % 4 == 0).select(
        "parent_key", "child_key", F.lit(2.0).alias("weight"), (F.col("child_order") + 100).alias("pos"))
    return base.unionByName(extra)


@register("calc_edges", with_views(f"""WITH {CALC_SQL}
SELECT parent_key, child_key, min(pos) AS pos, arg_min(weight, (pos, weight)) AS weight
FROM calc GROUP BY 1, 2""", "v_links"))
def q_calc_edges(spark, sf_dir):
    """H6: weighted calculation edges, one per (parent, child), the first arc stays."""
    return H.first_calc_edges(_calc(_links(spark, sf_dir)))


@register("node_summary", with_views(f"""WITH {KEYS_SQL}, {CALC_SQL}
SELECT key, key IN (SELECT parent_key FROM v_links) AS is_parent, key IN (SELECT child_key FROM v_links) AS is_child,
  key IN (SELECT parent_key FROM calc WHERE pos > 4) AS is_calc_parent,
  key IN (SELECT child_key FROM calc WHERE pos > 4) AS is_calc_child FROM keys""", "v_links"))
def q_node_summary(spark, sf_dir):
    """Presentation / calculation membership per key (calc arcs with pos > 4)."""
    links = _links(spark, sf_dir)
    calc = _calc(links).filter(F.col("pos") > 4)
    return H.node_summary(_keys(links), links, calc)


@register("children", with_views("""SELECT parent_key, child_key, role, child_order FROM v_links""", "v_links"))
def q_children(spark, sf_dir):
    """H1: the children of every key that has any."""
    links = _links(spark, sf_dir)
    return H.children(links, _keys(links))


@register("parents", with_views("""SELECT child_key, parent_key, role FROM v_links""", "v_links"))
def q_parents(spark, sf_dir):
    """H1: the parents of every key."""
    links = _links(spark, sf_dir)
    return H.parents(links, _keys(links))


@register("descendants", with_views("""WITH RECURSIVE c(role, key, descendant, depth) AS (
  SELECT role, parent_key, child_key, 1 FROM v_links
  UNION SELECT c.role, c.key, l.child_key, c.depth + 1 FROM c JOIN v_links l
    ON l.parent_key = c.descendant AND l.role = c.role)
SELECT role, key, descendant, min(depth) AS depth FROM c GROUP BY 1, 2, 3""", "v_links"))
def q_descendants(spark, sf_dir):
    """H2: all descendants of every key, with the shortest depth."""
    return H.descendants(_links(spark, sf_dir))


@register("top_ancestor", with_views("""WITH RECURSIVE nodes AS (SELECT role, parent_key AS key FROM v_links
  UNION SELECT role, child_key FROM v_links),
roots AS (SELECT * FROM nodes WHERE (role, key) NOT IN (SELECT (role, child_key) FROM v_links)),
up(role, key, top_key, depth) AS (SELECT role, key, key, 0 FROM roots
  UNION SELECT u.role, l.child_key, u.top_key, u.depth + 1 FROM up u JOIN v_links l
    ON l.parent_key = u.key AND l.role = u.role)
SELECT DISTINCT role, key, top_key FROM up""", "v_links"))
def q_top_ancestor(spark, sf_dir):
    """H3: top ancestors of every key; roots map to themselves."""
    return H.top_ancestors(_links(spark, sf_dir))


@register("key_roles", with_views("""SELECT parent_key AS key, role FROM v_links UNION
SELECT child_key, role FROM v_links""", "v_links"))
def q_key_roles(spark, sf_dir):
    """H4: roles of every key."""
    return H.roles_of_keys(_links(spark, sf_dir))


@register("display_order", with_views("""WITH RECURSIVE e AS (SELECT parent_key, child_key,
  coalesce(child_order, 1.0) AS co FROM v_links WHERE role = 'geo'),
w AS (SELECT child_key AS key FROM v_links WHERE role = 'geo'),
roots0 AS (SELECT DISTINCT parent_key AS k FROM e WHERE parent_key NOT IN (SELECT child_key FROM e)),
roots AS (SELECT k, CAST(row_number() OVER (ORDER BY k) AS DOUBLE) AS n FROM roots0),
t(child_key, ord, lvl) AS (SELECT e.child_key, e.co * pow(0.01, 1) + r.n, 1 FROM e JOIN roots r ON e.parent_key = r.k
  UNION ALL SELECT e.child_key, e.co * pow(0.01, t.lvl + 1) + t.ord, t.lvl + 1 FROM t JOIN e
    ON e.parent_key = t.child_key),
keep AS (SELECT key FROM w UNION SELECT child_key FROM e WHERE parent_key IN (SELECT key FROM w))
SELECT child_key AS key, round(ord, 10) AS "order", lvl FROM t WHERE child_key IN (SELECT key FROM keep)""",
                                 "v_links"))
def q_display_order(spark, sf_dir):
    """H5: display order of every child key of the geo role."""
    links = _links(spark, sf_dir)
    wanted = links.filter(F.col("role") == "geo").select(F.col("child_key").alias("key"))
    return H.display_order(links, wanted, "geo")


@register("key_search", with_views(f"WITH {KEYS_SQL} SELECT key FROM keys WHERE contains(key, 'ATION_1')",
                                   "v_links"))
def q_key_search(spark, sf_dir):
    """keys containing a word."""
    return H.key_search(_keys(_links(spark, sf_dir)), "ATION_1")


@register("role_filter", with_views("""SELECT DISTINCT role FROM v_account_list
WHERE contains(role, 'Balance') OR contains(role, 'Cash')""", "v_account_list"))
def q_role_filter(spark, sf_dir):
    """roles matching any keyword."""
    roles = view(spark, sf_dir, "v_account_list").select("role").distinct()
    return H.roles_matching(roles, ["Balance", "Cash"])
