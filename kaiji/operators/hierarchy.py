"""Presentation / calculation hierarchy operators.

Edges are (parent_key, child_key, role[, child_order | weight]). Recursive
walks are level-by-level distributed joins that run until a level adds
nothing, however deep the tree; cycles end them too (pairs already seen are
anti-joined away, and a display path never visits a key twice). Each level is
checkpointed to the shared folder, so later levels don't recompute it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaiji.session import checkpoint_dir

# Label roles and languages pivoted by J6.
LABEL_ROLES = (("label", "ja", "label_jp"), ("verboseLabel", "ja", "label_jp_long"),
               ("label", "en", "label_en"), ("verboseLabel", "en", "label_en_long"))


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def children(edges: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """H1: direct children of the given keys (all parents when ``keys`` is None)."""
    e = edges.select("parent_key", "child_key", "role", "child_order")
    if keys is not None:
        e = e.join(keys.select(F.col("key").alias("parent_key")), "parent_key", "left_semi")
    return e


def parents(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """H1: direct parents of the given keys."""
    return edges.join(keys.select(F.col("key").alias("child_key")), "child_key", "left_semi") \
        .select("child_key", "parent_key", "role")


def descendants(edges: DataFrame, group: tuple[str, ...] = ("role",), start: DataFrame | None = None) -> DataFrame:
    """H2: every (group..., key, descendant) pair with its shortest depth;
    ``group`` scopes the trees (the role, or document and role). ``start``
    (group..., key) limits the keys whose descendants are wanted."""
    g = list(group)
    e = _cut(edges.select(*g, F.col("parent_key").alias("key"), F.col("child_key").alias("nxt")).distinct())
    first = e if start is None else e.join(start, g + ["key"], "left_semi")
    result = frontier = first.select(*g, "key", F.col("nxt").alias("descendant"), F.lit(1).alias("depth"))
    step_edges, depth = e.withColumnRenamed("key", "descendant"), 1
    while True:
        depth += 1
        step = (frontier.join(step_edges, g + ["descendant"])
                .select(*g, "key", F.col("nxt").alias("descendant"), F.lit(depth).alias("depth")).distinct())
        step = _cut(step.join(result.select(*g, "key", "descendant"), g + ["key", "descendant"], "left_anti"))
        if step.isEmpty():
            return result
        result = result.unionByName(step)
        frontier = step


def top_ancestors(edges: DataFrame, group: tuple[str, ...] = ("role",)) -> DataFrame:
    """H3: for every key of a tree, its top ancestors (keys without a parent);
    a root returns itself. Walks down from the roots only."""
    g = list(group)
    nodes = (edges.select(*g, F.col("parent_key").alias("key"))
             .unionByName(edges.select(*g, F.col("child_key").alias("key"))).distinct())
    has_parent = edges.select(*g, F.col("child_key").alias("key")).distinct()
    roots = nodes.join(has_parent, g + ["key"], "left_anti")
    below = descendants(edges, group, roots).select(*g, F.col("descendant").alias("key"), F.col("key").alias("top_key"))
    return below.unionByName(roots.select(*g, "key", F.col("key").alias("top_key"))).distinct()


def roles_of_keys(edges: DataFrame) -> DataFrame:
    """H4: every role in which a key appears as parent or child."""
    return (edges.select(F.col("parent_key").alias("key"), "role")
            .unionByName(edges.select(F.col("child_key").alias("key"), "role")).distinct())


def display_order(edges: DataFrame, wanted: DataFrame, role: str) -> DataFrame:
    """H5 for one role (see :func:`display_order_grouped`)."""
    e = edges.filter(F.col("role") == role)
    w = wanted.withColumn("role", F.lit(role))
    return display_order_grouped(e, w, ("role",)).drop("role")


def display_order_grouped(edges: DataFrame, wanted: DataFrame, group: tuple[str, ...] = ("role",)) -> DataFrame:
    """H5: depth-decayed display order per tree (``group``: role, or
    document and role).

    The top ancestors of the wanted keys are numbered 1..n by key (D18);
    a child's order is its parent's order + child_order * 0.01^depth. Rows are
    kept for the wanted keys and their direct children.

    Relaxation by levels over states (tree, root, key, depth): a key that a root reaches by
    several paths of one length keeps the smallest order of them, so the paths aren't
    enumerated; in a tree each key has one state a root. Edges of a cycle that lead back, to a key that a
    walk by levels from the roots meets no later than their parent, are cut, so every walk ends."""
    from pyspark.sql import Window
    g = list(group)
    e = _cut(edges.select(*g, "parent_key", "child_key", F.coalesce("child_order", F.lit(1.0)).alias("co"))
             .filter(F.col("parent_key") != F.col("child_key")))
    w = wanted.select(*g, "key").distinct()
    tops = top_ancestors(edges, group)
    roots = (tops.join(w, g + ["key"], "left_semi").select(*g, F.col("top_key").alias("parent_key")).distinct())
    # Roots per tree are few (a taxonomy has a handful per role).
    roots = roots.withColumn("root", F.row_number().over(Window.partitionBy(*g).orderBy("parent_key")))
    keep = w.unionByName(e.join(w.withColumnRenamed("key", "parent_key"), g + ["parent_key"], "left_semi")
                         .select(*g, F.col("child_key").alias("key"))).distinct()
    looped = _on_cycles(e.select(*g, "parent_key", "child_key"), group)
    if looped is not None:
        e = _cut(_without_back_edges(e, looped, roots, g))
    out = frontier = (roots.join(e, g + ["parent_key"]).groupBy(*g, "root", "child_key")
                      .agg(F.min(F.col("co") * F.pow(F.lit(0.01), F.lit(1)) + F.col("root")).alias("ord")).withColumn("lvl", F.lit(1)))
    depth = 1
    while True:
        depth += 1
        step = (frontier.select(*g, "root", F.col("child_key").alias("parent_key"), "ord").join(e, g + ["parent_key"])
                .groupBy(*g, "root", "child_key").agg(F.min(F.col("co") * F.pow(F.lit(0.01), F.lit(depth)) + F.col("ord")).alias("ord"))
                .withColumn("lvl", F.lit(depth)))
        step = _cut(step)
        if step.isEmpty():
            break
        out = out.unionByName(step)
        frontier = step
    return (out.join(keep.withColumnRenamed("key", "child_key"), g + ["child_key"], "left_semi")
            .select(*g, F.col("child_key").alias("key"), F.round("ord", 10).alias("order"), "lvl"))


def _on_cycles(edges: DataFrame, group: tuple[str, ...]) -> DataFrame | None:
    """The edges that lie on a cycle, None without any. Edges to keys without children and from keys
    without parents go round by round; only what is left, if anything, is walked for its cycles."""
    g, left, n = list(group), edges.distinct(), -1
    while True:
        left = _cut(left.join(left.select(*g, F.col("parent_key").alias("child_key")).distinct(), g + ["child_key"], "left_semi"))
        left = _cut(left.join(left.select(*g, F.col("child_key").alias("parent_key")).distinct(), g + ["parent_key"], "left_semi"))
        was, n = n, left.count()
        if n == 0:
            return None
        if n == was:
            back = descendants(left, group).select(*g, F.col("key").alias("child_key"), F.col("descendant").alias("parent_key"))
            return _cut(left.join(back, g + ["parent_key", "child_key"], "left_semi"))


def _without_back_edges(edges: DataFrame, looped: DataFrame, roots: DataFrame, g: list[str]) -> DataFrame:
    """``edges`` without those of cycles (``looped``) that don't lead away from the roots: a key's first level
    comes from a walk by levels, and an edge on a cycle stays if its child's first level is the greater."""
    first = frontier = _cut(roots.select(*g, F.col("parent_key").alias("key"), F.lit(0).alias("lvl")).distinct())
    depth = 0
    while True:
        depth += 1
        step = (frontier.select(*g, F.col("key").alias("parent_key")).join(edges, g + ["parent_key"])
                .select(*g, F.col("child_key").alias("key"), F.lit(depth).alias("lvl")).distinct())
        step = _cut(step.join(first, g + ["key"], "left_anti"))
        if step.isEmpty():
            break
        first, frontier = first.unionByName(step), step
    at = lambda name: first.select(*g, F.col("key").alias(f"{name}_key"), F.col("lvl").alias(f"{name}_lvl"))
    back = (looped.join(at("parent"), g + ["parent_key"]).join(at("child"), g + ["child_key"])
            .filter("child_lvl <= parent_lvl").select(*g, "parent_key", "child_key"))
    return edges.join(back, g + ["parent_key", "child_key"], "left_anti")


def first_calc_edges(calc: DataFrame) -> DataFrame:
    """H6: one weighted calculation edge per (parent, child); the first arc stays."""
    return calc.groupBy("parent_key", "child_key").agg(
        F.min("pos").alias("pos"), F.min_by("weight", F.struct("pos", "weight")).alias("weight"))


def key_search(keys: DataFrame, word: str) -> DataFrame:
    """keys containing a word."""
    return keys.filter(F.col("key").contains(word))


def roles_matching(roles: DataFrame, words: list[str]) -> DataFrame:
    """roles containing any keyword (substring)."""
    cond = F.lit(False)
    for w in words:
        cond = cond | F.col("role").contains(w)
    return roles.filter(cond)


def label_pivot() -> list:
    """The first text (by ``pos``, ties by text) of each role and language."""
    return [F.min_by("text", F.when((F.col("role") == ro) & (F.col("lang") == la), F.struct("pos", "text"))).alias(name)
            for ro, la, name in LABEL_ROLES]


def resolve_labels(resources: DataFrame, arcs: DataFrame, locators: DataFrame) -> DataFrame:
    """Resource label -> (arc) locator label -> (locator) key, then the
    label / verboseLabel x ja / en pivot as one conditional aggregate. Of
    several texts the first (by ``pos``) stays."""
    r = resources.join(arcs, "label_lab", "left").join(locators, "label_pre", "left")
    r = r.withColumn("key", F.coalesce("key", "label_pre", "label_lab"))
    return r.groupBy("key").agg(*label_pivot())


def resolve_arc_keys(arcs: DataFrame, locators: DataFrame) -> DataFrame:
    """Both ends of an arc mapped from locator labels to keys; unresolved kept."""
    lp = locators.select(F.col("label_pre").alias("parent"), F.col("key").alias("pk"))
    lc = locators.select(F.col("label_pre").alias("child"), F.col("key").alias("ck"))
    out = arcs.join(lp, "parent", "left").join(lc, "child", "left")
    return out.select(F.coalesce("pk", "parent").alias("parent_key"), F.coalesce("ck", "child").alias("child_key"),
                      "role", "child_order")


def link_integrity(edges: DataFrame, labels: DataFrame, locator_keys: DataFrame) -> DataFrame:
    """Parent / child / label keys that are not among the locators."""
    k = locator_keys.select("key").distinct()
    p = edges.select(F.col("parent_key").alias("key")).distinct().join(k, "key", "left_anti") \
        .withColumn("kind", F.lit("parent"))
    c = edges.select(F.col("child_key").alias("key")).distinct().join(k, "key", "left_anti") \
        .withColumn("kind", F.lit("child"))
    lab = labels.select("key").distinct().join(k, "key", "left_anti").withColumn("kind", F.lit("label"))
    return p.unionByName(c).unionByName(lab)


def node_summary(keys: DataFrame, pres: DataFrame, calc: DataFrame) -> DataFrame:
    """Per key, membership as presentation / calculation parent or child."""
    def member(df, col, name):
        return df.select(F.col(col).alias("key")).distinct().withColumn(name, F.lit(True))
    out = keys.select("key").distinct()
    for df, col, name in ((pres, "parent_key", "is_parent"), (pres, "child_key", "is_child"),
                          (calc, "parent_key", "is_calc_parent"), (calc, "child_key", "is_calc_child")):
        out = out.join(member(df, col, name), "key", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out
