"""Company master: identity resolution, golden record, lifecycle and
definitions (SURVEY J1-J3, J14, J15, J17, F10, F12, G5, G6, A10, A11, M1-M3, G10, P14).

Group-wise decisions (canonical id, latest row, first non-null attribute,
any/all flags) are aggregates with map-side combine followed by a join
back, never Python loops over groups and never a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.functions.codes import NULL_SENTINELS, normalize_code, parent_code, strip
from kaiji.operators.catalog import latest_first, latest_wins
from kaiji.session import checkpoint_dir

# Exchange segments that are kept without an EDINET code.
SPECIAL_MARKET_KEYWORDS = ("ETF", "REIT", "PRO MARKET")
# Attributes filled from the first non-null row of an identity group.
GOLDEN_ATTRIBUTES = (
    "company_name", "sector_jpx_33", "sector_33_code", "sector_jpx_17", "sector_17_code", "market", "size_code",
    "size_category", "jcn", "edinet_code", "parent_code", "former_edinet_codes", "company_name_en",
    "company_name_kana", "submitter_type", "address", "industry_edinet", "industry_edinet_en", "capital",
    "settlement_date", "is_consolidated",
)
# Text attributes of a master record in which sentinel words mean "no value".
SENTINEL_ATTRIBUTES = (
    "edinet_code", "code", "jcn", "company_name_en", "company_name_kana", "submitter_type", "settlement_date", "address",
    "sector_jpx_33", "sector_33_code", "sector_jpx_17", "sector_17_code", "industry_edinet", "industry_edinet_en",
    "market", "size_code", "size_category", "last_submitted_at", "former_edinet_codes",
)
# Definition types kept as slowly changing dimensions: (type, code column, name column).
DEFINITION_TYPES = (("sector_33", "sector_33_code", "sector_jpx_33"),
                    ("sector_17", "sector_17_code", "sector_jpx_17"),
                    ("size", "size_code", "size_category"))


def _spread(key: Column, pos: Column) -> Column:
    """A join key whose NULLs are all different, so they match nothing and no task gets them all."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), pos.cast("string")))


# ------------------------------------------------------------------ lookups
def bridge_fill(rows: DataFrame, code_list: DataFrame, pos: str = "pos") -> DataFrame:
    """A row without an EDINET code takes it from the code list by its
    normalised security code (reverse map; the last list row wins)."""
    rev = (code_list.select(normalize_code("code", "JP").alias("_c"), F.col("edinet_code").alias("_e"), pos)
           .filter(F.col("_c").isNotNull()))
    rev = latest_wins(rev, ["_c"], [pos]).select("_c", "_e")
    out = rows.join(rev, _spread(rows["code"], rows[pos]) == rev["_c"], "left")
    return out.withColumn("edinet_code", F.coalesce(F.col("edinet_code"), F.col("_e"))).drop("_c", "_e")


def disposal(rows: DataFrame) -> DataFrame:
    """drop exchange-only common shares (segment not special, code ending
    in 0, no EDINET code)."""
    market = F.upper(F.coalesce(F.col("market").cast("string"), F.lit("")))
    special = F.lit(False)
    for k in SPECIAL_MARKET_KEYWORDS:
        special = special | market.contains(k)
    code = F.coalesce(F.col("code").cast("string"), F.lit(""))
    preferred = (code != "") & (F.substring(code, -1, 1) != "0")
    return rows.filter(special | preferred | F.col("edinet_code").isNotNull())


def sector_lookup(rows: DataFrame, master: DataFrame, code: str = "code", out: str = "sector") -> DataFrame:
    """Sector by exact code, else (legacy rows) by the un-prefixed core.
    The master has one row per code; first row wins on duplicates."""
    m = latest_first(master.select(F.col("code").alias("_mc"), F.col("sector").alias("_ms"), "pos"), ["_mc"], ["pos"])
    exact = m.select(F.col("_mc").alias("_c1"), F.col("_ms").alias("_s1"))
    core = m.select(F.col("_mc").alias("_c2"), F.col("_ms").alias("_s2"))
    c = F.col(code)
    r = rows.withColumn("_core", F.when(F.instr(c, ":") > 0, F.substring_index(c, ":", -1)))
    r = r.join(exact, c == F.col("_c1"), "left").join(core, F.col("_core") == F.col("_c2"), "left")
    return (r.withColumn(out, F.when(F.col("_c1").isNotNull(), F.col("_s1")).otherwise(F.col("_s2")))
            .drop("_core", "_c1", "_s1", "_c2", "_s2"))


def inherit_attributes(incoming: DataFrame, master: DataFrame, attrs: list[str], pos: str = "pos") -> DataFrame:
    """Every NULL attribute of an incoming row is taken from the first
    master row with the same code."""
    m = latest_first(master.select("code", pos, *attrs).filter(F.col("code").isNotNull()), ["code"], [pos])
    m = m.select(F.col("code").alias("_mc"), *[F.col(a).alias(f"_m_{a}") for a in attrs])
    out = incoming.join(m, _spread(incoming["code"], incoming[pos]) == m["_mc"], "left")
    for a in attrs:
        out = out.withColumn(a, F.coalesce(F.col(a), F.col(f"_m_{a}")))
    return out.drop("_mc", *[f"_m_{a}" for a in attrs])


def former_codes(master: DataFrame, agg_map: DataFrame, pos: str = "pos") -> DataFrame:
    """Retired codes appended to the surviving company's comma list, in
    map order, without repeats (existing entries first)."""
    inv = (agg_map.groupBy(F.col("new_code").alias("_n"))
           .agg(F.sort_array(F.collect_list(F.struct(pos, "old_code"))).alias("_olds")))
    out = master.join(inv, master["edinet_code"] == inv["_n"], "left")
    ex = F.col("former_edinet_codes").cast("string")
    ex_list = F.when(ex.isNull() | F.lower(strip(ex)).isin("", "none", "nan"), F.array().cast("array<string>")) \
        .otherwise(F.filter(F.transform(F.split(ex, ","), lambda x: F.trim(x)), lambda x: x != ""))
    merged = F.array_distinct(F.concat(ex_list, F.coalesce(F.col("_olds.old_code"), F.array().cast("array<string>"))))
    return (out.withColumn("former_edinet_codes",
                           F.when(F.col("_n").isNotNull(), F.array_join(merged, ",")).otherwise(F.col("former_edinet_codes")))
            .drop("_n", "_olds"))


def name_sync(master: DataFrame, definitions: DataFrame) -> DataFrame:
    """Names from the definition table override the master's names for
    sector-33, sector-17 and size codes; otherwise the master keeps its own.
    Definitions are one row per (type, code), bounded by the code lists."""
    out = master
    for t, code_col, name_col in DEFINITION_TYPES:
        if code_col not in out.columns:
            continue
        d = (definitions.filter(F.col("type") == t)
             .select(F.col("code").alias(f"_d_{t}"), F.col("name").alias(f"_n_{t}")))
        out = (out.join(d, out[code_col] == F.col(f"_d_{t}"), "left")
               .withColumn(name_col, F.coalesce(F.col(f"_n_{t}"), F.col(name_col)))
               .drop(f"_d_{t}", f"_n_{t}"))
    return out


# ------------------------------------------------------------ identity
def _id_rank(c: Column) -> Column:
    return (F.when((F.length(c) == 13) & c.rlike("^[0-9]+$"), 0)
            .when(c.startswith("E"), 1).otherwise(2))


def identity_keys(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """G6 (+F12): seed identity = coalesce(edinet, code, jcn); rows with none
    are dropped. Then three passes grouped by jcn, edinet code and code: in
    each the canonical id of the group is the first 13-digit id, else the
    first ``E`` id, else the first id (first = smallest ``pos``). A final pass
    groups by the identity itself."""
    r = rows.withColumn("identity_key", F.coalesce("edinet_code", "code", "jcn")) \
        .filter(F.col("identity_key").isNotNull())
    checkpoint_dir(rows.sparkSession)
    for key in ("jcn", "edinet_code", "code", "identity_key"):
        r = r.checkpoint(eager=True)  # each pass reads its input twice; no pass is planned or run again
        known = r.filter(F.col(key).isNotNull())
        canon = known.groupBy(F.col(key).alias("_g")).agg(
            F.min_by("identity_key", F.struct(_id_rank(F.col("identity_key")), F.col(pos))).alias("_canon"))
        known = known.join(canon, known[key] == canon["_g"]).withColumn("identity_key", F.col("_canon")).drop("_g", "_canon")
        r = known.unionByName(r.filter(F.col(key).isNull()))  # rows without the key never meet in one task
    return r


def null_identity_count(rows: DataFrame) -> DataFrame:
    """how many rows carry no identifier at all."""
    return rows.agg(F.count_if(F.coalesce("edinet_code", "code", "jcn").isNull()).alias("n_without_identity"))


def golden_record(rows: DataFrame, attrs: list[str], ts: str = "last_submitted_at",
                  priority: str = "priority", pos: str = "pos") -> DataFrame:
    """G5 + A10: one row per identity.

    Order inside a group: ``ts`` descending with NULLs last, then incoming
    before current (``priority`` descending), then ``pos``. The first row
    gives every column; each attribute in ``attrs`` takes its first non-NULL
    value in that order. Flags: listed = any listed; explicitly unlisted =
    has an EDINET row, some listed value and none true; active = not
    explicitly unlisted and (listed or from the exchange list)."""
    cols = [c for c in rows.columns if c != "identity_key"]
    # a column, not an expression: each row's order is built once, not for every attribute
    rows, order = rows.withColumn("_ord", F.struct(F.col(ts).isNotNull(), F.col(ts), F.col(priority), -F.col(pos))), F.col("_ord")
    aggs = [F.max_by(F.struct(*cols), order).alias("_top")]
    aggs += [F.max_by(F.col(a), F.when(F.col(a).isNotNull(), order)).alias(f"_a_{a}") for a in attrs]
    aggs += [F.bool_or(F.coalesce(F.col("is_listed_edinet"), F.lit(False))).alias("_listed"),
             F.count(F.col("is_listed_edinet")).alias("_n_listed_vals"),
             F.bool_or(F.col("edinet_code").isNotNull()).alias("_has_edinet"),
             F.bool_or(F.coalesce(F.col("source_jpx"), F.lit(False))).alias("_jpx"),
             F.count(F.lit(1)).alias("n_rows")]
    g = rows.groupBy("identity_key").agg(*aggs)
    out = g.select("identity_key", *[F.col("_top")[c].alias(c) for c in cols],
                   *[F.col(f"_a_{a}") for a in attrs], "_listed", "_n_listed_vals", "_has_edinet", "_jpx", "n_rows")
    for a in attrs:
        out = out.withColumn(a, F.col(f"_a_{a}")).drop(f"_a_{a}")
    unlisted = F.col("_has_edinet") & (F.col("_n_listed_vals") > 0) & ~F.col("_listed")
    return (out.withColumn("is_listed_edinet", F.col("_listed"))
            .withColumn("is_active", F.when(unlisted, F.lit(False)).otherwise(F.col("_listed") | F.col("_jpx")))
            .drop("_listed", "_n_listed_vals", "_has_edinet", "_jpx"))


# ------------------------------------------------------------ lifecycle
def disappeared(new_master: DataFrame, old_master: DataFrame, run_ids: DataFrame) -> DataFrame:
    """M2 (D13 fixed): an identity present in the old master but absent from
    this run's identifiers is marked disappeared and inactive; nothing is
    deleted, and a returning company is no longer flagged."""
    old = old_master.select(F.col("identity_key").alias("_old")).distinct()
    seen = run_ids.select(F.col("id").alias("_seen")).distinct()
    out = (new_master.join(old, new_master["identity_key"] == old["_old"], "left")
           .join(seen, new_master["identity_key"] == seen["_seen"], "left"))
    gone = F.col("_old").isNotNull() & F.col("_seen").isNull()
    return (out.withColumn("is_disappeared", gone)
            .withColumn("is_active", F.when(gone, F.lit(False)).otherwise(F.col("is_active")))
            .drop("_old", "_seen"))


def listing_events(new_master: DataFrame, old_master: DataFrame, as_of: str, key: str = "code") -> DataFrame:
    """M3: active -> inactive is DELISTING; inactive -> active or a new active
    row is LISTING; rows without a key are skipped; distinct (key, type)."""
    old = latest_first(old_master.select(F.col(key).alias("_k"), F.col("is_active").alias("_was"), "pos")
                       .filter(F.col("_k").isNotNull()), ["_k"], ["pos"])
    n = new_master.filter(F.col(key).isNotNull())
    j = n.join(old, n[key] == old["_k"], "left")
    now = F.coalesce(F.col("is_active"), F.lit(True))
    was = F.coalesce(F.col("_was"), F.lit(True))
    typ = (F.when(F.col("_k").isNull(), F.when(now, F.lit("LISTING")))
           .when(was & ~now, F.lit("DELISTING")).when(~was & now, F.lit("LISTING")))
    return (j.select(F.col(key).alias("code"), typ.alias("type"))
            .filter(F.col("type").isNotNull()).distinct()
            .withColumn("event_date", F.lit(as_of)))


def definition_collect(master: DataFrame) -> DataFrame:
    """(type, code, name) definitions from the master, one per (type, code)
    (the first row in master order wins)."""
    parts = []
    for t, code_col, name_col in DEFINITION_TYPES:
        if code_col in master.columns:
            parts.append(master.filter(F.col(code_col).isNotNull()).select(
                F.lit(t).alias("type"), F.col(code_col).cast("string").alias("code"),
                F.col(name_col).alias("name"), "pos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return latest_first(out, ["type", "code"], ["pos"]).drop("pos")


def scd2_merge(existing: DataFrame, incoming: DataFrame, as_of: str) -> DataFrame:
    """Slowly changing definitions. A new (type, code) opens a row today;
    a changed name closes the open row yesterday and opens a new one; closed
    rows are kept; sorted by (type, code, valid_from) on output."""
    today = F.to_date(F.lit(as_of))
    yesterday = F.date_sub(today, 1)
    open_rows = existing.filter(F.col("valid_to").isNull())
    closed = existing.filter(F.col("valid_to").isNotNull())
    inc = incoming.select("type", "code", F.col("name").alias("_new"))
    j = open_rows.join(inc, ["type", "code"], "full_outer")
    changed = F.col("name").isNotNull() & F.col("_new").isNotNull() & ~F.col("name").eqNullSafe(F.col("_new"))
    new_code = F.col("valid_from").isNull()
    kept_open = j.filter(~new_code).select(
        "type", "code", "name", "valid_from",
        F.when(changed, yesterday.cast("string")).otherwise(F.col("valid_to")).alias("valid_to"))
    opened = j.filter(new_code | changed).select(
        "type", "code", F.col("_new").alias("name"), today.cast("string").alias("valid_from"),
        F.lit(None).cast("string").alias("valid_to"))
    return closed.unionByName(kept_open).unionByName(opened)


# ------------------------------------------------------------ master sync
def sync_master(current: DataFrame, code_list: DataFrame, exchange: DataFrame, agg_map: DataFrame,
                definitions: DataFrame, as_of: str, stage) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M1: (master, listing events, definitions) after one run over all sources.

    J17 -> U1 (code list, exchange list) -> J3 -> F10 -> P1/P14 -> J14 -> P5 -> F12 -> G6 -> G5 -> A10 -> M2 -> M3
    -> J15 -> G10. ``current``: GOLDEN_ATTRIBUTES, code, last_submitted_at, is_listed_edinet, is_active,
    identity_key, pos. ``code_list`` and ``exchange`` have a subset of these; ``pos`` numbers each source's rows.
    An incoming row needs a company name and an EDINET or security code, also after it took the
    master's values. ``stage`` writes a frame to the shared folder and reads it back."""
    attrs = [*GOLDEN_ATTRIBUTES, "last_submitted_at", "is_listed_edinet"]
    types = {f.name: f.dataType for f in current.schema.fields}

    def shaped(rows: DataFrame, priority: int, from_exchange: bool) -> DataFrame:
        cols = [F.col(c) if c in rows.columns else F.lit(None).cast(types[c]).alias(c) for c in ["code", *attrs]]
        pos = F.lit((priority + int(from_exchange)) << 40) + F.col("pos")  # the master's rows, the code list's, the exchange list's
        return rows.select(*cols, F.lit(from_exchange).alias("source_jpx"), F.lit(priority).alias("priority"), pos.alias("pos"))

    master = stage(former_codes(current, agg_map))
    listed = former_codes(shaped(code_list, 1, False), agg_map)
    incoming = listed.unionByName(shaped(exchange, 1, True))
    incoming = disposal(bridge_fill(incoming, code_list))
    incoming = stage(with_parent_code(incoming))
    run_ids = incoming.select(F.explode(F.array("jcn", "edinet_code", "code")).alias("id")).filter("id is not null")
    incoming = inherit_attributes(incoming, master, attrs)
    # in a step of its own, of one expression a column: each attribute is trimmed once
    incoming = incoming.withColumns({c: strip(c) for c in SENTINEL_ATTRIBUTES}).withColumns(
        {c: F.when(~F.lower(c).isin(*NULL_SENTINELS), F.col(c)) for c in SENTINEL_ATTRIBUTES})
    incoming = (incoming.withColumn("is_listed_edinet", F.coalesce("is_listed_edinet", F.lit(False)))
                .filter(F.col("company_name").isNotNull() & F.coalesce("edinet_code", "code").isNotNull()))
    states = stage(shaped(master, 0, False).unionByName(incoming))
    # the passes move the three keys alone; the wide rows meet their identity once
    ids = identity_keys(states.select("jcn", "edinet_code", "code", "pos")).select(F.col("pos").alias("_pos"), "identity_key")
    known = states.join(ids, states["pos"] == ids["_pos"]).drop("_pos")
    gold = stage(golden_record(known, list(GOLDEN_ATTRIBUTES)).drop("source_jpx", "priority", "pos"))
    new = stage(disappeared(gold, master.filter(F.col("identity_key").isNotNull()), run_ids))
    events = listing_events(new, master, as_of)
    defs = stage(definition_collect(new.withColumn("pos", F.col("identity_key"))))
    return name_sync(new, defs), events, scd2_merge(definitions, defs, as_of)


def with_parent_code(rows: DataFrame) -> DataFrame:
    """P1 + P14 on incoming master rows."""
    return rows.withColumn("code", normalize_code("code", "JP")).withColumn("parent_code", parent_code("code"))
