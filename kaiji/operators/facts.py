"""Fact-table operators.

Facts are long (document x key x context) and are the largest table, so
every operator here is either a narrow projection, a join against a
dimension, or an aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.operators.catalog import latest_first

# Context markers for P15.
NON_CONSOLIDATED, CURRENT_YEAR, PRIOR_YEAR = "NonConsolidated", "CurrentYear", "Prior1Year"
LABEL_RATE_ALERT = 0.5
DAY_FOLDER_LIMIT = 7000

# Taxonomy namespace families in priority order, and the
# date markers with the taxonomy edition they identify (reference order).
TAXONOMY_FAMILIES = ("/taxonomy/jpcrp", "/taxonomy/jppfs", "/taxonomy/jpdei", "/taxonomy/jpsps", "ifrs.org", "/ifrs/")
TAXONOMY_DATES = (
    ("2025-11-01", "2026"), ("2024-11-01", "2025"), ("2023-12-01", "2024"), ("2022-11-01", "2023"),
    ("2021-11-01", "2022"), ("2020-11-01", "2021"), ("2019-11-01", "2020"), ("2019-02-28", "2019"),
    ("2018-02-28", "2018"), ("2017-02-28", "2017"), ("2016-02-29", "2016"), ("2015-03-31", "2015"),
    ("2013-08-31", "2014"),
    ("ifrs.org/taxonomy/2024-03-21", "2024"), ("ifrs.org/taxonomy/2023-03-23", "2023"),
    ("ifrs.org/taxonomy/2022-03-24", "2022"), ("ifrs.org/taxonomy/2021-03-24", "2021"),
    ("ifrs.org/taxonomy/2020-03-16", "2020"), ("ifrs.org/taxonomy/2019-03-27", "2019"),
    ("ifrs.org/taxonomy/2018-03-16", "2018"), ("ifrs.org/taxonomy/2017-03-09", "2017"),
    ("ifrs.org/taxonomy/2016-03-31", "2016"), ("ifrs.org/taxonomy/2015-03-11", "2015"),
    ("ifrs.org/taxonomy/2014-03-05", "2014"),
)


def context_flags(df: DataFrame, ctx: str = "context_ref") -> DataFrame:
    """0/1 flags from the context id."""
    c = F.col(ctx)
    return df.withColumns({
        "non_consolidated_flg": F.coalesce(c.contains(NON_CONSOLIDATED).cast("int"), F.lit(0)),
        "current_flg": F.coalesce(c.contains(CURRENT_YEAR).cast("int"), F.lit(0)),
        "prior_flg": F.coalesce(c.contains(PRIOR_YEAR).cast("int"), F.lit(0)),
    })


def numeric_prep(df: DataFrame) -> DataFrame:
    """P16 + P17 + P18: numeric value, context depth and imputed value.

    ``data`` = value as double (bad text -> NULL); ``context_ref_len`` = number
    of ``_`` parts; ``data_imputed``: missing -> 0, a true zero -> half a unit
    of the last reported digit (0.5 * 10^-decimals), else the value (D12: a
    real -1 stays -1)."""
    data = F.col("data_str").try_cast("double")
    dec = F.col("decimals").try_cast("double")
    return (df.withColumn("data", data)
            .withColumn("context_ref_len", F.size(F.split(F.col("context_ref"), "_")).cast("bigint"))
            .withColumn("data_imputed", F.when(F.col("data").isNull(), F.lit(0.0))
                        .when(F.col("data") == 0, F.lit(0.5) * F.pow(F.lit(10.0), -dec))
                        .otherwise(F.col("data"))))


def dedupe_facts(facts: DataFrame, keys: list[str], newest_first: list[Column | str]) -> DataFrame:
    """One fact per key, the newest submission first (D1: the newer row wins).

    ``newest_first`` is a total order (smallest first), of columns' names or expressions; computed with a
    grouped ``min`` of a struct so duplicates collapse map-side."""
    cols = facts.columns
    order = [c if isinstance(c, str) else f"_o{i}" for i, c in enumerate(newest_first)]
    d = facts.withColumns({o: c for o, c in zip(order, newest_first) if not isinstance(c, str)})
    return latest_first(d, keys, order).select(*cols)


def role_join(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Facts restricted to the keys of each role, with label and order;
    one output row per (fact, role). The account list is one row per
    (role, key), bounded by the taxonomy; AQE broadcasts it when small."""
    return facts.join(accounts, "key", "inner")


def unlinked(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Facts whose key is in no role, kept with NULL role and order."""
    keys = accounts.select("key").distinct()
    out = facts.join(keys, "key", "left_anti")
    for c, t in accounts.dtypes:
        if c != "key" and c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return out


def fact_table(facts: DataFrame, accounts: DataFrame, instance_label: Column | None = None) -> DataFrame:
    """M4 core: J4 + J5 (zero drop) in one left join, P15 flags and P19 label fallback."""
    allf = context_flags(facts.join(accounts, "key", "left").select(
        *facts.columns, *[accounts[c] for c in accounts.columns if c != "key"]))
    if instance_label is not None and "label_en" in allf.columns:
        allf = allf.withColumn("label_en", F.coalesce(F.col("label_en"), instance_label))
    return allf


def fact_quality(table: DataFrame, facts: DataFrame, accounts: DataFrame, doc: str = "docid",
                 label: str = "label_en", text_flag: str = "isTextBlock_flg") -> DataFrame:
    """A5 + A6 + A7 per document: rows, label resolution rate (alert below
    0.5), matched + unlinked rows against the count expected from the input
    facts and the roles of their keys, and the number/text split."""
    per_doc = table.groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("role").isNotNull()).alias("n_matched"),
        F.count_if(F.col("role").isNull()).alias("n_unlinked"),
        F.count_if(F.col(label).isNotNull()).alias("n_labelled"),
        F.count_if(F.col(text_flag) == 1).alias("n_text"),
        F.count_if(F.col(text_flag) != 1).alias("n_number"))
    roles = accounts.groupBy("key").agg(F.count(F.lit(1)).alias("n_roles"))
    src = facts.join(roles, "key", "left").groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_facts"), F.sum(F.coalesce("n_roles", F.lit(1))).alias("n_expected"))
    return (per_doc.join(src, doc, "left")
            .withColumn("label_rate", F.round(F.col("n_labelled") / F.col("n_rows"), 6))
            .withColumn("label_alert", F.col("n_labelled") / F.col("n_rows") < LABEL_RATE_ALERT)
            .withColumn("balanced", F.col("n_matched") + F.col("n_unlinked") == F.col("n_expected")))


def day_folder_load(paths: DataFrame, path_col: str = "zip_repo_path", limit: int = DAY_FOLDER_LIMIT) -> DataFrame:
    """Files per ``year=/month=/day=`` folder above a warning threshold."""
    folder = F.regexp_extract(F.col(path_col), r"^(.*/day=[^/]+)/", 1)
    return (paths.withColumn("folder", folder).filter(F.col("folder") != "")
            .groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"))
            .filter(F.col("n_files") > limit))


# Columns carried forward within a document, then within a key.
FILL_BY_DOCUMENT = ("decimals", "precision", "context_ref", "unit", "period_start", "period_end", "instant_date", "order",
                    "non_consolidated_flg", "current_flg", "prior_flg", "role", "filer_name", "sector_label_33")
FILL_BY_KEY = ("element_name", "isTextBlock_flg", "abstract_flg", "label_jp")


def _last_of_bucket(rows: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The last non-NULL values of each bucket ``_fb`` of a key; ``_ord``: the rows' order."""
    return rows.groupBy("_fb", key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_ord"))).alias(f"_last_{c}") for c in cols])


def _carried(last: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The last non-NULL values before each bucket."""
    before = Window.partitionBy(key).orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    return last.select(F.col(key).alias("_ck"), F.col("_fb").alias("_cb"),
                       *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])


def _filled(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """The fill inside (key, ``_fb``)."""
    w_in = Window.partitionBy("_fb", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w_in) for c in cols})


def _take_carried(filled: DataFrame, carried: DataFrame, key: str, cols: list[str], names: list[str]) -> DataFrame:
    out = {c: F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) for c in cols}
    same = F.col(key).eqNullSafe(F.col("_ck")) & (F.col("_fb") == F.col("_cb"))
    return filled.join(carried, same, "left").select(*[out.get(c, F.col(c)) for c in names])


def fill_forward(df: DataFrame, key: str, order: list[str], cols: list[str], bucket: Column) -> DataFrame:
    """G7 (D12 fixed: per key, not global): carry the last non-NULL value of
    each column forward in ``order`` within ``key``.

    ``bucket`` must be non-decreasing in ``order``. The fill runs inside
    (key, bucket) partitions; values carried across buckets come from a
    per-bucket summary (partial aggregate), so a huge key is split across
    tasks instead of sorted in one. ``order`` sees the values before the fill."""
    d = df.withColumn("_fb", bucket)
    carried = _carried(_last_of_bucket(d.withColumn("_ord", F.struct(*order)), key, cols), key, cols)
    return _take_carried(_filled(d, key, order, cols), carried, key, cols, df.columns)


# Ranges for each shuffle partition, and sampled rows for each range, that split large keys.
RANGES, SAMPLED = 4, 30


def range_sample(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows, bounded by the number of ranges, of which ``key_cuts`` takes borders; one sample serves several orders of its columns."""
    spark, n = df.sparkSession, df.count()
    wanted = RANGES * SAMPLED * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*columns).sample(min(1.0, wanted / max(1, n)), seed=7)


def key_cuts(sample: DataFrame, key: str, order: list[str], stage) -> DataFrame:
    """(key, cuts): the borders in ``order`` that split the keys with a large share of the rows.

    Every ``SAMPLED``-th row of a key in a sorted sample (``range_sample``) is a border, so a key without one holds at most about a
    range's rows. ``stage`` fixes the borders, so every later reading of the rows deals them alike."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    borders = sample.select(key, *order).withColumn("_place", place).filter(F.col("_place") % SAMPLED == 0)
    cuts = borders.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))
    return stage(cuts)


def bucket_of(at: str, cuts: str, most: int = 2**31 - 1) -> Column:
    """How many of the sorted ``cuts``, at ``most`` so many, are at or before ``at``, by a search in halving steps; 0 without cuts.

    A step is one comparison and no new struct: it is interpreted for every row."""
    def further(found, step):
        return F.when((step <= F.size(cuts) - found) & (F.element_at(cuts, found + step) <= F.col(at)), found + step).otherwise(found)

    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.when(F.col(cuts).isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), further))


def fill_forward_ranges(df: DataFrame, key: str, order: list[str], cols: list[str], stage, source: DataFrame | None = None,
                        sample: DataFrame | None = None) -> DataFrame:
    """G7 for keys of any size and values: large keys are split at borders taken from a sample (``key_cuts``), so rows
    are dealt and sorted once. ``source``: the rows of ``df`` with the same key, order and columns as derived before
    other fills; borders and summary then read only the columns that they need of it. ``sample``: a ``range_sample`` of
    those rows with key and order, if there is one. ``stage`` writes a frame to the shared folder and reads it back, which
    also tells Spark how small it is."""
    rows = df if source is None else source
    cuts = key_cuts(range_sample(rows, [key, *order]) if sample is None else sample, key, order, stage)
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    if most is None:  # no key holds more than a range
        return _filled(df.withColumn("_fb", F.lit(0)), key, order, cols).drop("_fb")

    def dealt(d: DataFrame, how: str) -> DataFrame:
        d = d.join(cuts, F.col(key).eqNullSafe(F.col("_key")), how).withColumn("_ord", F.struct(*order))
        return d.withColumn("_fb", bucket_of("_ord", "_cuts", most)).drop("_key", "_cuts")

    last = stage(_last_of_bucket(dealt(rows, "inner").select(key, "_fb", "_ord", *cols), key, cols))
    carried = stage(_carried(last, key, cols))
    return _take_carried(_filled(dealt(df, "left").drop("_ord"), key, order, cols), carried, key, cols, df.columns)


def accounting_standard(facts: DataFrame, catalog: DataFrame, std_key: str, newest: list[Column],
                        doc: str = "docid", cat_doc: str = "doc_id") -> DataFrame:
    """The standard reported by a document's own fact is copied to its
    catalog row (one value per document, the newest fact wins)."""
    std = (facts.filter(F.col("key") == std_key)
           .groupBy(doc).agg(F.min_by(F.col("data_str"), F.struct(*newest)).alias("accounting_standard")))
    return catalog.join(std.withColumnRenamed(doc, cat_doc), cat_doc, "left")


def taxonomy_year(heads: DataFrame, doc: str = "doc", head: str = "head") -> DataFrame:
    """Per document, the first (family priority, then date-marker order)
    schema head that carries a known date marker gives the taxonomy year;
    otherwise ``-``. The fixed lists are constant expressions, so each head is
    ranked in place and only the per-document minimum is shuffled."""
    def first(found: list[str]) -> Column:
        rank = F.lit(None).cast("int")
        for i, text in reversed(list(enumerate(found))):
            rank = F.when(F.col(head).contains(text), F.lit(i)).otherwise(rank)
        return rank

    years = F.array(*[F.lit(y) for _, y in TAXONOMY_DATES])
    ranked = heads.select(doc, head, first(list(TAXONOMY_FAMILIES)).alias("fam"), first([p for p, _ in TAXONOMY_DATES]).alias("mark"))
    known = F.when(F.col("fam").isNotNull() & F.col("mark").isNotNull(), F.struct("fam", "mark", head))
    year = F.min_by(F.element_at(years, F.col("mark") + 1), known)
    return ranked.groupBy(doc).agg(F.coalesce(F.when(F.count(known) > 0, year), F.lit("-")).alias("taxonomy_year"))
