"""Filing verdicts, status lookups and filing-level filters.

SURVEY F1-F4, F8, F13, A3, A9, R4. One ``when`` chain replaces the
reference's per-row decision function; counts are one grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kaiji.functions.codes import code_core, col_, normalize_code

# Fixed values that must equal the reference's.
# Document types whose XBRL is parsed.
TARGET_DOC_TYPES = ("120", "130", "140", "150", "160", "170", "180", "190")
# Statuses that count as processed.
PROCESSED_STATUSES = ("success", "retracted", "english_empty", "attachment_empty")
# Verdicts and reasons.
PARSE, SAVE_RAW = "parse", "save_raw"
SKIP_PROCESSED, SKIP_OUT_OF_SCOPE, SKIP_WITHDRAWN = \
    "skip_already_processed", "skip_out_of_scope", "skip_withdrawn"
R_NONE, R_WITHDRAWN, R_PROCESSED = "none", "withdrawn", "already_processed"
R_NO_CODE, R_BAD_LEN, R_HAS_CODE, R_BAD_META = \
    "no_sec_code", "invalid_code_length", "has_sec_code", "invalid_metadata"
SCOPES = ("All", "Listed", "Unlisted")
# Annual-report filter (F4): doc type, ordinance, form.
ANNUAL_REPORT = ("120", "010", "030000")
# Allowed values (F13): column, values, whether null passes.
FILING_RULES = (("withdrawal_status", ("0", "1", "2"), False),
                ("doc_info_edit_status", ("0", "1", "2"), False),
                ("disclosure_status", ("0", "1", "2", "3"), False),
                ("xbrl_flag", ("0", "1"), False),
                ("pdf_flag", ("0", "1"), False),
                ("attach_flag", ("0", "1"), False),
                ("english_flag", ("0", "1"), False),
                ("csv_flag", ("0", "1"), False),
                ("legal_status", ("0", "1", "2"), False))
FACT_RULES = (("current_flg", ("0", "1"), True),
              ("non_consolidated_flg", ("0", "1"), True),
              ("prior_flg", ("0", "1"), True),
              ("isTextBlock_flg", ("0", "1"), True),
              ("abstract_flg", ("0", "1"), True),
              ("period_type", ("instant", "duration"), False))


def _vr(v: str, r: str) -> Column:
    return F.struct(F.lit(v).alias("v"), F.lit(r).alias("r"))


def _blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def with_status(filings: DataFrame, catalog: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """attach ``local_status`` (``unknown`` when absent) and ``is_processed``.

    The catalog grows with the data, so it is not broadcast by hint; AQE turns
    the join into a broadcast at run time when the catalog is small.
    """
    cat = catalog.select(F.col(id_col).alias("_cat_id"), F.col("processed_status").alias("_cat_status"))
    out = filings.join(cat, filings[id_col] == cat["_cat_id"], "left")
    status = F.coalesce(F.col("_cat_status"), F.lit("unknown"))
    return (out.withColumn("local_status", status)
            .withColumn("is_processed", F.col("local_status").isin(*PROCESSED_STATUSES))
            .drop("_cat_id", "_cat_status"))


def verdict(filings: DataFrame, scope: str = "All",
            target_types: tuple[str, ...] = TARGET_DOC_TYPES) -> DataFrame:
    """add ``verdict`` and ``reason``; first matching rule wins.

    Expects catalog-style columns submit_at, filer_name, doc_type, sec_code,
    xbrl_flag, withdrawal_status, doc_info_edit_status, is_processed,
    local_status (see :func:`with_status`). Also covers R4: a processed
    document that is now withdrawn and not yet retracted is re-decided.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    bad_meta = _blank(F.col("submit_at")) | _blank(F.col("filer_name")) | _blank(F.col("doc_type"))
    withdrawn = F.coalesce(F.col("withdrawal_status").cast("string") == "1", F.lit(False))
    local = F.col("local_status")
    processed_skip = F.coalesce(F.col("is_processed"), F.lit(False)) & \
        ~(withdrawn & (local.isNull() | (local != "retracted")))
    edited = F.coalesce(F.col("doc_info_edit_status").cast("string") == "2", F.lit(False))
    xbrl = F.coalesce(F.when(_blank(F.col("xbrl_flag")), F.lit("0"))
                      .otherwise(F.col("xbrl_flag").cast("string")) == "1", F.lit(False))
    # Materialise the normalised code once; the chain below refers to it
    # several times and would otherwise inline the whole expression.
    filings = filings.withColumn("_ncode", normalize_code(F.col("sec_code"), "JP"))
    norm = F.col("_ncode")
    core_len = F.length(code_core(norm))

    chain = (F.when(bad_meta, _vr(SKIP_OUT_OF_SCOPE, R_BAD_META))
             .when(processed_skip, _vr(SKIP_PROCESSED, R_PROCESSED))
             .when(withdrawn, _vr(SKIP_WITHDRAWN, R_WITHDRAWN))
             .when(edited, _vr(SKIP_OUT_OF_SCOPE, R_PROCESSED)))
    if scope == "Listed":
        chain = (chain.when(norm.isNull(), _vr(SKIP_OUT_OF_SCOPE, R_NO_CODE))
                 .when(core_len < 4, _vr(SKIP_OUT_OF_SCOPE, R_BAD_LEN)))
    elif scope == "Unlisted":
        chain = chain.when(norm.isNotNull() & (core_len >= 4),
                           _vr(SKIP_OUT_OF_SCOPE, R_HAS_CODE))
    chain = (chain.when(F.col("doc_type").isin(*target_types) & xbrl, _vr(PARSE, R_NONE))
             .otherwise(_vr(SAVE_RAW, R_NONE)))
    return (filings.withColumn("_vr", chain)
            .withColumn("verdict", F.col("_vr")["v"]).withColumn("reason", F.col("_vr")["r"])
            .drop("_vr", "_ncode"))


def counter_class(verdict_col="verdict", reason_col="reason") -> Column:
    """A3: map (verdict, reason) to the reference's counter names."""
    v, r = col_(verdict_col), col_(reason_col)
    return (F.when(v == PARSE, "parse").when(v == SAVE_RAW, "save")
            .when(v == SKIP_PROCESSED, "processed").when(v == SKIP_WITHDRAWN, "withdrawn")
            .when(r == R_BAD_LEN, "format_err").when(r.isin(R_NO_CODE, R_HAS_CODE), "no_code")
            .when(r == R_BAD_META, "invalid_meta").otherwise("processed"))


def verdict_counts(decided: DataFrame, extra_aggs: list[Column] | None = None) -> DataFrame:
    """A3: counts per (verdict, reason) with the counter class and adopted flag.

    Partial aggregation happens map-side; the shuffle carries one row per
    group and partition.
    """
    aggs = [F.count(F.lit(1)).alias("n_docs")] + list(extra_aggs or [])
    return (decided.groupBy("verdict", "reason").agg(*aggs)
            .withColumn("counter", counter_class())
            .withColumn("adopted", F.col("verdict").isin(PARSE, SAVE_RAW)))


def worker_balance(decided: DataFrame, outcome_col: str = "outcome") -> DataFrame:
    """assigned = skipped + saved + attempted; attempted = ok + failed.

    ``outcome`` is ``ok``/``failed`` for attempted parses (NULL otherwise).
    One aggregate with conditional counts; returns a single row with a
    ``balanced`` flag.
    """
    v = F.col("verdict")
    agg = decided.agg(
        F.count(F.lit(1)).alias("assigned"),
        F.count_if(v.startswith("skip")).alias("skipped"),
        F.count_if(v == SAVE_RAW).alias("saved"),
        F.count_if(v == PARSE).alias("attempted"),
        F.count_if((v == PARSE) & (F.col(outcome_col) == "ok")).alias("parse_ok"),
        F.count_if((v == PARSE) & (F.col(outcome_col) == "failed")).alias("parse_failed"),
    )
    return agg.withColumn(
        "balanced",
        (F.col("assigned") == F.col("skipped") + F.col("saved") + F.col("attempted"))
        & (F.col("attempted") == F.col("parse_ok") + F.col("parse_failed")))


def backfill_targets(catalog: DataFrame, target_types=TARGET_DOC_TYPES, limit: int | None = None) -> DataFrame:
    """F3 (+L2): XBRL documents of a target type, not yet success/retracted, with a stored archive.

    ``limit`` keeps the first N by doc id (the reference's optional first-N).
    """
    out = catalog.filter(
        F.col("xbrl_flag") & F.col("doc_type").isin(*target_types)
        & ~F.coalesce(F.col("processed_status"), F.lit("")).isin("success", "retracted")
        & F.col("raw_zip_path").isNotNull() & (F.col("raw_zip_path") != ""))
    if limit is not None:
        out = out.orderBy("doc_id").limit(limit)
    return out


def annual_reports(filings: DataFrame) -> DataFrame:
    """annual securities reports (type 120, ordinance 010, form 030000), edit status not 2."""
    t, o, f = ANNUAL_REPORT
    return filings.filter((F.col("doc_type") == t) & (F.col("ordinance_code") == o)
                          & (F.col("form_code") == f)
                          & ~F.coalesce(F.col("doc_info_edit_status") == "2", F.lit(False)))


def requested_docs(filings: DataFrame, requested: DataFrame, id_col: str = "doc_id"):
    """F8: (found rows, requested ids not found)."""
    return (filings.join(requested.select(id_col), id_col, "left_semi"),
            requested.join(filings.select(id_col), id_col, "left_anti"))


def domain_checks(df: DataFrame, rules: dict[str, tuple]) -> DataFrame:
    """``is_valid`` and ``reject_reason`` from allowed-value rules.

    ``rules`` maps a column to its allowed values; NULL fails. The first failing
    column names the reason. Split with ``filter(is_valid)`` / ``filter(~is_valid)``.
    """
    reason = None
    for c, allowed in rules.items():
        bad = ~F.coalesce(F.col(c).cast("string").isin(*[str(a) for a in allowed]), F.lit(False))
        reason = F.when(bad, F.lit(f"bad_{c}")) if reason is None else reason.when(bad, F.lit(f"bad_{c}"))
    return df.withColumn("reject_reason", reason).withColumn("is_valid", F.col("reject_reason").isNull())


def broken_rules(rules) -> Column:
    """names of the columns that break their rule, in the order of ``rules``: array<string>, empty if none does."""
    def bad(column, values, null_passes):
        return ~F.coalesce(F.col(column).cast("string").isin(*values), F.lit(null_passes))
    return F.filter(F.array(*[F.when(bad(*rule), F.lit(rule[0])) for rule in rules]), lambda x: x.isNotNull())


def split_by_rules(df: DataFrame, rules, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, rejects with ``broken_rules``, metrics), in one pass over ``df``.

    ``rules`` holds (column, allowed values, whether null passes). The rows are written to
    ``path`` once, in a folder for either side; the metrics (``rows``, ``rejects`` and the
    breaks of each rule by its column) are observed by that write, so nothing is read
    again to count. Repeated rows stay; an empty table gives two empty ones and zeros.
    ``df`` may have no column named ``broken_rules`` or ``is_valid``.
    """
    if taken := {"broken_rules", "is_valid"} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns of the input have reserved names: {sorted(taken)}")
    checked = df.withColumn("broken_rules", broken_rules(rules)).withColumn("is_valid", F.size("broken_rules") == 0)
    seen = Observation()
    counts = [F.count_if(F.array_contains("broken_rules", c)).alias(f"rule_{i}") for i, (c, _, _) in enumerate(rules)]
    observed = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("is_valid")).alias("rejects"), *counts)
    observed.write.partitionBy("is_valid").parquet(path)
    got = seen.get
    both = df.sparkSession.read.schema(checked.schema).parquet(path)
    metrics = {"rows": got["rows"], "rejects": got["rejects"]} | {c: got[f"rule_{i}"] for i, (c, _, _) in enumerate(rules)}
    return (both.filter("is_valid").drop("broken_rules", "is_valid"), both.filter("not is_valid").drop("is_valid"), metrics)
