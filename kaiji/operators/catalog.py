"""Document-catalog operators.

One-row-per-key results are computed with aggregates (``max`` of a struct /
``max_by``) instead of ``row_number`` windows: the partial aggregate runs
map-side, so a key holding a large share of the rows is reduced before the
shuffle and never sorted inside a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.functions.codes import normalize_code, strip
from kaiji.functions.dates import fiscal_year, is_amendment, num_months, parse_datetime, repo_path

# Status precedence (lower wins); unknown statuses rank 99.
STATUS_RANK = {
    "retracted": 1,
    "failure": 2,
    "english_empty": 3,
    "attachment_empty": 4,
    "parsed": 5,
    "success": 6,
}
UNKNOWN_RANK = 99
DEFAULT_FILER = "Unknown"
SOURCE_NAME = "EDINET"


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """G1: keep, per key, the row with the greatest ``order`` tuple (the latest
    batch / ordinal). Ties on ``order`` resolve by the remaining columns, so
    the result is deterministic."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("_row"))
    out = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return out.select(*keys, *[F.col("_w")[c].alias(c) for c in order],
                      *[F.col("_w")["_row"][c].alias(c) for c in rest])


def status_rank(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    expr = F.lit(UNKNOWN_RANK)
    for s, r in STATUS_RANK.items():
        expr = F.when(col == s, F.lit(r)).otherwise(expr)
    return expr


def status_precedence(df: DataFrame, key: str, status: str, order: list[str]) -> DataFrame:
    """Per key, the most severe status; among equal ranks the first seen
    (by ``order``) stays, as an update only replaces on a strictly lower rank."""
    w = F.struct(status_rank(status).alias("rank"), *[F.col(c) for c in order], F.col(status).alias("s"))
    return (df.groupBy(key).agg(F.min(w).alias("_m"), F.count(F.lit(1)).alias("n_updates"))
            .select(key, F.col("_m")["s"].alias("final_status"), F.col("_m")["rank"].alias("status_rank"),
                    "n_updates"))


def promote_parsed(catalog: DataFrame, failed_bins: DataFrame, bin_col: str = "bin_id") -> DataFrame:
    """``parsed`` becomes ``success`` unless its bin failed, then ``failure``.

    ``failed_bins`` holds one row per failed bin (bounded by the bin count, a
    few hundred); Spark broadcasts it if its measured size allows.
    """
    fb = failed_bins.select(F.col(bin_col).alias("_fb")).distinct()
    out = catalog.join(fb, F.col(bin_col) == F.col("_fb"), "left")
    st = F.col("processed_status")
    return out.withColumn(
        "processed_status",
        F.when(st == "parsed", F.when(F.col("_fb").isNull(), F.lit("success")).otherwise(F.lit("failure")))
        .otherwise(st)).drop("_fb")


def catalog_record(filings: DataFrame) -> DataFrame:
    """Filing-list rows to catalog records of 41 fields (plus P2, P10-P12) and the path of the archive.

    Fields that the list lacks are NULL (flags false). ``processed_status`` is the first status of a decided
    row (F1): retracted if withdrawn, else the anomaly found while saving, else success; NULL without a verdict.
    ``accounting_standard`` is filled after parsing (J18)."""
    def raw(c):
        return F.col(c) if c in filings.columns else F.lit(None).cast("string")

    def blank_null(c, out=None):
        s = strip(raw(c))
        return F.when(s != "", s).alias(out or c)

    def flag(c, out=None):
        return F.coalesce(raw(c) == "1", F.lit(False)).alias(out or c)

    status = F.when(F.col("verdict") == "skip_withdrawn", "retracted").otherwise(F.coalesce(raw("anomaly_status"), F.lit("success"))) \
        if "verdict" in filings.columns else F.lit(None).cast("string")
    return filings.select(
        "doc_id",
        blank_null("jcn"),
        normalize_code("sec_code", "JP").alias("code"),
        F.coalesce(blank_null("filer_name"), F.lit(DEFAULT_FILER)).alias("company_name"),
        blank_null("filer_name_en", "company_name_en"),
        blank_null("filer_name_kana", "company_name_kana"),
        blank_null("edinet_code"),
        blank_null("issuer_edinet_code"),
        blank_null("subject_edinet_code"),
        blank_null("subsidiary_edinet_code"),
        blank_null("fund_code"),
        parse_datetime("submit_at").alias("submit_at"),
        F.col("seq_number"),
        fiscal_year("period_end").alias("fiscal_year"),
        blank_null("period_start"),
        blank_null("period_end"),
        num_months("period_start", "period_end").alias("num_months"),
        F.lit(None).cast("string").alias("accounting_standard"),
        F.coalesce(F.col("doc_type"), F.lit("")).alias("doc_type"),
        blank_null("title"),
        blank_null("form_code"),
        blank_null("ordinance_code"),
        is_amendment("parent_doc_id", "doc_type", "title").alias("is_amendment"),
        blank_null("parent_doc_id"),
        blank_null("withdrawal_status"),
        blank_null("doc_info_edit_status"),
        blank_null("disclosure_status"),
        blank_null("legal_status"),
        blank_null("current_report_reason"),
        flag("xbrl_flag"),
        flag("pdf_flag"),
        flag("csv_flag"),
        flag("english_flag"),
        flag("attach_flag", "attachment_flag"),
        blank_null("raw_zip_path"),
        blank_null("pdf_path"),
        blank_null("english_path"),
        blank_null("attach_path"),
        status.alias("processed_status"),
        F.lit(SOURCE_NAME).alias("source"),
        blank_null("ope_date_time"),
        repo_path("doc_id", "submit_at", "zip").alias("zip_repo_path"),
    )


def cleanup(catalog: DataFrame, strict: bool = False) -> DataFrame:
    """a bare ``JP:`` code becomes NULL; rows without a submit date are dropped.
    F6 (``strict``): also drop blank/Unknown company names and blank doc types."""
    code = F.when(strip("code") == "JP:", F.lit(None).cast("string")).otherwise(F.col("code"))
    out = catalog.withColumn("code", code).filter(
        F.col("submit_at").isNotNull() & (F.col("submit_at").cast("string") != ""))
    if strict:
        name = strip("company_name")
        out = out.filter(name.isNotNull() & (name != "") & (name != DEFAULT_FILER)
                         & F.col("doc_type").isNotNull() & (strip("doc_type") != ""))
    return out


def master_freshness(master: DataFrame, catalog: DataFrame, master_id: str = "ordinal") -> DataFrame:
    """A1: latest submission per code pushed into the master when newer (string
    order). A master code ``X`` (no prefix) is also reachable as ``JP:X``; a
    prefixed one also by its bare core.

    Master aliases are exploded and equi-joined to the per-code maxima (one
    row per code, aggregated map-side first), so no OR-join is needed.
    """
    # Aggregate first, then drop blank codes: max() skips NULL times, the
    # partial aggregate absorbs the code-less rows, and a filter on the
    # derived code is not pushed into the scan stage.
    latest = (catalog.groupBy("code").agg(F.max(F.col("submit_at").cast("string")).alias("_latest"))
              .filter(F.col("code").isNotNull() & (strip("code") != "") & F.col("_latest").isNotNull()))
    mc = F.col("code").cast("string")
    aliases = F.when(mc.isNull() | (strip(mc) == ""), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array(mc, F.when(F.instr(mc, ":") > 0, F.substring_index(mc, ":", -1))
                                 .otherwise(F.concat(F.lit("JP:"), mc)))))
    keys = master.select(master_id, F.explode(aliases).alias("_alias"))
    hits = (keys.join(latest, keys["_alias"] == latest["code"]).groupBy(master_id)
            .agg(F.max("_latest").alias("_latest")))
    cur = F.col("last_submitted_at").cast("string")
    out = master.join(hits, master_id, "left")
    newer = F.col("_latest").isNotNull() & (cur.isNull() | (cur == "") | (F.col("_latest") > cur))
    return (out.withColumn("updated", newer)
            .withColumn("last_submitted_at", F.when(newer, F.col("_latest")).otherwise(cur))
            .drop("_latest"))


def high_water_mark(catalog: DataFrame, col: str = "ope_date_time", overlap_hours: int = 1) -> DataFrame:
    """A2 (D15 fixed): max operation time minus the overlap, as a full timestamp."""
    ts = parse_datetime(F.col(col).cast("string"))
    return catalog.agg(F.max(ts).alias("max_ope")).select(
        "max_ope", (F.col("max_ope") - F.make_dt_interval(hours=F.lit(overlap_hours))).alias("fetch_from"))


def work_list(decided: DataFrame, h_start_date: str | None, ordinal: str = "seq_number") -> DataFrame:
    """Adopted filings as work rows, split into ``primary`` and ``retry``
    (submitted before the history start); an id appears once, primary first,
    then first seen."""
    adopted = decided.filter(F.col("verdict").isin("parse", "save_raw"))
    sub_date = F.to_date(parse_datetime(F.col("submit_at").cast("string")))
    lst = F.lit("primary") if h_start_date is None else \
        F.when(sub_date.isNotNull() & (sub_date < F.to_date(F.lit(h_start_date))), "retry").otherwise("primary")
    rows = adopted.select(
        F.col("doc_id").alias("id"), normalize_code("sec_code", "JP").alias("code"),
        F.col("edinet_code").alias("edinet"),
        F.coalesce(F.col("xbrl_flag") == "1", F.lit(False)).alias("xbrl"),
        F.col("doc_type").alias("type"), F.col("ordinance_code").alias("ord"),
        F.col("form_code").alias("form"), lst.alias("list"), F.col(ordinal).alias("_ord"))
    rows = rows.withColumn("_lrank", F.when(F.col("list") == "primary", 0).otherwise(1))
    return latest_first(rows, ["id"], ["_lrank", "_ord"]).drop("_lrank", "_ord")


def latest_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the row with the smallest ``order`` tuple (first seen)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("_row"))
    out = df.groupBy(*keys).agg(F.min(packed).alias("_w"))
    return out.select(*keys, *[F.col("_w")[c].alias(c) for c in order],
                      *[F.col("_w")["_row"][c].alias(c) for c in rest])
