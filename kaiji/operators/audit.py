"""Integrity audit layers and repairs.

Every layer returns anomaly rows as a DataFrame (and, where the reference
repairs, the repaired rows); the report is one aggregate over their union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kaiji.functions.dates import repo_path

# API fields compared by the drift layer (local name).
DRIFT_FIELDS = ("submit_at", "doc_type", "ordinance_code", "form_code", "withdrawal_status")
ASSET_LIMIT_YEARS = 10
NO_BIN = "No"  # fixed value: the bin of documents without an identifier, which need not exist


def schema_diff(df: DataFrame, schema: StructType) -> tuple[list[str], list[str]]:
    """U4: (missing, extra) column names; metadata only, no data is read."""
    have = set(df.columns)
    want = [f.name for f in schema.fields]
    return [c for c in want if c not in have], [c for c in df.columns if c not in set(want)]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """U4 / X4 repair: add missing columns as NULL, drop extra ones, order and
    cast (``try_cast``: a value that does not fit becomes NULL)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def asset_audit(catalog: DataFrame, listing: DataFrame, as_of: str, flag: str = "xbrl_flag",
                path: str = "raw_zip_path", limit_years: int = ASSET_LIMIT_YEARS) -> DataFrame:
    """Ghosts (flag false, path set) and missing files (flag true and
    the expected path is absent from the repository listing).

    Repairs (D5, D22 fixed): a ghost loses its path and a zip ghost becomes
    ``invalid``; a missing file becomes ``pending``, or ``unrecoverable``
    when older than the history limit. Rows that are neither a ghost nor
    expect a file leave before the join, with the columns that no issue needs."""
    lst = listing.select(F.col("path").alias("_listed")).distinct()
    expected = F.coalesce(F.col(path), repo_path("doc_id", "submit_at", "zip"))
    ghost = ~F.col(flag) & F.col(path).isNotNull()
    c = catalog.filter(F.col(flag) | ghost).select("doc_id", "submit_at", flag, path, F.when(F.col(flag), expected).alias("_expected"))
    # ghosts expect no file: they get keys of their own, match nothing and don't meet in one task
    key = F.coalesce("_expected", F.concat(F.lit("\u0000"), F.coalesce("doc_id", F.col(path))))
    c = c.join(lst, key == F.col("_listed"), "left")
    limit = F.add_months(F.to_date(F.lit(as_of)), -12 * limit_years)
    missing = F.col(flag) & F.col("_listed").isNull()
    old = F.to_date("submit_at") < limit
    issue = F.when(ghost, "ghost").when(missing, "missing")
    status = (F.when(ghost, "invalid").when(missing & old, "unrecoverable").when(missing, "pending"))
    return (c.withColumn("issue", issue).filter(F.col("issue").isNotNull())
            .select("doc_id", "issue", F.col("_expected").alias("expected_path"),
                    status.alias("repaired_status"),
                    F.when(ghost, F.lit(None).cast("string")).otherwise(F.col(path)).alias("repaired_path")))


def bin_audit(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per bin, expected documents absent from the bin (missing),
    documents in the bin that are not expected (orphan), and expected bins
    without any file (missing_bin). Inputs: (bin_id, doc_id).

    One full outer join on (bin, doc) classifies both sides; the wholly
    missing bins come from one aggregate over the joined rows."""
    e = expected.select("bin_id", "doc_id").distinct().withColumn("_e", F.lit(True))
    a = actual.select("bin_id", "doc_id").distinct().withColumn("_a", F.lit(True))
    j = e.join(a, ["bin_id", "doc_id"], "full_outer")
    kind = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "orphan")
    docs = j.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("bin_id", "doc_id", "kind")
    gone = (j.groupBy("bin_id").agg(F.bool_or(F.coalesce("_e", F.lit(False))).alias("_has_e"),
                                    F.bool_or(F.coalesce("_a", F.lit(False))).alias("_has_a"))
            .filter(F.col("_has_e") & ~F.col("_has_a") & (F.col("bin_id") != NO_BIN))
            .select("bin_id", F.lit(None).cast("string").alias("doc_id"), F.lit("missing_bin").alias("kind")))
    return docs.unionByName(gone)


def _past_limit(as_of: str, limit_years: int) -> Column:
    return F.to_date("submit_at") < F.add_months(F.to_date(F.lit(as_of)), -12 * limit_years)


def repair_assets(catalog: DataFrame, listing: DataFrame, as_of: str, limit_years: int = ASSET_LIMIT_YEARS) -> DataFrame:
    """M7 / J12 over archives and PDFs: (doc_id, raw_zip_path, pdf_path, processed_status, issues).

    A flag demands its file at the repository path (an unknown flag does if a path is stored). A path without
    its flag is a ghost and goes; an archive ghost makes the row ``invalid``. A missing file makes it ``pending``,
    or ``unrecoverable`` beyond the history limit. Rows without a submission time demand nothing. The listing is
    reduced to the documents' files before the join, so each kind of file costs one equi-join."""
    lst = listing.select(F.col("path").alias("_listed")).distinct()
    out, issues = catalog, []
    for kind, flag, path in (("zip", "xbrl_flag", "raw_zip_path"), ("pdf", "pdf_flag", "pdf_path")):
        wanted = F.coalesce(F.col(flag), F.col(path).isNotNull()) & F.col("submit_at").isNotNull()
        place = F.when(wanted, repo_path("doc_id", "submit_at", kind))
        out = out.withColumn("_want", place)
        # rows that demand nothing get keys of their own: they match nothing and don't meet in one task
        key = F.coalesce("_want", F.concat(F.lit("\u0000"), "doc_id"))
        out = out.join(lst, key == F.col("_listed"), "left").withColumn(f"_{kind}_missing", F.col("_want").isNotNull() & F.col("_listed").isNull())
        out = out.withColumn(f"_{kind}_ghost", F.coalesce(~F.col(flag), F.lit(False)) & F.col(path).isNotNull()).drop("_want", "_listed")
        out = out.withColumn(path, F.when(F.col(f"_{kind}_ghost"), F.lit(None).cast("string")).otherwise(F.col(path)))
        issues += [F.when(F.col(f"_{kind}_{what}"), f"{what} {kind}") for what in ("missing", "ghost")]
    missing = F.col("_zip_missing") | F.col("_pdf_missing")
    status = (F.when(missing & _past_limit(as_of, limit_years), "unrecoverable").when(missing, "pending")
              .when(F.col("_zip_ghost"), "invalid").otherwise(F.col("processed_status")))
    return out.select("doc_id", "raw_zip_path", "pdf_path", status.alias("processed_status"), F.concat_ws(", ", *issues).alias("issues"))


def repair_bin_status(catalog: DataFrame, audit: DataFrame, as_of: str, limit_years: int = ASSET_LIMIT_YEARS) -> DataFrame:
    """M8 repair of the catalog: a document missing from its bin becomes ``pending``, or ``unrecoverable`` beyond the
    history limit; all documents of a bin that is wholly gone become ``pending``. ``audit``: as of ``bin_audit``."""
    gone = audit.filter("kind = 'missing_bin'").select(F.col("bin_id").alias("_gone"))
    lost = (audit.filter("kind = 'missing'").join(gone, F.col("bin_id") == F.col("_gone"), "left")
            .groupBy(F.col("doc_id").alias("_lost")).agg(F.bool_or(F.col("_gone").isNotNull()).alias("_whole")))
    status = (F.when(F.col("_whole"), "pending").when(F.col("_lost").isNull() | F.col("submit_at").isNull(), F.col("processed_status"))
              .when(_past_limit(as_of, limit_years), "unrecoverable").otherwise("pending"))
    return catalog.join(lost, F.col("doc_id") == F.col("_lost"), "left").withColumn("processed_status", status).drop("_lost", "_whole")


def purge_orphans(facts: DataFrame, audit: DataFrame) -> DataFrame:
    """M8 repair of the bins: the rows (bin_id, doc_id, ...) of documents that don't belong to their bin go."""
    return facts.join(audit.filter("kind = 'orphan'").select("bin_id", "doc_id"), ["bin_id", "doc_id"], "left_anti")


def duplicate_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """Groups of rows that repeat on ``cols`` with their count (report);
    partial aggregation keeps hot groups cheap."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def remove_duplicates(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """G13 repair: one row per ``cols`` stays, the first by ``order``."""
    from kaiji.operators.catalog import latest_first
    return latest_first(df, cols, order).select(*df.columns)


def schema_issues(df: DataFrame, schema: StructType) -> list[tuple[str, str]]:
    """M6 / M10 detection: (column, issue) for columns that are missing, extra
    or of another type; metadata only."""
    missing, extra = schema_diff(df, schema)
    types = dict(df.dtypes)
    wrong = [f.name for f in schema.fields if f.name in types and types[f.name] != f.dataType.simpleString()]
    return [(c, "missing") for c in missing] + [(c, "extra") for c in extra] + [(c, "type") for c in wrong]


def drift(catalog: DataFrame, api: DataFrame, fields=DRIFT_FIELDS, id_col: str = "doc_id") -> DataFrame:
    """For ids present on both sides, each field compared as a
    trimmed string; withdrawal status NULL / blank / 0 are equal. One join by
    id; only the mismatches become rows (doc_id, field, local_value, api_value)."""
    def texts(df, side):
        return df.select(id_col, *[F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")).alias(f"_{side}_{f}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_local_{f}").alias("local_value"), F.col(f"_api_{f}").alias("api_value"))
                      for f in fields])

    def differs(p):
        none = p["local_value"].isin("", "0", "None") & p["api_value"].isin("", "0", "None")
        return (p["local_value"] != p["api_value"]) & ~((p["field"] == "withdrawal_status") & none)

    both = texts(catalog, "local").join(texts(api, "api"), id_col)
    return both.select(id_col, F.inline(F.filter(pairs, differs)))


def repair_drift(catalog: DataFrame, mismatches: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """M9 repair: the API value replaces the local one, per field (of several
    API rows of an id, the greatest value)."""
    fixes = mismatches.groupBy(id_col).pivot("field", list(DRIFT_FIELDS)).agg(F.max("api_value"))
    fixes = fixes.select(id_col, *[F.col(f).alias(f"_fix_{f}") for f in DRIFT_FIELDS])
    out = catalog.join(fixes, id_col, "left")
    for f in DRIFT_FIELDS:
        out = out.withColumn(f, F.coalesce(F.col(f"_fix_{f}"), F.col(f).cast("string"))).drop(f"_fix_{f}")
    return out


def audit_report(anomalies: DataFrame, repair: bool) -> DataFrame:
    """Per layer and overall: anomaly count, distinct repaired
    objects and the status (PASSED, FAILED or REPAIRED). Input columns:
    layer, object_id."""
    # One pass: ROLLUP gives the per-layer rows and the grand total together.
    out = (anomalies.rollup("layer").agg(F.count(F.lit(1)).alias("n_anomalies"),
                                         F.countDistinct("object_id").alias("n_objects"))
           .withColumn("layer", F.coalesce("layer", F.lit("ALL"))))
    # A clean audit still reports its total (ROLLUP over no rows gives none);
    # this last aggregate sees at most one row per layer.
    zero = anomalies.sparkSession.createDataFrame([("ALL", 0, 0)], "layer string, n_anomalies long, n_objects long")
    out = out.unionByName(zero).groupBy("layer").agg(F.max("n_anomalies").alias("n_anomalies"),
                                                     F.max("n_objects").alias("n_objects"))
    status = F.when(F.col("n_anomalies") == 0, "PASSED").otherwise(F.lit("REPAIRED" if repair else "FAILED"))
    return out.withColumn("status", status).withColumn(
        "n_repaired", F.col("n_objects") if repair else F.lit(0).cast("bigint"))
