"""File sources: Spark readers with declared schemas.

Header discovery (S5) and key derivation (S9) look at column names or file
paths only; data never passes through the driver.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kaiji.fs import exists, folders
from kaiji.functions.codes import listed_flag, normalize_code, percent_weight, safe_int_str, strip, yes_no_flag

# Header words of the index-weight files.
CODE_HEADER = re.compile(r"コード|Code")
WEIGHT_HEADER = re.compile(r"ウエイト|ウエート|Weight")
CSV_ENCODING = "windows-31j"


def load_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table read with its declared schema; a missing table is an
    empty table of that schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers of a table kept as folders ``v=<n>``, oldest first."""
    return sorted(int(n[2:]) for n in folders(spark, root) if re.fullmatch(r"v=\d+", n))


def load_version(spark: SparkSession, root: str, version: int, schema: StructType | None = None) -> DataFrame:
    """The table as of one version."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/v={version}")


def latest_healthy_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest version, from the second-newest down, that holds rows,
    with its row count. All older versions are candidates; the newest one is
    filtered out by its folder before the grouped scan."""
    found = versions(spark, root)
    older = spark.read.parquet(root).filter(F.col("v") < found[-1]) if found else spark.createDataFrame([], "v bigint")
    counts = older.groupBy(F.col("v").cast("bigint").alias("version")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.agg(F.max("version").alias("version"), F.max_by("n_rows", "version").alias("n_rows"))


def read_responses(spark: SparkSession, path: str, result_schema: StructType) -> DataFrame:
    """S3 + S4: JSON-lines API responses; successful days only, one row per
    filing of ``results``, stamped with the access date."""
    schema = StructType.fromJson({"type": "struct", "fields": [
        {"name": "date", "type": "string", "nullable": True, "metadata": {}},
        {"name": "status", "type": "string", "nullable": True, "metadata": {}},
        {"name": "message", "type": "string", "nullable": True, "metadata": {}},
        {"name": "results", "type": {"type": "array", "elementType": result_schema.jsonValue(),
                                     "containsNull": True}, "nullable": True, "metadata": {}}]})
    from kaiji.functions.dates import lenient_date
    r = spark.read.schema(schema).json(path)
    return (r.filter(F.col("status") == "success")
            .select(lenient_date("date").cast("string").alias("access_date"), F.explode("results").alias("d"))
            .select("access_date", "d.*"))


def read_index_csv(spark: SparkSession, path: str, encoding: str = CSV_ENCODING) -> DataFrame:
    """Index weights. The code and weight columns are found by header
    regex; footnote rows (no code or weight) are dropped; ``%`` weights parsed."""
    raw = spark.read.option("header", True).option("encoding", encoding).csv(path)
    code_col = next(c for c in raw.columns if CODE_HEADER.search(c))
    weight_col = next(c for c in raw.columns if WEIGHT_HEADER.search(c))
    out = raw.select(strip(F.col(f"`{code_col}`")).alias("code"), F.col(f"`{weight_col}`").alias("w"),
                     *[F.col(f"`{c}`") for c in raw.columns if c not in (code_col, weight_col)])
    out = out.filter(F.col("code").isNotNull() & (F.col("code") != "") & F.col("w").isNotNull())
    return out.withColumn("weight", percent_weight("w")).drop("w")


# Headers of the official code list and the kaiji column names.
CODE_LIST_COLUMNS = (("ＥＤＩＮＥＴコード", "edinet_code"), ("提出者種別", "submitter_type"), ("上場区分", "is_listed_edinet"),
                     ("連結の有無", "is_consolidated"), ("資本金", "capital"), ("決算日", "settlement_date"),
                     ("提出者名", "company_name"), ("提出者名（英字）", "company_name_en"),
                     ("提出者名（ヨミ）", "company_name_kana"), ("所在地", "address"), ("提出者業種", "industry"),
                     ("証券コード", "sec_code"), ("提出者法人番号", "jcn"))
ZERO_CODES = ("0", "0000", "00000")


def read_code_list(spark: SparkSession, path: str, encoding: str = CSV_ENCODING,
                   industries_en: DataFrame | None = None) -> DataFrame:
    """Official code list, one file with a short preamble line, a header
    and 13 columns. Columns are found by header name; codes that aren't six
    characters long (preamble and header among them) fall away; security codes
    0 / 0000 / 00000 are dropped and the rest normalised (``code``); numbers
    become safe integer strings (P6). ``industries_en`` (edinet_code,
    industry) of the English list adds ``industry_en``."""
    n = len(CODE_LIST_COLUMNS)
    schema = ", ".join(f"c{i} string" for i in range(n))
    raw = spark.read.schema(schema).option("header", False).option("encoding", encoding).csv(path)
    key = CODE_LIST_COLUMNS[0][0]
    head = raw.filter(F.array_contains(F.array(*raw.columns), F.lit(key))).first()  # one line
    if head is None:
        raise ValueError(f"no header line with {key} in {path}")
    at = {strip_text: i for i, strip_text in enumerate((v or "").strip() for v in head)}
    df = raw.select(*[strip(f"c{at[ja]}").alias(en) if ja in at else F.lit(None).cast("string").alias(en)
                      for ja, en in CODE_LIST_COLUMNS]).filter(F.length("edinet_code") == 6)
    for c in ("company_name", "company_name_en", "company_name_kana", "address", "industry", "settlement_date"):
        df = df.withColumn(c, F.nullif(F.col(c), F.lit("")))
    df = (df.withColumn("is_listed_edinet", listed_flag("is_listed_edinet"))
          .withColumn("is_consolidated", yes_no_flag("is_consolidated"))
          .withColumn("capital", safe_int_str("capital")).withColumn("jcn", safe_int_str("jcn"))
          .withColumn("sec_code", safe_int_str("sec_code")))
    df = df.withColumn("sec_code", F.when(F.col("sec_code").isin(*ZERO_CODES), F.lit(None)).otherwise(F.col("sec_code")))
    df = df.withColumn("code", normalize_code("sec_code", "JP"))
    if industries_en is not None:
        en = industries_en.groupBy("edinet_code").agg(F.max("industry").alias("industry_en"))
        df = df.join(en, "edinet_code", "left")
    return df


def read_aggregation_list(spark: SparkSession, path: str, encoding: str = CSV_ENCODING) -> DataFrame:
    """(old code -> new code) from the second and third column, whatever
    the first holds; lines without two six-character codes (preamble, header)
    and self maps are dropped; a repeated old code keeps its last line."""
    from kaiji.operators.catalog import latest_wins
    raw = spark.read.schema("c0 string, c1 string, c2 string").option("header", False).option("encoding", encoding).csv(path)
    # lines of a file are in the order of its blocks, and within a block as read
    df = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"), strip("c1").alias("old_code"), strip("c2").alias("new_code"))
    df = df.filter((F.length("old_code") == 6) & (F.length("new_code") == 6) & (F.col("old_code") != F.col("new_code")))
    return latest_wins(df, ["old_code"], ["file", "block", "line"]).select("old_code", "new_code")


def staged_deltas(spark: SparkSession, staging: str) -> DataFrame:
    """Staged chunks that have a success marker; a local chunk beats the
    remote chunk with the same id of the same run. Precedence is decided on the chunk list
    (one row per chunk), then applied with a semi join. Markers and list are broadcast: dealt
    by its id, a chunk would be one task."""
    data = spark.read.parquet(os.path.join(staging, "data"))
    markers = spark.read.parquet(os.path.join(staging, "markers")).distinct()
    ok = data.join(F.broadcast(markers), ["source", "run_id", "chunk_id"], "left_semi")
    chunks = ok.select("source", "run_id", "chunk_id").distinct()
    rank = F.when(F.col("source") == "local", 0).otherwise(1)
    best = (chunks.groupBy("run_id", "chunk_id").agg(F.min(F.struct(rank.alias("r"), "source")).alias("b"))
            .select("run_id", "chunk_id", F.col("b.source").alias("source")))
    return ok.join(F.broadcast(best), ["source", "run_id", "chunk_id"], "left_semi")


def repo_listing(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Repository files as a table (path, size) with bin, date and doc id
    parsed from the path. ``binaryFile`` prunes the content column."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
             .load(root).select("path", "length"))
    return files.select(
        "path", "length",
        F.nullif(F.regexp_extract("path", r"/bin=([^/]+)/", 1), F.lit("")).alias("bin"),
        F.nullif(F.regexp_extract("path", r"year=(\d{4})/month=(\d{2})/day=(\d{2})", 0), F.lit("")).alias("day"),
        F.nullif(F.regexp_extract("path", r"/(S[0-9A-Z]{7})\.", 1), F.lit("")).alias("doc_id"))


# Exchange master sheet headers and the kaiji column names.
EXCHANGE_COLUMNS = (("コード", "code"), ("銘柄名", "company_name"), ("33業種コード", "sector_33_code"),
                    ("33業種区分", "sector_jpx_33"), ("17業種コード", "sector_17_code"), ("17業種区分", "sector_jpx_17"),
                    ("市場・商品区分", "market"), ("規模コード", "size_code"), ("規模区分", "size_category"))
EXCHANGE_CODE_COLUMNS = ("sector_33_code", "sector_17_code", "size_code")


def read_exchange_sheet(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Exchange master list (CSV export of the sheet): nine columns
    renamed, ``-`` in the three code columns becomes NULL, codes normalised (P1)."""
    raw = spark.read.option("header", True).option("encoding", encoding).csv(path)
    df = raw.select(*[F.col(f"`{ja}`").alias(en) for ja, en in EXCHANGE_COLUMNS])
    for c in EXCHANGE_CODE_COLUMNS:
        s = strip(c)
        df = df.withColumn(c, F.when(s == "-", F.lit(None).cast("string")).otherwise(s))
    return df.withColumn("code", normalize_code(strip("code"), "JP"))
