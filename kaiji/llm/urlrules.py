"""URL filters: pattern rules indexed by their rarest literal token, and host rules.

A pattern rule is written as filter lists do: ``*`` stands for any text, ``^``
for a separator or the end, ``|`` at either end for the url's own end, ``||`` in
front for the start of the host or of one of its parent domains. Its literal
tokens are the runs of letters and digits that a matching url must hold whole.
Token frequencies are counted over all urls, and each rule is filed under its
rarest token; a url's tokens fetch candidate rules, and only those run regular
expressions. A rule without such a token is filed under an entry that every url
has, so none is lost.

A host rule (host, path, action) fits its host and all subdomains if the url's
path starts with the rule's; it is filed under its host, fetched by the url's
host suffixes, and the longest one decides. Where none fits, an ``allow``
pattern beats a ``block`` pattern, and a url that no rule speaks against is
allowed.

All is DataFrame work on the distinct urls, so a url that a third of the rows
share is judged once. Defined cases: a null url, or one without ``://``, has an
empty host and path and fits no host rule (patterns still see the text); empty
rule lists allow all; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kaiji.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = "*"  # the index entry of rules without a literal token


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def pattern_regex(pattern: Column) -> Column:
    """The regular expression of a pattern, for lower-cased urls."""
    text = F.translate(lower_ascii(pattern), "^*", "\x01\x02")  # kept apart until the anchors are done
    text = F.regexp_replace(text, r"([.+?$(){}\[\]\\])", r"\\$1")
    text = F.regexp_replace(text, r"^\|\|", r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*[.])?")
    text = F.regexp_replace(F.regexp_replace(text, r"^\|", "^"), r"\|$", r"\$")
    text = F.regexp_replace(F.regexp_replace(text, r"\|", "[|]"), "\x02", ".*")
    return F.concat(F.lit("(?s)"), F.regexp_replace(text, "\x01", r"(?:[^a-z0-9_.%-]|\$)"))


def pattern_tokens(pattern: Column) -> Column:
    """Tokens that any matching url holds whole: bounded on both sides by literals or anchors."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(pattern), F.lit(r"(?<=[^*a-z0-9])([a-z0-9]+)(?=[^*a-z0-9])"), F.lit(1)))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(url), F.lit("[a-z0-9]+"), F.lit(0)))


def rule_index(patterns: DataFrame, urls: DataFrame) -> DataFrame:
    """(entry, rule_id, action, regex): each pattern under its rarest token among ``urls``."""
    parsed = patterns.select("rule_id", "action", pattern_regex(F.col("pattern")).alias("regex"),
                             F.explode_outer(pattern_tokens(F.col("pattern"))).alias("entry"))
    parsed = stage(parsed, "url-rules")
    seen = (urls.select(F.explode(url_tokens(F.col("url"))).alias("entry"))
            .join(parsed.select("entry").distinct(), "entry", "left_semi").groupBy("entry").agg(F.count("*").alias("n")))
    rarest = F.min_by("entry", F.struct(F.coalesce("n", F.lit(0)), "entry"))
    index = parsed.join(seen, "entry", "left").groupBy("rule_id", "action", "regex").agg(rarest.alias("entry"))
    return index.withColumn("entry", F.coalesce("entry", F.lit(EVERY)))


def judge(pages: DataFrame, host_rules: DataFrame, patterns: DataFrame, url_col: str = "url") -> DataFrame:
    """One row per distinct url: url, host, path, rule, verdict, pattern_id.

    ``host_rules``: host, path, action; ``patterns``: rule_id, action, pattern.
    ``pattern_id`` is the smallest id of the matching patterns of the action that decided.
    """
    urls = pages.select(F.col(url_col).alias("url")).distinct()
    urls = stage(urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), "urls")
    index = rule_index(patterns, urls)
    labels = host_rules.agg(F.max(F.size(F.split("host", "[.]")))).first()[0] or 0  # no rule has a longer host
    suffixes = F.array(*[F.substring_index("host", ".", -k) for k in range(1, labels + 1)]) if labels else F.array().cast("array<string>")
    filed = stage(host_rules.select(F.concat(F.lit("h:"), F.col("host")).alias("entry"), F.lit(None).cast("long").alias("rule_id"),
                                    "action", F.lit(None).cast("string").alias("regex"),
                                    F.concat("host", "path").alias("rule"), F.col("path").alias("starts"))
                  .union(index.select(F.concat(F.lit("t:"), F.col("entry")), F.col("rule_id").cast("long"), "action", "regex",
                                      F.lit(None).cast("string"), F.lit(None).cast("string"))), "url-index")
    entries = F.concat(F.array(F.lit("t:" + EVERY)), F.transform(url_tokens(F.coalesce("url", F.lit(""))), lambda t: F.concat(F.lit("t:"), t)),
                       F.transform(F.array_distinct(suffixes), lambda h: F.concat(F.lit("h:"), h)))
    found = urls.withColumn("entry", F.explode(entries)).join(filed, "entry")
    found = found.filter(F.when(F.col("regex").isNull(), F.startswith("path", "starts"))
                         .otherwise(F.rlike(lower_ascii(F.coalesce("url", F.lit(""))), F.col("regex"))))
    hit = F.when(F.col("regex").isNotNull(), F.col("rule_id"))
    by_url = found.filter("url is not null").groupBy("url").agg(
        F.max(F.when(F.col("regex").isNull(), F.struct(F.length("rule").alias("n"), "rule", "action"))).alias("host_rule"),
        F.min(F.when(F.col("action") == "allow", hit)).alias("allowed"), F.min(F.when(F.col("action") == "block", hit)).alias("blocked"))
    by_pattern = F.when(F.col("allowed").isNull() & F.col("blocked").isNotNull(), "block").otherwise("allow")
    return urls.join(by_url, "url", "left").select(
        "url", "host", "path", F.col("host_rule.rule").alias("rule"), F.coalesce("host_rule.action", by_pattern).alias("verdict"),
        F.when(F.col("host_rule").isNull(), F.coalesce("allowed", "blocked")).alias("pattern_id"))


def judge_pages(pages: DataFrame, host_rules: DataFrame, patterns: DataFrame, url_col: str = "url") -> DataFrame:
    """Every row of ``pages`` as a struct ``page``, with the verdict on its url."""
    judged = judge(pages, host_rules, patterns, url_col).withColumnRenamed("url", "judged_url")
    rows = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("page"), F.col(url_col).alias("own_url"))
    return rows.join(judged, F.col("own_url").eqNullSafe(F.col("judged_url")), "left").drop("own_url", "judged_url")


def rules_frame(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A rule list as a table of literals."""
    if not rows:
        raise ValueError("an empty rule list has no column types: pass an empty DataFrame instead")
    lines = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*lines)))
