"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of
  * the likelihood of the text: hashed byte trigrams, counted per declared
    language over all rows (grouped aggregation), tempered to at most
    ``text_evidence`` trigrams because neighbouring trigrams aren't independent;
  * the likelihood of the declared markup language: a confusion table of
    declared against text-only decisions over all rows;
  * the likelihood of the address suffix, from the same kind of table;
  * the prior of the host: its counts of text-only decisions, smoothed towards
    its domain's, and these towards the whole corpus's.
A class ``und`` (undetermined) competes with a flat text model, under which every
bucket is as likely: it wins where a text fits no language better than noise
does, so texts of two languages stay, and it competes only for texts of
``NOISE_TRIGRAMS`` trigrams or more. A row is kept if a language wins with
``min_posterior``.

Model sizes: the trigram table has languages x 2^14 entries, the declared table
languages + 2 columns; both go to the driver. Host, domain and suffix tables grow
with the data; they stay DataFrames, and Spark broadcasts them only if their
written size allows.

Defined cases: a null or empty text, or one without letters, is ``und`` and not
kept; null or unknown declarations are a value of their own that carries
little evidence; a null host has the corpus's prior and a null suffix no
evidence; equal posteriors go to the first of the languages; repeated rows
stay; an empty table gives an empty result; without any declared rows all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.llm.common import fresh, stage
from kaiji.llm.textstats import slices, text_bytes

LANGUAGES = ("en", "de", "fr", "es")
UND = "und"
BUCKET_BITS = 14
NOISE_TRIGRAMS = 50  # a text with fewer can't be told from noise, so und doesn't compete


def _letter_table() -> np.ndarray:
    """Bytes of letters as they are, all others as a space."""
    table = np.full(256, 32, np.uint32)
    table[97:123] = np.arange(97, 123)
    table[128:256] = np.arange(128, 256)
    return table


LETTER = _letter_table()


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the byte trigrams of lower-cased texts between spaces, runs of non-letters as one space."""
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    texts = pc.binary_join_element_wise(space, pc.utf8_lower(texts), space, nothing)
    data = LETTER[text_bytes(texts)]
    row = np.repeat(np.arange(len(texts), dtype=np.int32), pc.binary_length(texts).to_numpy(zero_copy_only=False))
    if len(data):
        again = np.zeros(len(data), bool)
        again[1:] = (data[1:] == 32) & (data[:-1] == 32) & (row[1:] == row[:-1])
        data, row = data[~again], row[~again]
    if len(data) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.uint32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    bucket = (code * np.uint32(2654435769)) >> np.uint32(32 - BUCKET_BITS)
    inside = row[:-2] == row[2:]
    return row[:-2][inside], bucket[inside]


def trigram_counts(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Counts per language and bucket over all rows of (text, declared)."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), size), np.int64)
        for batch in batches:
            lang = pc.fill_null(pc.index_in(batch.column("declared"), pa.array(languages)), -1).to_numpy(zero_copy_only=False)
            for at, texts in slices(batch.column("text")):
                row, bucket = trigrams(texts)
                known = lang[at:at + len(texts)][row]
                for i in range(len(languages)):
                    total[i] += np.bincount(bucket[known == i], minlength=size)
        at, bucket = np.nonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[at, bucket])],
                              names=["lang", "bucket", "n"])

    found = rows.select("text", "declared").mapInArrow(count, "lang int, bucket int, n long")
    total = np.zeros((len(languages), size), np.int64)
    for lang, bucket, n in found.groupBy("lang", "bucket").agg(F.sum("n")).collect():  # languages x 2^14 rows at most
        total[lang, bucket] = n
    return total


@dataclass
class TextModel:
    """Log likelihood per class (the languages, then und) and bucket."""

    languages: tuple[str, ...]
    loglik: np.ndarray

    @classmethod
    def fit(cls, rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> TextModel:
        counts = trigram_counts(rows, languages)
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
        und = np.full((1, counts.shape[1]), -np.log(counts.shape[1]))
        log = np.where(counts.sum(1, keepdims=True) > 0, np.log(share), und - 50.0)  # a language never declared can't win
        return cls(languages, np.concatenate([log, und]))

    def evidence(self, text: Column, most: int) -> Column:
        """array<double>: tempered log likelihood of each class; null without letters."""
        table, classes = self.loglik, len(self.loglik)
        taught = bool((table[:-1] > table[-1] - 40).any())  # else there is no language to choose

        @F.arrow_udf("array<double>")
        def text_evidence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                out, n = np.zeros((len(batch), classes)), np.zeros(len(batch), np.int64)
                for at, texts in slices(batch):
                    row, bucket = trigrams(texts)
                    if len(row):
                        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                        for i in range(classes):
                            out[at + row[starts], i] = np.add.reduceat(table[i][bucket], starts)
                        n[at:at + len(texts)] = np.bincount(row, minlength=len(texts))
                out *= (np.minimum(n, most) / np.maximum(n, 1))[:, None]
                brief = (n < NOISE_TRIGRAMS) & taught
                out[brief, -1] = out[brief, :-1].min(1) - 50.0
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, classes, 0))])
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out[n > 0].ravel()), mask=pa.array(n == 0))

        return text_evidence.asNondeterministic()(text)  # so that no filter makes Spark evaluate it twice


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of an address: the last two labels are the domain, the last the suffix."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.when(host != "", host)
    return host, F.substring_index(host, ".", -2), F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


def markup_language(html: Column) -> Column:
    """The lang attribute of the html element, its first subtag in lower case."""
    lang = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(lang != "", lang)


def _counts(decided: DataFrame, by: str, n: int) -> DataFrame:
    """Per value of ``by``: array of decisions per language."""
    sums = [F.sum(F.when(F.col("choice") == i, 1).otherwise(0)).cast("double") for i in range(n)]
    return decided.filter(F.col(by).isNotNull()).groupBy(by).agg(F.array(*sums).alias("counts"))


def _smoothed(counts: Column, parent: Column, weight: float, n: int) -> Column:
    total = sum((counts[i] for i in range(1, n)), counts[0])
    return F.array(*[(counts[i] + F.lit(weight) * parent[i]) / (total + F.lit(weight)) for i in range(n)])


@dataclass
class Evidence:
    """What fusion adds to the text: fitted on all rows by ``fit_evidence``."""

    classes: tuple[str, ...]
    corpus: list[float]
    declared: dict[str, list[float]]  # value -> log likelihood per class
    hosts: DataFrame  # host, prior
    suffixes: DataFrame  # suffix, log likelihoods


def fit_evidence(scored: DataFrame, languages: tuple[str, ...], host_weight: float = 20.0, domain_weight: float = 50.0) -> Evidence:
    """Tables from text-only decisions over all rows of ``scored`` (evidence, declared, host, domain, suffix)."""
    classes, n = (*languages, UND), len(languages) + 1
    best = F.array_max("evidence")
    said = F.when(F.col("declared").isin(*languages), F.col("declared")).when(F.col("declared").isNull(), "none").otherwise("other")
    decided = stage(scored.filter("evidence is not null").select(F.array_position("evidence", best).cast("int").alias("at"), "host", "domain",
                                                                 "suffix", said.alias("said")).withColumn("choice", F.col("at") - 1), "lang-decided")
    table = {(r["said"], r["choice"]): r["n"] for r in decided.groupBy("said", "choice").agg(F.count("*").alias("n")).collect()}
    per = [sum(v for (_, c), v in table.items() if c == i) for i in range(n)]
    corpus = [(per[i] + 1.0) / (sum(per) + n) for i in range(n)]
    values = [*languages, "none", "other"]
    # prior knowledge: a language is declared as itself; und says nothing
    declared = {v: [float(np.log((table.get((v, i), 0) + (5.0 if i < len(languages) and v == languages[i] else 1.0)) / (per[i] + len(values) + 4.0)))
                    if i < len(languages) else 0.0 for i in range(n)] for v in values}
    for v in values:  # a flat likelihood for und, so that it gains or loses by the text alone
        declared[v][-1] = float(np.mean(declared[v][:-1]))
    top = F.array(*[F.lit(x) for x in corpus])
    domains = _counts(decided, "domain", n).select("domain", _smoothed(F.col("counts"), top, domain_weight, n).alias("parent"))
    pairs = decided.filter("host is not null").groupBy("host").agg(F.max("domain").alias("domain"))
    hosts = (_counts(decided, "host", n).join(pairs, "host").join(domains, "domain", "left")
             .select("host", _smoothed(F.col("counts"), F.coalesce("parent", top), host_weight, n).alias("prior")))
    suffixes = _counts(decided, "suffix", n)
    kinds = suffixes.count() + 1.0
    suffixes = suffixes.select("suffix", F.array(*[F.ln((F.col("counts")[i] + 1.0) / F.lit(per[i] + kinds)) for i in range(n)]).alias("suffix_log"))
    return Evidence(classes, corpus, declared, stage(hosts, "lang-hosts"), stage(suffixes, "lang-suffixes"))


def fuse(scored: DataFrame, found: Evidence, min_posterior: float) -> DataFrame:
    """Adds ``language``, ``posterior`` and ``kept`` to rows with evidence, declared, host and suffix."""
    n, names = len(found.classes), found.classes
    said = F.when(F.col("declared").isin(*names[:-1]), F.col("declared")).when(F.col("declared").isNull(), "none").otherwise("other")
    declared = F.create_map(*[x for v, ll in found.declared.items() for x in (F.lit(v), F.array(*map(F.lit, ll)))])
    flat = F.array(*[F.lit(0.0)] * n)
    rows = scored.join(found.hosts, "host", "left").join(found.suffixes, "suffix", "left")
    rows = rows.withColumn("prior", F.coalesce("prior", F.array(*map(F.lit, found.corpus)))).withColumn("declared_log", declared[said])
    rows = rows.withColumn("suffix_log", F.coalesce("suffix_log", flat))
    parts = [F.col("evidence")[i] + F.col("declared_log")[i] + F.col("suffix_log")[i] + F.ln(F.col("prior")[i]) for i in range(n)]
    rows = rows.withColumn("joint", F.when(F.col("evidence").isNotNull(), F.array(*parts)))
    best = F.array_max("joint")
    norm = F.aggregate("joint", F.lit(0.0), lambda total, x: total + F.exp(x - best))
    rows = rows.withColumn("language", F.coalesce(F.element_at(F.array(*map(F.lit, names)), F.array_position("joint", best).cast("int")), F.lit(UND)))
    rows = rows.withColumn("posterior", F.coalesce(1.0 / norm, F.lit(0.0)))
    return rows.withColumn("kept", (F.col("language") != UND) & (F.col("posterior") >= min_posterior)).drop("joint", "prior", "declared_log", "suffix_log")


def identify(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, min_posterior: float = 0.35, text_evidence: int = 200) -> DataFrame:
    """(id, language, posterior, kept) of rows of (id, text, declared, host, domain, suffix)."""
    model = TextModel.fit(rows, languages)
    scored = stage(rows.select("id", "declared", "host", "domain", "suffix", model.evidence(F.col("text"), text_evidence).alias("evidence")), "lang-scored")
    found = fit_evidence(scored, languages)
    return fuse(scored, found, min_posterior).select("id", "language", "posterior", "kept")


def keep_identified(docs: DataFrame, text_col: str, declared_col: str, host_col: str, languages: tuple[str, ...] = LANGUAGES,
                    min_posterior: float = 0.35, text_evidence: int = 200) -> DataFrame:
    """The rows of ``docs`` whose language is determined, unchanged."""
    no = F.lit(None).cast("string")
    rows = docs.select(F.col(text_col).alias("text"), F.col(declared_col).alias("declared"), F.col(host_col).alias("host"),
                       no.alias("domain"), no.alias("suffix"))
    model = TextModel.fit(rows, languages)
    evidence = model.evidence(F.col("text"), text_evidence).alias("evidence")
    found = fit_evidence(stage(rows.select("declared", "host", "domain", "suffix", evidence), "lang-scored"), languages)
    whole = fresh("whole_row", docs)
    full = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(whole), F.col(declared_col).alias("declared"),
                       F.col(host_col).alias("host"), no.alias("suffix"), model.evidence(F.col(text_col), text_evidence).alias("evidence"))
    return fuse(full, found, min_posterior).filter("kept").select(f"{whole}.*")
