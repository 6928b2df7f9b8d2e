"""Quality rules: base counts, and divergence from language references.

Base rules fail a text with fewer than ``min_words`` words, or with over half
its words in repeated 3-word windows. The method then compares two histograms of
a text with its language's reference by Jensen-Shannon distance (base 2, 0 to 1):
character classes, and the language's common words (all other words in one bin).
Both have length guards: a text too short for a stable histogram isn't judged by
it. References are means of the documents' shares over all documents that pass
the base rules, then once more over the half of them nearest to the first mean, so
junk short of a majority doesn't bend them. They are one row per language and
bin (a fixed number).

Defined cases: a null text has no words and fails the base; languages without a
word list (and null) share one reference and are judged by classes only; a
language without documents that pass has no reference and judges none; repeated rows
stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.llm.common import fresh, stage
from kaiji.llm.textstats import CLASSES, Slice, slices

#: The most common function words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with on by at from an are this be".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus au sur".split(),
    "es": "de la que el en y a los del las un por con no una su para es al lo".split(),
}
LANGUAGES = tuple(COMMON_WORDS)
BINS = 1 + max(map(len, COMMON_WORDS.values()))
STEPS = 1000  # steps of class distance in which the nearest half is found
SCALE = 1_000_000  # shares are summed as integers, so sums don't depend on their order

SYMBOL_CLASSES = [CLASSES.index("symbol"), CLASSES.index("bar")]  # the characters of SYMBOLS

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<int>, common array<int>"


def _ints(table: np.ndarray) -> pa.Array:
    offsets = np.arange(table.shape[0] + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.astype(np.int32).ravel()))


def language_index(langs: pa.Array) -> np.ndarray:
    """Index into LANGUAGES, or their number for any other value and null."""
    return pc.fill_null(pc.index_in(langs, pa.array(LANGUAGES)), len(LANGUAGES)).to_numpy(zero_copy_only=False).astype(np.int64)


def common_counts(part: Slice, lang: np.ndarray) -> np.ndarray:
    """Documents by the common words of their language; the last bin has all other words."""
    bare = part.bare_words()
    out = np.zeros((part.n, BINS), np.int64)
    for i, words in enumerate(COMMON_WORDS.values()):
        bins = pc.fill_null(pc.index_in(bare, pa.array(words, bare.type)), BINS - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        mine = lang[part.doc] == i
        out += np.bincount(part.doc[mine] * BINS + bins[part.code[mine]], minlength=out.size).reshape(out.shape)
    rest = lang[part.doc] == len(LANGUAGES)
    out[:, -1] += np.bincount(part.doc[rest], minlength=part.n)
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _stats(texts: pa.Array, langs: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Base counts, class counts and common-word counts of a batch of whole texts."""
    index = language_index(langs)
    parts = [([np.zeros(0, np.int64)] * len(COUNTS), np.zeros((0, len(CLASSES)), np.int64), np.zeros((0, BINS), np.int64))]
    for at, some in slices(texts):
        s = Slice(some)
        classes = s.class_counts()
        parts.append(([s.n_words, s.word_chars(), classes[:, SYMBOL_CLASSES].sum(1), s.line_counts()[1], s.repeat_words()],
                      classes, common_counts(s, index[at:at + len(some)])))
    counts = [np.concatenate(x).astype(np.int64) for x in zip(*(p[0] for p in parts))]
    return counts, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def document_stats(text: Column, lang: Column) -> Column:
    """Struct of the base counts and both histograms of each whole text."""
    @F.arrow_udf(STATS)
    def quality_stats(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, langs in batches:
            counts, classes, common = _stats(texts, langs)
            yield pa.StructArray.from_arrays([*map(pa.array, counts), _ints(classes), _ints(common)], [*COUNTS, "classes", "common"])

    return quality_stats.asNondeterministic()(text, lang)


def base_failed(stats: str = "stats", min_words: int = 50) -> Column:
    words = F.col(f"{stats}.n_words")
    return (words < min_words) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * words)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance (square root of the base-2 divergence) of count tables."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    q = q / np.maximum(q.sum(1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = [np.where(x > 0, x * np.log2(np.where(x > 0, x / m, 1)), 0).sum(1) for x in (p, q)]
    return np.sqrt(np.clip((kl[0] + kl[1]) / 2, 0, 1))


def _distances(classes: np.ndarray, common: np.ndarray, langs: pa.Array, refs: tuple[np.ndarray, np.ndarray]) -> list[pa.Array]:
    index, out = language_index(langs), []
    for found, ref in ((classes, refs[0]), (common, refs[1])):
        none = ref[index].sum(1) == 0
        out.append(pa.array(np.where(none, 0, js_distance(found.astype(np.float64), ref[index])), mask=none))
    return out


def distances(stats: Column, lang: Column, refs: tuple[np.ndarray, np.ndarray]) -> Column:
    """struct<class_distance, word_distance>, null where the language has no reference."""
    @F.arrow_udf("class_distance double, word_distance double")
    def divergence(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, langs in batches:
            tables = [batch.field(f).flatten().to_numpy(zero_copy_only=False).reshape(-1, r.shape[1]) for f, r in zip(("classes", "common"), refs)]
            yield pa.StructArray.from_arrays(_distances(*tables, langs, refs), ["class_distance", "word_distance"])

    return divergence(stats, lang)


def judged_stats(text: Column, lang: Column, refs: tuple[np.ndarray, np.ndarray]) -> Column:
    """What the verdict needs of each whole text, in one pass: counts, number of characters, both distances."""
    @F.arrow_udf("n_words long, n_repeat_words long, n_chars long, class_distance double, word_distance double")
    def quality_judged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, langs in batches:
            counts, classes, common = _stats(texts, langs)
            arrays = [pa.array(counts[0]), pa.array(counts[4]), pa.array(classes.sum(1)), *_distances(classes, common, langs, refs)]
            yield pa.StructArray.from_arrays(arrays, ["n_words", "n_repeat_words", "n_chars", "class_distance", "word_distance"])

    return quality_judged.asNondeterministic()(text, lang)  # so that the filter on it evaluates it once


def references(passed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean shares per language: classes, and common words, over (lang_no, classes, common)."""
    out = []
    for name, width in (("classes", len(CLASSES)), ("common", BINS)):
        ref = np.zeros((len(LANGUAGES) + 1, width))
        total = F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
        share = passed.select("lang_no", F.posexplode(F.col(name).cast("array<long>")).alias("bin", "n"), total.alias("total")).filter("n > 0")
        sums = share.groupBy("lang_no", "bin").agg(F.sum(F.floor(F.col("n") * SCALE / F.col("total"))).alias("s"))
        for r in sums.collect():  # languages x bins
            ref[r["lang_no"], r["bin"]] = r["s"]
        out.append(ref)
    out[1][-1] = 0  # no word list, no word reference
    return out[0], out[1]


def fit(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """References from ``stats`` (lang, stats struct, failed): means over the half nearest to the mean of all."""
    number = F.coalesce(F.when(F.col("lang").isin(*LANGUAGES), F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("lang")) - 1),
                        F.lit(len(LANGUAGES))).cast("int")
    passed = stats.filter(~F.col("failed")).withColumn("lang_no", number)
    first = references(passed.select("lang_no", "stats.classes", "stats.common"))
    passed = passed.withColumn("step", F.floor(distances(F.col("stats"), F.col("lang"), first)["class_distance"] * STEPS))
    tally: dict[int, list[tuple[int, int]]] = {}
    for lang, step, n in passed.groupBy("lang_no", "step").count().collect():  # languages x STEPS
        tally.setdefault(lang, []).append((step, n))
    near = F.lit(False)
    for lang, found in tally.items():
        steps, counts = zip(*sorted(found))
        half = steps[int(np.searchsorted(np.cumsum(counts), sum(counts) / 2))]
        near = near | ((F.col("lang_no") == lang) & (F.col("step") <= half))
    return references(passed.filter(near).select("lang_no", "stats.classes", "stats.common"))


#: Length guards: (least length, distance that fails). The longest guard that a text reaches holds; shorter texts
#: aren't judged. Short texts stray far from any reference by chance, so their limit is wider.
CLASS_GUARDS = ((200, 0.28), (450, 0.218), (1800, 0.19), (6000, 0.15))  # characters
WORD_GUARDS = ((300, 0.34),)  # words


def strays(length: Column, distance: Column, guards: tuple[tuple[int, float], ...]) -> Column:
    """True where a distance (null: none) is beyond the limit of its length guard."""
    limit = F.lit(2.0)
    for least, most in guards:
        limit = F.when(length >= least, F.lit(most)).otherwise(limit)
    return F.coalesce(distance, F.lit(0.0)) > limit


def passes(stats: str, chars: Column, distance: str, class_guards=CLASS_GUARDS, word_guards=WORD_GUARDS) -> Column:
    odd = strays(chars, F.col(f"{distance}.class_distance"), class_guards) | strays(F.col(f"{stats}.n_words"), F.col(f"{distance}.word_distance"), word_guards)
    return ~base_failed(stats) & ~odd


def _with_stats(docs: DataFrame, text: str, lang: str, *others: Column) -> DataFrame:
    rows = docs.select(*others, F.col(lang).alias("lang"), document_stats(F.col(text), F.col(lang)).alias("stats"))
    return rows.withColumn("failed", base_failed())


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **guards) -> DataFrame:
    """(id, lang, stats, failed, d, kept) for each row; d has class_distance and word_distance."""
    stats = stage(_with_stats(docs, text_col, lang_col, F.col(id_col).alias("id")), "quality")
    chars = F.aggregate("stats.classes", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = stats.withColumn("d", distances(F.col("stats"), F.col("lang"), fit(stats)))
    return rows.withColumn("kept", passes("stats", chars, "d", **guards))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **guards) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    found = fresh("judged", docs)
    refs = fit(stage(_with_stats(docs, text_col, lang_col), "quality"))
    rows = docs.withColumn(found, judged_stats(F.col(text_col), F.col(lang_col), refs))
    return rows.filter(passes(found, F.col(f"{found}.n_chars"), found, **guards)).drop(found)
