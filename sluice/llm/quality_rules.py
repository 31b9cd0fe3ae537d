"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets a few measures. Documents that pass the fixed base rules feed one quantile sketch per
measure, language and source; a document goes when a measure lies far outside what the sketches show for its
own language and source.

The sketch is a histogram over buckets of about 3 % relative width (values below 64 are exact), kept as rows
(group, measure, bucket, count). Two sketches merge by adding counts, so partial sketches are built before
the shuffle, a hot source costs no more than a rare one, and the sketches of a language or of the whole
corpus come from those of its sources. Results don't depend on the order of merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from sluice.llm.common import SPACES, WORD, let, stage

SYMBOLS = "#*$%&|<>"
#: measure -> (numerator, denominator, scale, slack above, slack below or None). A measure is the integer
#: scale * numerator div denominator; the slacks are in these units.
MEASURES = {
    "word_length": ("word_chars", "n_words", 100, 400, 200),
    "symbols": ("n_symbols", "n_words", 1000, 100, None),
    "dup_lines": ("n_dup_lines", "n_words", 1000, 100, None),
    "repeats": ("n_repeat_words", "n_words", 1000, 200, None),
}
#: A threshold lies this many median absolute deviations beyond the median, and the slack on top. Junk reaches neither
#: while it is less than half of a group; for a normal distribution it is about 4 * (0.95 quantile - median).
SPREADS = 10
#: Groups with fewer documents use the sketch of their language, then that of all.
MIN_DOCS = 50


def _blank(c: Column) -> Column:
    return F.translate(c, SPACES, "")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more (each such word counts once).

    The windows' 64-bit hashes are sorted with their positions, and equal neighbours give the repeated ones:
    n log n for a text of n words. Texts whose windows all differ skip the sort.
    """
    def count(grams):
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def positions(z):
            again = F.filter(
                z, lambda x, k: ((k > 0) & (F.get(z, k - 1)["g"] == x["g"])) | (F.coalesce(F.get(z, k + 1)["g"] == x["g"], F.lit(False))))
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(let(placed, positions))

    def grams(w):
        last = F.size(w) - 2
        return F.transform(F.slice(w, F.lit(1), F.greatest(last, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(grams(w), count)))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, row by row.

    Null text counts as no words. Columns of ``docs`` with these names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = let(F.filter(F.split(text, "\n"), lambda x: F.length(_blank(x)) > 0),
                lambda x: F.size(x) - F.size(F.array_distinct(x)))
    facts = let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeat_words(w).cast("bigint").alias("n_repeat_words")))
    out = docs.withColumns({
        "_facts": facts,
        "word_chars": F.length(_blank(text)).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": lines.cast("bigint"),
    })
    out = out.withColumns({"n_words": F.col("_facts.n_words"), "n_repeat_words": F.col("_facts.n_repeat_words")}).drop("_facts")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def _bucket(v: Column) -> Column:
    """Lower end of the bucket of a non-negative integer: its leading six bits."""
    low = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, low), low)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) over the measured rows that pass the base rules."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(f"({scale} * {num}) div {den}").alias("v"))
                       for m, (num, den, scale, _, _) in MEASURES.items()])
    return (rows.filter(~F.col("base_failed")).select("lang", "source", F.explode(values).alias("x"))
            .groupBy("lang", "source", F.col("x.measure").alias("measure"), _bucket(F.col("x.v")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups: equal buckets add up."""
    return parts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def centres(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, measure, docs, q50, mad): the bucket that holds the median (the ceil(docs / 2)-th smallest value), and
    the median of the buckets' distances from it."""
    group = Window.partitionBy(*keys, "measure")

    def median(value: str):
        upto = F.sum("n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        return F.when(upto * 2 >= F.col("docs"), F.col(value))

    s = parts.withColumn("docs", F.sum("n").over(group)).withColumn("_mid", median("bucket"))
    s = s.withColumn("q50", F.min("_mid").over(group)).withColumn("_away", F.abs(F.col("bucket") - F.col("q50")))
    return s.withColumn("_far", median("_away")).groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"), F.max("q50").alias("q50"), F.min("_far").alias("mad"))


def thresholds(parts: DataFrame) -> DataFrame:
    """(lang, source, limits): one struct of limits per measure for every group that has a sketch or whose
    language has one, from the finest of group, language and corpus with at least ``MIN_DOCS`` documents."""
    groups = parts.select("lang", "source").distinct()
    measures = groups.withColumn("measure", F.explode(F.array(*[F.lit(m) for m in MEASURES])))

    def found(q, keys, tag):
        return q.filter(F.col("docs") >= MIN_DOCS).select(
            *[F.col(k).alias(f"_{tag}_{k}") for k in keys], F.col("measure").alias(f"_{tag}_m"),
            F.struct("q50", "mad").alias(f"_{tag}"))

    t = measures
    for tag, keys in (("fine", ["lang", "source"]), ("lang", ["lang"]), ("all", [])):
        q = found(centres(parts if tag == "fine" else merged(parts, keys), keys), keys, tag)
        cond = F.col("measure") == F.col(f"_{tag}_m")
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_{tag}_{k}"))
        t = t.join(q, cond, "left")
    t = t.withColumn("q", F.coalesce("_fine", "_lang", "_all"))
    above, below = F.create_map(), F.create_map()
    pairs_up, pairs_down = [], []
    for m, (_, _, _, up, down) in MEASURES.items():
        pairs_up += [F.lit(m), F.lit(up)]
        pairs_down += [F.lit(m), F.lit(down).cast("int")]
    above, below = F.create_map(*pairs_up), F.create_map(*pairs_down)
    t = t.withColumn("hi", F.col("q.q50") + F.col("q.mad") * SPREADS + above[F.col("measure")])
    t = t.withColumn("lo", F.col("q.q50") - F.col("q.mad") * SPREADS - below[F.col("measure")])
    out = t.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("lo", "hi")))).alias("limits"))
    return out.select(F.col("lang").alias("_t_lang"), F.col("source").alias("_t_source"), "limits")


def judge(rows: DataFrame) -> DataFrame:
    """Measured rows (with lang and source) plus ``kept``. ``rows`` should be staged: it is read twice.

    ``kept`` is false where the base rules fail or a measure lies outside its limits. Rows of a group without
    any limits (fewer than ``MIN_DOCS`` documents in the whole corpus) are judged by the base rules alone.
    """
    limits = thresholds(stage(sketches(rows), "sketches"))
    out = rows.join(limits, F.col("lang").eqNullSafe(F.col("_t_lang")) & F.col("source").eqNullSafe(F.col("_t_source")), "left")
    bad = F.lit(False)
    for m, (num, den, scale, _, _) in MEASURES.items():
        v, lim = F.expr(f"({scale} * {num}) div nullif({den}, 0)"), F.col("limits")[m]
        bad = bad | F.coalesce(v > lim["hi"], F.lit(False)) | F.coalesce(v < lim["lo"], F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~bad).drop("limits", "_t_lang", "_t_source")


def quality_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept per row of ``docs``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = measured(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source"))
    return judge(stage(rows.drop("text"), "measures")).select("doc_id", *names, "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with exactly their own columns (staged once with the measures)."""
    data = docs.select("text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = stage(measured(data).drop("text"), "quality")
    return judge(rows).filter("kept").select("_row.*")
