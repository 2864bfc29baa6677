"""Quality rules with adaptive thresholds.

Each document has measures; per language and source mergeable quantile sketches give the quartiles of each
measure, and a fence lies ``REACH`` quartile ranges beyond them (a range counts as its floor at least, so
that even groups are not cut at random).  Sketches of small groups are too coarse: a group of fewer than
``MIN_GROUP`` documents takes the fences of its language, merged from its groups' sketches, and a small
language those of all.  Documents are then joined with their fences.  A document is kept if it does not
fail the base rules and lies within all fences.

Null texts have no words and fail.  Null languages and sources are groups of their own.  All is done with
DataFrame functions; measures are staged, so texts are read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import staged

REACH, MIN_GROUP, SKETCH_K = 3.0, 50, 2048
WINDOW = 8
#: Per measure: whether its lower side is fenced too, and the least quartile range.
MEASURES = {"word_length": (True, 0.5), "symbol_share": (False, 0.05), "duplicate_share": (False, 0.1), "repeat_share": (False, 0.1)}

_WORD = r"[^ \t-\r]+"


def _bind(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of ``window`` words that are found twice or more in the array, the first included."""

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(places, j + 1) - p, F.lit(window))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def repeated(pairs: Column) -> Column:
        again = F.filter(pairs, lambda e, j: (F.get(pairs, j - 1)["h"] == e["h"]) | (F.get(pairs, j + 1)["h"] == e["h"]))
        return _bind(F.sort_array(F.transform(again, lambda e: e["i"])), covered)

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_bind(pairs, repeated))

    def windows(each: Column) -> Column:
        return _bind(F.transform(F.sequence(F.lit(1), F.size(each) - window + 1), lambda i: F.xxhash64(F.slice(each, i, window))), counted)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(_bind(hashed, windows))


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every row's text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WORD))
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    of_words = _bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))
    of_lines = _bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.length(F.regexp_replace(text, r"[ \t-\r]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        of_words.alias("w"),
        of_lines.alias("l"),
    )


def _with_measures(counts: DataFrame) -> DataFrame:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return counts.withColumns(
        {
            "word_length": F.col("word_chars") / words,
            "symbol_share": F.col("n_symbols") / words,
            "duplicate_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words,
        }
    )


def fences(measures: DataFrame) -> DataFrame:
    """``low`` and ``high`` of every measure for every language and source."""
    sketched = lambda c: F.kll_sketch_agg_double(c, SKETCH_K).alias(c)
    merged = lambda c: F.kll_merge_agg_double(c, SKETCH_K).alias(c)
    count = F.sum("docs").alias("docs")
    # Empty documents fail anyway and say nothing about the others.
    groups = staged(measures.where("n_words > 0").groupBy("lang", "source").agg(F.count("*").alias("docs"), *map(sketched, MEASURES)), "rule-sketches")
    languages = groups.groupBy("lang").agg(count, *map(merged, MEASURES))
    whole = groups.agg(count, *map(merged, MEASURES))

    def bounds(df: DataFrame, level: str, keys: list[str]) -> DataFrame:
        out = []
        for m, (_, floor) in MEASURES.items():
            q1, q3 = (F.kll_sketch_get_quantile_double(m, F.lit(q)) for q in (0.25, 0.75))
            reach = REACH * F.greatest(q3 - q1, F.lit(floor))
            out.append(F.struct((q1 - reach).alias("low"), (q3 + reach).alias("high")).alias(f"{m}_fence"))
        return df.select(*(F.col(k).alias(f"{level}_{k}") for k in keys), F.struct("docs", *out).alias(level))

    g, lang, every = bounds(groups, "g", ["lang", "source"]), bounds(languages, "l", ["lang"]), bounds(whole, "a", [])
    joined = g.join(lang, F.col("g_lang").eqNullSafe(F.col("l_lang"))).withColumn("one", F.lit(1)).join(every.withColumn("one", F.lit(1)), "one")
    chosen = F.when(F.col("g.docs") >= MIN_GROUP, F.col("g")).when(F.col("l.docs") >= MIN_GROUP, F.col("l")).otherwise(F.col("a"))
    return joined.select(F.col("g_lang").alias("_lang"), F.col("g_source").alias("_source"), chosen.alias("fence"))


def judged(docs: DataFrame) -> DataFrame:
    """Counts and measures of every row, ``base_failed`` and ``kept``."""
    counts = measured(docs).select("doc_id", "lang", "source", "word_chars", "n_symbols", "w.*", "l.*")
    measures = _with_measures(staged(counts, "rule-measures"))
    limits = fences(measures)
    joined = measures.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = reduce(
        lambda a, b: a & b,
        ((F.col(m) <= F.col(f"fence.{m}_fence.high")) & (F.lit(not both) | (F.col(m) >= F.col(f"fence.{m}_fence.low"))) for m, (both, _) in MEASURES.items()),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & F.coalesce(inside, F.lit(True))}).drop("_lang", "_source", "fence")
