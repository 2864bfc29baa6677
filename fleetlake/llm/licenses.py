"""License scan by an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, over line breaks, that is ``SLACK`` words longer than the template.  It
meets the template if it holds at least ``THRESHOLD`` of the template's distinct words; of all blocks of a
text the best one counts.  A text's template words are numbered by the number of texts that hold them, rarest
first.  A text can only meet a template if it has enough of the templates' words (length filter), if its prefix
and the template's share a word (prefix filter), and if what follows that word on both sides is long enough
(positional filter).  What is left is verified at every block that starts with a template word.  Words
outside all templates can't add to an overlap, so texts are kept as the places of the others.  The templates
are a small table of at most ``MAX_TEMPLATE_WORDS`` words, hence broadcast.

Apart from that, fixed phrases are found at their exact places.  All is done with DataFrame functions.
Null and empty texts have no words.  Rows that repeat a document are kept and treated alike.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import staged

THRESHOLD = 0.8
#: Words by which a block is longer than the template: other words may stand in between.
SLACK = 8
MAX_TEMPLATE_WORDS = 20_000

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: License notices and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(_WORD), F.lit(0))


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def phrase_places(text: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """Start and label of every place where a phrase's words stand consecutively."""

    def places(w: Column, phrase: str, label: str) -> Column:
        parts = phrase.split()
        fits = lambda i: F.slice(w, i + 1, len(parts)) == F.array(*map(F.lit, parts))
        starts = F.when(F.size(w) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), fits)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    found = _bind(words(text), lambda w: F.concat(*(places(w, p, label) for p, label in phrases)))
    last = sorted({p.split()[-1] for p, _ in phrases})
    may = F.lower(text).rlike("|".join(last))  # every phrase ends with one of these words
    return F.when(may, found).otherwise(F.array().cast("array<struct<start:bigint,label:string>>"))


def _texts(docs: DataFrame, vocabulary: Sequence[str], least: int) -> DataFrame:
    """Per text with ``least`` template words: the document, those words and the place of each of them, in order."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), words(F.lower("text")).alias("w"))
    placed = F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(*vocabulary), F.struct(i.alias("at"), x.alias("word")))))
    held = read.select("doc_id", "text_key", placed.alias("hits")).withColumn("held", F.array_distinct("hits.word"))
    return held.where(F.size("held") >= least)


def _best(hits: Column, template: Column, n_words: Column) -> Column:
    """The most distinct words of the template that a block of the text holds."""

    def held(own: Column) -> Column:
        length = n_words + SLACK
        block = lambda h, i: F.filter(F.slice(own, i + 1, length), lambda x: x["at"] < h["at"] + length)
        return F.array_max(F.transform(own, lambda h, i: F.size(F.array_distinct(F.transform(block(h, i), lambda x: x["word"])))))

    return _bind(F.filter(hits, lambda h: F.array_contains(template, h["word"])), held)


def matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``text_key``, ``label`` and ``containment`` of every text and template that meet, once each."""
    sets = [(sorted(set(t.split())), label) for t, label in templates]
    vocabulary = sorted({w for s, _ in sets for w in s})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words")
    need = [math.ceil(threshold * len(s) - 1e-9) for s, _ in sets]
    least = min(need)
    held = staged(_texts(docs, vocabulary, least), "license-texts")
    counted = held.select(F.explode("held").alias("word")).groupBy("word").count().collect()  # the vocabulary at most
    frequency = {r.word: r["count"] for r in counted}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    rows = [
        (rank[w], i, n, sorted(rank[x] for x in s), s, len(t.split()), label)
        for (s, label), (t, _), n in zip(sets, templates, need, strict=True)
        for i, w in enumerate(sorted(s, key=rank.__getitem__)[: len(s) - n + 1])
    ]
    prefixes = docs.sparkSession.createDataFrame(
        rows, "word int, i int, need int, template array<int>, template_words array<string>, template_length int, label string"
    )
    ordered = F.array(*map(F.lit, order))
    numbered = held.select(
        "doc_id", "text_key", "hits", F.sort_array(F.transform("held", lambda w: F.array_position(ordered, w).cast("int") - 1)).alias("block")
    )
    size = F.size("block")
    first_words = sorted({r[0] for r in rows})
    prefix_words = F.transform(F.slice("block", F.lit(1), size - least + 1), lambda w, j: F.struct(j.alias("j"), w.alias("word")))
    prefix = numbered.select("doc_id", "text_key", "hits", "block", F.explode(F.filter(prefix_words, lambda p: p["word"].isin(*first_words))).alias("p"))
    prefix = prefix.select("doc_id", "text_key", "hits", "block", "p.j", "p.word")
    met = prefix.join(F.broadcast(prefixes), "word").where(
        (size >= F.col("need")) & (F.lit(1) + F.least(F.size("template") - F.col("i"), size - F.col("j")) - 1 >= F.col("need"))
    )
    common = F.array_intersect("block", "template")
    met = met.where((common[0] == F.col("word")) & (F.size(common) >= F.col("need")))  # the first common word stands for the pair
    best = _best(F.col("hits"), F.col("template_words"), F.col("template_length"))
    met = met.select("doc_id", "text_key", "label", "need", F.size("template").alias("all"), best.alias("best"))
    return met.where(F.col("best") >= F.col("need")).select("doc_id", "text_key", "label", (F.col("best") / F.col("all")).alias("containment"))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """For every row: ``n_words``, ``places`` of the phrases, and ``labels`` and ``containment`` of the join."""
    found = matches(docs, templates).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).agg(
        F.collect_set("label").alias("template_labels"),  # as many as there are labels
        F.max("containment").alias("containment"),
        F.count("*").alias("n_templates"),
    )
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(_ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce(phrase_places(F.col("text"), phrases), F.array().cast("array<struct<start:bigint,label:string>>")).alias("places"),
    )
    joined = staged(read, "license-places").join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text")), "left")
    return joined.drop("_id", "_text")
