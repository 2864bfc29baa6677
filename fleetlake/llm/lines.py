"""Line dedup by a log-template tree of fixed depth.

A line's tokens (runs of non-blanks; those with a digit read ``<*>``) lead through the tree by their
number and the first ``DEPTH`` of them to a leaf.  Two kinds of template sit there: each masked line as it
is, and the leaf's general template, in which every place without a majority token is a variable field.
A line fits the general template if it has all its fixed tokens; the template counts only if enough
places after the leading ones are fixed (``SIMILARITY``) and the line has ``DEPTH + 3`` tokens or more.

A template recurs if it is found in ``MIN_DOCS`` different texts or more and in as many different
surroundings, which must also be ``MIN_SPREAD`` times its texts or more.  A line's surroundings are the
least hash of the other lines' first ``DEPTH`` tokens in its document (a min-hash of line heads); of three
hashes the one that finds most counts, since under one hash a common line may be the least everywhere.  So
boilerplate recurs, single lines as well as blocks, whereas the lines of a copied document, which always
stand among the same lines, stay for the near-duplicate operator.  All lines that fit a recurring template
are dropped, in every document.

Null texts have no lines and stay null.  Lines of fewer than ``MIN_TOKENS`` tokens are never dropped.
Rows that repeat a document are kept and treated alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import staged, unpacked, whole_row

DEPTH = 3
MIN_TOKENS = 3
MIN_DOCS = 5
MIN_SPREAD = 0.4
SIMILARITY = 0.6
#: Parts into which the lines of one template or leaf are dealt for a join.
SALTS = 16
#: Lines of a leaf that one task may count by itself; the counts of larger leaves are put together from many tasks.
WHOLE = 20_000
#: Hash classes of leaves by which lines are sifted before a join, a multiple of 64.
FLAGS = 65_536

#: The parts of a digest that serve as independent hashes, and the columns made of them.
_PARTS = ((1, 8), (9, 8), (17, 8))
_AROUND = tuple(f"around_{k}" for k in range(len(_PARTS)))
_BLANK = r"[ \t\x0B\f\r]"


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def _parsed(line: Column) -> Column:
    masked = F.regexp_replace(line, r"[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*", "<*>")
    tokens = F.filter(F.split(masked, _BLANK + "+"), lambda t: t != "")
    return _bind(
        tokens,
        lambda t: F.struct(
            F.array_join(t, " ").alias("masked"),
            F.size(t).alias("n"),
            F.xxhash64(F.size(t), F.slice(t, 1, DEPTH)).alias("leaf"),
            F.when(F.size(t) > 0, F.md5(F.array_join(F.slice(t, 1, DEPTH), " "))).alias("head"),
        ),
    )


def parsed_lines(docs: DataFrame) -> DataFrame:
    """One row per line: its document, number, masked form, leaf and surroundings (numbers, which take less room than digits)."""
    placed = lambda lows, numbers, x, i: F.struct(
        i.alias("line_no"),
        x["masked"].alias("masked"),
        F.xxhash64(x["masked"]).alias("template"),
        x["n"].alias("n"),
        x["leaf"].alias("leaf"),
        *(
            F.when(F.substring(x["head"], *part) == lows[k][0], F.get(numbers[k], F.lit(1))).otherwise(numbers[k][0]).alias(f"around_{k}")
            for k, part in enumerate(_PARTS)
        ),
    )
    heads = lambda every, part: F.array_compact(F.transform(every, lambda x: F.substring(x["head"], *part)))
    two_least = lambda every: F.array(*(F.slice(F.array_sort(F.array_distinct(heads(every, p))), 1, 2) for p in _PARTS))
    lines = F.transform(F.split("text", "\n", -1), _parsed)
    as_numbers = lambda lows: F.transform(lows, lambda two: F.transform(two, lambda digits: F.conv(digits, 16, 10).cast("long")))
    all_placed = lambda every, lows: _bind(as_numbers(lows), lambda numbers: F.transform(every, lambda x, i: placed(lows, numbers, x, i)))
    every_line = _bind(lines, lambda every: _bind(two_least(every), lambda lows: all_placed(every, lows)))
    has_token = docs.where(F.col("text").rlike(r"[^ \t-\r]"))
    rows = has_token.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.explode(every_line).alias("line"))
    return rows.select("doc_id", "text_key", "line.*").where(F.col("n") >= MIN_TOKENS)


def _spread(lines: DataFrame, chosen: DataFrame, key: str, how: str) -> DataFrame:
    """A join on ``key`` in which one key's lines are dealt over ``SALTS`` tasks.  ``chosen`` has a row per key."""
    dealt = lines.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "line_no"), F.lit(SALTS)).cast("int"))
    copied = chosen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def _perhaps_in(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """Lines of the leaves and a few others: most lines need not be moved for the join that follows.

    The driver holds one flag for each of ``FLAGS`` hash classes of leaves, however many leaves there are.  They are
    bits of longs, since Spark keeps the text of every plan, and each change of it, in the driver.
    """
    place = F.pmod("leaf", F.lit(FLAGS)).cast("int")
    there = {row[0] for row in leaves.select(place).distinct().collect()}
    bits = np.zeros(FLAGS, np.uint8)
    bits[list(there)] = 1
    flags = F.split(F.lit(",".join(map(str, np.packbits(bits, bitorder="little").view("<i8").tolist()))), ",").cast("array<long>")
    return lines.where(F.getbit(F.get(flags, F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))) == 1)


def _frequent(lines: DataFrame, key: str) -> DataFrame:
    """Keys of so many lines that they can recur, with ``lines``: one number a key is moved, where most have few lines."""
    return lines.groupBy(key).agg(F.count("*").alias("lines")).where(F.col("lines") >= MIN_DOCS)


def _recurring(lines: DataFrame, key: str) -> DataFrame:
    by_text = lines.groupBy(key, "text_key").agg(*(F.min(a).alias(a) for a in _AROUND))
    found = by_text.groupBy(key).agg(
        F.count("*").alias("docs"), F.count(_AROUND[0]).alias("placed"), F.greatest(*map(F.count_distinct, _AROUND)).alias("places")
    )
    spread = F.greatest(F.lit(MIN_DOCS), MIN_SPREAD * F.col("placed"))
    return found.where((F.col("docs") >= MIN_DOCS) & (F.col("places") >= spread)).select(key)


def _general_templates(lines: DataFrame) -> DataFrame:
    """Per leaf the places that one token holds in most lines, if they are enough.

    All lines of a leaf have the same first ``DEPTH`` tokens.  Only lines are moved, not their tokens, but for leaves
    of more than ``WHOLE`` lines, whose tokens are counted before they are moved.
    """
    ids = ("leaf", "n", "place")

    def counted(some: DataFrame) -> DataFrame:
        tokens = F.split("masked", " ")
        places = some.select("leaf", "n", F.posexplode(F.slice(tokens, DEPTH + 1, F.col("n"))).alias("place", "token"))
        return places.groupBy(*ids, "token").agg(F.count("*").alias("lines"))

    lines = lines.select("leaf", "n", "masked", "lines")
    counts = counted(lines.where(F.col("lines") <= WHOLE).repartition("leaf")), counted(lines.where(F.col("lines") > WHOLE))
    first = [c.groupBy(*ids).agg(F.max(F.struct("lines", "token")).alias("top"), F.sum("lines").alias("all")) for c in counts]
    entry = F.struct((F.col("place") + DEPTH).alias("place"), F.col("top.token"))
    fixed = [
        f.where("top.lines * 2 > all").groupBy("leaf", "n").agg(F.map_from_entries(F.collect_list(entry)).alias("fixed"))  # as long as one line
        for f in first
    ]
    return fixed[0].union(fixed[1]).where(F.size("fixed") >= SIMILARITY * (F.col("n") - DEPTH)).select("leaf", "fixed")


def recurring_lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and ``dropped``: the numbers of the lines that fit a recurring template."""
    lines = staged(parsed_lines(docs), "lines")
    ids = ("doc_id", "text_key", "line_no")
    common = _spread(lines.select(*ids, "template", *_AROUND), _frequent(lines, "template").select("template"), "template", "left_semi")
    common = staged(common, "lines-common")
    alike = _spread(common, _recurring(common, "template"), "template", "left_semi").select(*ids)
    leaves = lines.where(F.col("n") >= DEPTH + 3).groupBy("leaf").agg(
        F.count("*").alias("lines"), F.min("template").alias("least"), F.max("template").alias("most")
    )
    leaves = leaves.where((F.col("lines") >= MIN_DOCS) & (F.col("least") != F.col("most"))).select("leaf", "lines")
    leaves = staged(leaves, "line-leaves")
    mixed = staged(_spread(_perhaps_in(lines, leaves), leaves, "leaf", "inner"), "lines-mixed")
    in_texts = mixed.groupBy("leaf").agg(F.count_distinct("text_key").alias("docs")).where(F.col("docs") >= MIN_DOCS).select("leaf")
    templates = staged(_general_templates(mixed).join(in_texts, "leaf", "left_semi"), "line-templates")
    tokens = F.split("masked", " ")
    fitting = (
        _spread(_perhaps_in(mixed, templates), templates, "leaf", "inner")
        .where(F.forall(F.map_entries("fixed"), lambda e: F.get(tokens, e["key"]) == e["value"]))
        .select(*ids, "leaf", *_AROUND)
    )
    fitting = staged(fitting, "lines-fitting")
    general = _spread(fitting, _recurring(fitting, "leaf"), "leaf", "left_semi").select(*ids)
    # A document has no more of them than lines.
    return alike.union(general).groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("dropped"))


def _cut(docs: DataFrame) -> DataFrame:
    """Every row as a struct, with the text left over, ``n_lines`` and ``n_dropped``."""
    found = recurring_lines(docs).select(F.xxhash64("doc_id", "text_key").alias("_key"), "dropped")
    rows = docs.select(whole_row(docs), F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("_key"))
    text = F.col("_row")["text"]
    lines = F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("dropped", i)), "\n")
    return rows.join(found, "_key", "left").select(
        "_row",
        F.when(F.col("dropped").isNull(), text).otherwise(left).alias("left"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def drop_recurring(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that fit a recurring template, with ``n_lines`` and ``n_dropped``."""
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return _cut(docs).select(*unpacked(columns, text=F.col("left")), "n_lines", "n_dropped")


def without_recurring(docs: DataFrame) -> DataFrame:
    """``docs`` less its recurring lines, and less documents of which nothing but blanks is left."""
    emptied = (F.col("n_dropped") > 0) & ~F.col("left").rlike(r"[^ \t-\r]")
    return _cut(docs).where(~F.coalesce(emptied, F.lit(False))).select(*unpacked(docs.columns, text=F.col("left")))
