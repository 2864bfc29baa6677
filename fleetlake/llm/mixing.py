"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are exact word counts.  Every source has a budget: its target, at most ``repeats`` times its size.
Whole passes over the source come first; a knapsack spends the rest on one further copy of some documents.
It works on the number of documents of each length: an even share of each length leaves a remainder below
the sum of the lengths, longer lengths are then added while they fit, and bounded-knapsack dynamic
programming over the lengths still at hand fits the last ``DP_BUDGET`` words as closely as they can be.
Which documents of a length get the copy is drawn by a seeded hash of ``doc_id``.

Counting is done before anything is gathered: a source's knapsack sees one row per length, never a
document.  A draw among many documents of one length goes by hash bucket first, so that only the bucket
at the cut is ranked.

Null texts have size 0 and are never taken.  A null source is a source, after all others.  Rows that
repeat a ``doc_id`` are drawn one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import staged, unpacked, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 17
#: Words over which the dynamic programming runs at most.
DP_BUDGET = 100_000
#: Hash buckets of the draw within one source and length.
BUCKETS = 4096


def n_words(column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, repeats: float) -> list[float]:
    """Shares of ``total`` by weight; what exceeds ``repeats`` times a size goes to the others by weight."""
    out, open_ = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_:
        unit = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if unit * weights[k] > repeats * sizes[k]]
        if not full:
            for k in open_:
                out[k] = unit * weights[k]
            break
        for k in full:
            out[k] = float(repeats * sizes[k])
            left -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near ``budget`` as they can from below."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = (counts * (budget / total)).astype(np.int64)
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths)
    for k in order:  # long lengths while more is left than the dynamic programming takes
        if left <= DP_BUDGET:
            break
        more = min(int(counts[k] - taken[k]), (left - DP_BUDGET) // int(lengths[k]) + 1, left // int(lengths[k]))
        taken[k] += more
        left -= more * int(lengths[k])
    return taken + _knapsack(lengths, counts - taken, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: sums reachable so far as the bits of one integer, a step for each power-of-two lot of a length."""
    lots, reach, mask = [], [1], (1 << (budget + 1)) - 1
    for k in np.argsort(lengths):
        room, lot = min(int(counts[k]), budget // int(lengths[k])), 1
        while room > 0:
            lot = min(lot, room)
            reached = (reach[-1] | reach[-1] << lot * int(lengths[k])) & mask
            if reached != reach[-1]:
                lots.append((k, lot))
                reach.append(reached)
            room -= lot
            lot *= 2
        if reach[-1] >> budget & 1:
            break
    at, chosen = reach[-1].bit_length() - 1, np.zeros(len(lengths), np.int64)
    for (k, lot), before in zip(reversed(lots), reversed(reach[:-1]), strict=True):
        if not before >> at & 1:
            chosen[k] += lot
            at -= lot * int(lengths[k])
    return chosen


def _planned(histogram: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """Per source its size and target.  The driver holds one row per source."""
    found = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")).collect()
    rows = sorted(found, key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.source_size for r in rows]
    goal = targets(sizes, [weights[k % len(weights)] for k in range(len(rows))], share * sum(sizes), repeats)
    planned = [(r.source, r.source_size, t) for r, t in zip(rows, goal, strict=True)]
    return histogram.sparkSession.createDataFrame(planned, "source string, source_size long, target double")


def _copies(histogram: DataFrame, planned: DataFrame, repeats: int) -> DataFrame:
    """Per source and length: copies of every document, and how many documents get one more."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        source_size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = min(int(target // source_size), repeats)
        rest = int(target - passes * source_size) if passes < repeats else 0
        extra = fit(pdf["size"].to_numpy(np.int64), pdf["docs"].to_numpy(np.int64), rest)
        return pdf.assign(passes=passes, extra=extra)[["source", "size", "passes", "extra"]]

    sized = histogram.where("size > 0").join(planned.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    return sized.groupBy("source").applyInPandas(choose, "source string, size long, passes int, extra long")


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which null equals null; the keys come from the left."""
    renamed = right.select(*(F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns))
    condition = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys))
    return left.join(renamed, condition, how).drop(*(f"_{c}" for c in keys))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``text_key``, ``size``, ``source_size``, ``target`` and ``copies``."""
    draw = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text"))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("source").cast("string").alias("source"),
        n_words().alias("size"),
        draw.alias("draw"),
    )
    slim = staged(slim.withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)).cast("int")), "mix-documents")
    buckets = staged(slim.groupBy("source", "size", "bucket").agg(F.count("*").alias("docs")), "mix-lengths")
    histogram = buckets.groupBy("source", "size").agg(F.sum("docs").alias("docs"))
    planned = staged(_planned(histogram, weights, share, repeats), "mix-targets")
    order = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("before", F.coalesce(F.sum("docs").over(order), F.lit(0)))
    room = _on(placed, _copies(histogram, planned, repeats), ("source", "size"))
    room = room.select("source", "size", "bucket", "passes", (F.col("extra") - F.col("before")).alias("room"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw"))
    drawn = _on(slim.withColumn("rank", rank), room, ("source", "size", "bucket"), "left")
    copies = F.coalesce(F.col("passes") + (F.col("rank") <= F.col("room")).cast("int"), F.lit(0))
    return _on(drawn.withColumn("copies", copies), planned, ("source",)).select("doc_id", "text_key", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``, how often each is to be read."""
    ids = ("_id", "_text")
    nth = F.row_number().over(Window.partitionBy(*ids).orderBy(F.lit(0)))  # tells apart rows that are the same
    chosen = mix(docs, **parameters).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "copies").withColumn("_nth", nth)
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_text")).withColumn("_nth", nth)
    taken = _on(rows, chosen.where("copies > 0"), (*ids, "_nth"))
    return taken.select(*unpacked([c for c in docs.columns if c != "copies"]), "copies")
