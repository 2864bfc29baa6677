"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are laid out in cells by the population counts of their two halves.  Two
fingerprints within the radius differ by no more than the radius in the sum of both counts, so only
cells that near are compared; the other tile pairs are skipped.  A cell with many fingerprints is cut
into tiles of bounded size.  Inside a tile pair numpy compares by exclusive-or and bit counts, and again
skips what four lane counts rule out.  A tile pair returns a spanning forest of its links, which is
linear in its rows however many links there are.

Null texts count as empty.  Texts without words have fingerprint zero and link like any other.  Rows
that repeat a ``doc_id`` are kept.  Null ``doc_id``s never name a component unless nothing else can.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import bytes_of, staged, texts, unpacked, whole_row
from fleetlake.llm.components import components

TILE_ROWS = 65_536
_SHINGLES_AT_ONCE = 200_000
_PAIRS_AT_ONCE = 1 << 22


def fingerprint(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Bit b is 1 if it is set in over half the hashes of the shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle)), strict=False))
    total, counts, digest = max(1, len(words) - words_per_shingle + 1), np.zeros(64, np.int64), xxhash.xxh64_digest
    for _ in range(0, total, _SHINGLES_AT_ONCE):
        some = b"".join([digest(s, seed) for s in islice(shingles, _SHINGLES_AT_ONCE)])
        bits = np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long, for every row."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(found)], [*keep, "fp"])

    chosen = docs.select(*keep)
    return docs.select(*keep, bytes_of()).mapInArrow(each, chosen.withColumn("fp", F.lit(0).cast("long")).schema)


def _forest(size: int, chunks: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of ``size`` nodes reaches over the links."""
    root = np.arange(size)
    for a, b in chunks:
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            open_ = low != high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(root, high[open_], low[open_])
            while (root[root] != root).any():
                root = root[root]
    return root


def _lanes(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def near_pairs(home: np.ndarray, other: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs within ``radius`` bits, a chunk at a time."""
    if len(home) * len(other) <= _PAIRS_AT_ONCE // 64:
        yield np.nonzero(np.bitwise_count(home[:, None] ^ other[None, :]) <= radius)
        return
    lanes, order = np.unique(_lanes(other), axis=0, return_inverse=True)
    order = order.reshape(-1)
    by_lane = np.argsort(order, kind="stable")
    begin = np.searchsorted(order[by_lane], np.arange(len(lanes) + 1))
    own, inverse = np.unique(_lanes(home), axis=0, return_inverse=True)
    inverse = inverse.reshape(-1)
    rows = np.argsort(inverse, kind="stable")
    cut = np.searchsorted(inverse[rows], np.arange(len(own) + 1))
    for k, lane in enumerate(own):
        close = np.flatnonzero(np.abs(lanes - lane).sum(axis=1) <= radius)
        if not len(close):
            continue
        theirs = np.concatenate([by_lane[begin[c] : begin[c + 1]] for c in close])
        ours = rows[cut[k] : cut[k + 1]]
        step = max(1, _PAIRS_AT_ONCE // len(theirs))
        for at in range(0, len(ours), step):
            some = ours[at : at + step]
            i, j = np.nonzero(np.bitwise_count(home[some][:, None] ^ other[theirs][None, :]) <= radius)
            if len(i):
                yield some[i], theirs[j]


def links(distinct: DataFrame, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``u``, ``v`` between distinct ``fp``s that join exactly what lies within ``radius`` bits."""
    half = F.lit(0xFFFFFFFF).cast("long")
    cells = distinct.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int").alias("hi"),
        F.bit_count(F.col("fp").bitwiseAND(half)).cast("int").alias("lo"),
    )
    tiles = [0] * (33 * 33)
    for row in cells.groupBy("hi", "lo").count().collect():  # 33 x 33 cells at most
        tiles[row.hi * 33 + row.lo] = -(-row["count"] // tile_rows)
    offsets = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    tile_counts = F.split(F.lit(",".join(map(str, tiles))), ",").cast("array<int>")
    cell, tile_ids = F.col("hi") * 33 + F.col("lo"), F.lit(1 << 40)
    own_tile = F.pmod(F.xxhash64("fp"), F.element_at(tile_counts, cell + 1)).cast("int")
    near = F.explode(F.array(*[F.struct((F.col("hi") + x).alias("hi"), (F.col("lo") + y).alias("lo")) for x, y in offsets]))
    sent = (
        cells.select("fp", "hi", "lo", (cell * tile_ids + own_tile).alias("home"))
        .select("fp", "home", near.alias("n"))
        .where("n.hi between 0 and 32 and n.lo between 0 and 32")
        .select("fp", "home", (F.col("n.hi") * 33 + F.col("n.lo")).alias("there"))
        .withColumn("k", F.element_at(tile_counts, F.col("there") + 1))
        .where("k > 0")
        .select("fp", "home", (F.col("there") * tile_ids).alias("there"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("t"))
        .select(
            "fp",
            F.least("home", F.col("there") + F.col("t")).alias("a"),
            F.greatest("home", F.col("there") + F.col("t")).alias("b"),
            (F.col("home") > F.col("there") + F.col("t")).alias("second"),
        )
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, second, fp in _tile_pairs(batches):
            left = np.arange(len(fp)) if a == b else np.flatnonzero(~second)
            right = left if a == b else np.flatnonzero(second)
            root = _forest(len(fp), ((left[i], right[j]) for i, j in near_pairs(fp[left], fp[right], radius)))
            own = np.flatnonzero(root != np.arange(len(fp)))
            signed = fp.view(np.int64)
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(signed[root[own]])], ["u", "v"])

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(parts, "a", "b").sortWithinPartitions("a", "b").mapInArrow(compare, "u long, v long")


def _tile_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The rows of each tile pair, from rows in order of the pairs."""
    kept: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        a, b, fp = (batch.column(c).to_numpy() for c in ("a", "b", "fp"))
        second = batch.column("second").to_numpy(zero_copy_only=False)
        cuts = [*(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1), len(a)]
        start = 0
        for stop in cuts:
            part = (a[start:stop], b[start:stop], second[start:stop], fp[start:stop])
            if len(part[0]) and kept and (kept[-1][0][0], kept[-1][1][0]) != (part[0][0], part[1][0]):
                yield from _joined(kept)
                kept = []
            kept += [part] * bool(len(part[0]))
            start = stop
    if kept:
        yield from _joined(kept)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    if sum(len(p[0]) for p in parts) > 1:
        yield parts[0][0][0], parts[0][1][0], np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]).view(np.uint64)


def _classes(marked: DataFrame, best: Column, radius: int) -> DataFrame:
    """For each ``fp`` of ``marked`` the smallest ``best`` of all rows that it reaches."""
    distinct = staged(marked.groupBy("fp").agg(best.alias("best")), "simhash-distinct")
    roots = components(staged(links(distinct, radius), "simhash-links"))  # compared once; a forest, so no more links than prints
    classes = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    return classes.join(classes.groupBy("root").agg(F.min("best").alias("least")), "root").select("fp", F.col("least").alias("best"))


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for every row of ``docs``."""
    marked = staged(fingerprints(docs, ["doc_id"]), "simhash-fp")
    classes = _classes(marked, F.min("doc_id"), radius)
    return marked.join(classes, "fp").select("doc_id", "fp", F.col("best").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` less all but one of each component: that of the smallest ``doc_id``.

    Null ``doc_id``s come last.  Of rows with the same ``doc_id`` and text one stays.
    """
    keyed = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_text"), "text")
    keyed = keyed.withColumn("_key", F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("none")), "_text"))
    marked = staged(fingerprints(keyed, ["_id", "_key"]), "simhash-fp")
    best = F.min(F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_key"))
    chosen = _classes(marked, best, radius).select(F.col("best._key").alias("_key")).distinct()
    kept = keyed.select("_row", "_key").join(chosen, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select(*unpacked(docs.columns))
