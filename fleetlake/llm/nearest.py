"""Exact top-k inner-product search over a pivot-distance index.

Vectors are lifted by one coordinate to equal length, so that the greatest inner product with a query is
the least distance.  A vector's key is its nearest pivot and its distance to it; the keys of a pivot are cut
into annuli, and an annulus of many equal distances into parts.  A query first searches the annulus that
it lies in; its k-th score there is a radius.  By the triangle inequality only annuli whose distances to
their pivot come within the radius of the query's own can hold more.  Those are visited nearest first, the
radius shrinks on the way, and the search stops at the first annulus beyond it.

Distances only rule out, with room for rounding; scores are exact while the largest squared length is under
2**62.  Beyond that they are doubles held to the range of a long, and rank as such.

The index covers every row.  Pivots come from a sample of ``SAMPLE`` rows; they decide how much is skipped,
never what is found.  Vectors that are null or hold null or non-finite components take no part; shorter
vectors count as padded with zeros.  Rows that repeat an id are rows of their own: each asks, and each is found.
Rows without an id are found after others of their score.  Of the table the id, the vector and what ``asks`` needs are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import staged
from fleetlake.llm.dealing import group_number, groups_of, met

#: Rows that pivots are chosen from; pivots at most.
SAMPLE, PIVOTS = 4096, 64
#: Annuli per pivot at most; an annulus with more rows than a block is cut into parts.
RINGS = 512
BLOCK_ROWS, BLOCK_BYTES = 8192, 16 << 20
#: What one task holds of either side.
GROUP_BYTES, GROUP_BLOCKS, GROUP_QUERIES = 32 << 20, 8, 64
_QUERIES_AT_ONCE = 256
_UNPRUNED = 1e300

_VECTORS = "row long, id long, named boolean, asks boolean, v binary, squared double, dims int"


def _scaled(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    """floor(scale * x) of each component; None for vectors that take no part."""
    sizes, flat = column.value_lengths().to_pylist(), column.flatten()
    absent = flat.is_null().to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        values = np.floor(scale * flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
    values[absent] = np.nan
    out, at = [], 0
    for n in sizes:
        v = None if n is None else values[at : at + n]
        out.append(v if v is not None and np.isfinite(v).all() else None)
        at += n or 0
    return out


def vectors(table: DataFrame, asks: Column, id_column: str, column: str, scale: float) -> DataFrame:
    """The rows that take part, their components as packed doubles."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scaled(batch.column("v"), scale)
            good = [k for k, v in enumerate(found) if v is not None]
            kept = batch.take(pa.array(good, pa.int64()))
            rest = [found[k] for k in good]
            with np.errstate(over="ignore"):
                squared = [float(v @ v) for v in rest]
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("row"),
                    kept.column("id").fill_null(np.iinfo(np.int64).max),
                    kept.column("id").is_valid(),
                    kept.column("asks"),
                    pa.array([v.tobytes() for v in rest], pa.binary()),
                    pa.array(squared, pa.float64()),
                    pa.array([len(v) for v in rest], pa.int32()),
                ],
                ["row", "id", "named", "asks", "v", "squared", "dims"],
            )

    given = table.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.col(f"`{column}`").cast("array<double>").alias("v"),
    )
    return given.mapInArrow(each, _VECTORS)


def _matrix(packed: Iterable[bytes], dims: int) -> np.ndarray:
    """Packed vectors as rows, padded with zeros."""
    rows = [np.frombuffer(p) for p in packed]
    out = np.zeros((len(rows), dims))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


class Space:
    """The lifted space: its length, pivots, and what rounding may add to a distance."""

    def __init__(self, sample: np.ndarray, longest: float, count: int):
        self.dims, self.longest = sample.shape[1], longest
        self.prunes = longest < _UNPRUNED
        self.slack = np.sqrt(longest * np.finfo(float).eps * 16 * (self.dims + 8)) if self.prunes else 0.0
        lifted = np.column_stack([sample, self._height(sample)])
        n = int(np.clip(count // 512, 1, min(PIVOTS, len(lifted))))
        self.pivots = lifted[:n]
        for _ in range(4 if self.prunes else 0):
            near = self._squared(self.pivots, lifted, (lifted**2).sum(axis=1)).argmin(axis=0)
            self.pivots = np.stack([lifted[near == k].mean(axis=0) if (near == k).any() else p for k, p in enumerate(self.pivots)])

    def _height(self, v: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.longest - (v**2).sum(axis=1))) if self.prunes else np.zeros(len(v))

    @staticmethod
    def _squared(pivots: np.ndarray, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (pivots**2).sum(axis=1)[:, None] + lengths[None, :] - 2 * (pivots @ points.T)

    def _distances(self, v: np.ndarray, height: np.ndarray) -> np.ndarray:
        if not self.prunes:
            return np.zeros((len(v), len(self.pivots)))
        points = np.column_stack([v, height])
        return np.sqrt(np.maximum(0.0, self._squared(self.pivots, points, (points**2).sum(axis=1)))).T

    def of_rows(self, v: np.ndarray) -> np.ndarray:
        """Distances of rows to the pivots."""
        return self._distances(v, self._height(v))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return self._distances(q, np.zeros(len(q)))

    def radius(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far from a query rows can be whose score is ``least`` or more."""
        with np.errstate(all="ignore"):
            squared = (q**2).sum(axis=1) + self.longest - 2 * least
            return np.where(np.isfinite(squared), np.sqrt(np.maximum(0.0, squared)) + 2 * self.slack, np.inf) if self.prunes else np.full(len(q), np.inf)

    def scores(self, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        if self.longest < 2.0**53:
            return q @ v.T  # no partial sum is greater than the product of the lengths
        if self.longest < 2.0**62:
            return q.astype(np.int64) @ v.astype(np.int64).T
        with np.errstate(all="ignore"):
            return np.clip(np.nan_to_num(q @ v.T), -(2.0**63), np.nextafter(2.0**63, 0))


class Best:
    """The best candidates of several queries so far, and the least score that still counts."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.owner = np.zeros(0, np.int64)
        self.score, self.id, self.row, self.named = None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, owner: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray, named: np.ndarray) -> None:
        score = score if self.score is None else np.concatenate([self.score, score])
        owner, id_, row, named = (np.concatenate(x) for x in ((self.owner, owner), (self.id, id_), (self.row, row), (self.named, named)))
        order = np.lexsort((row, ~named, id_, -score, owner))
        owner = owner[order]
        begin = np.searchsorted(owner, owner)
        rank = np.arange(len(owner)) - begin
        kept = order[rank < self.k]
        last = order[rank == self.k - 1]
        self.owner, self.score, self.id, self.row, self.named = owner[rank < self.k], score[kept], id_[kept], row[kept], named[kept]
        full = owner[rank == self.k - 1]
        self.least[full] = np.maximum(self.least[full], np.nextafter(score[last].astype(float), -np.inf))


class Block:
    """Rows of one part of an annulus, by distance to its pivot."""

    def __init__(self, x: dict, dims: int):
        self.pivot, self.rows, self.ids = x["pivot"], np.frombuffer(x["rows"], np.int64), np.frombuffer(x["ids"], np.int64)
        self.named, self.distances = np.frombuffer(x["named"], bool), np.frombuffer(x["distances"])
        self.v = np.frombuffer(x["v"]).reshape(len(self.rows), dims)

    def search(self, space: Space, q: np.ndarray, own: np.ndarray, numbers: np.ndarray, apart: np.ndarray, best: Best) -> None:
        """Adds to ``best`` what queries ``numbers`` find here; ``apart``: their distances to the pivot."""
        radius = space.radius(q, best.least[numbers])
        first = np.searchsorted(self.distances, (apart - radius).min() - space.slack)
        last = np.searchsorted(self.distances, (apart + radius).max() + space.slack, "right")
        scores = space.scores(q, self.v[first:last])
        scores_ok = (scores >= best.least[numbers][:, None]) & (own[:, None] != self.rows[None, first:last])
        i, j = np.nonzero(scores_ok)
        if len(i):
            at = first + j
            best.add(numbers[i], scores[i, j], self.ids[at], self.rows[at], self.named[at])


_BLOCK = "block long, pivot int, nearest double, farthest double, n int, rows binary, ids binary, named binary, distances binary, v binary, asking binary, least binary"


def _blocks(rows: DataFrame, space: Space, k: int, block_rows: int) -> DataFrame:
    """The index: one row per part of an annulus, with the first radius of the queries in it."""
    spark, pivots = rows.sparkSession, len(space.pivots)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = space.of_rows(_matrix(batch.column("v").to_pylist(), space.dims))
            pivot = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            distance = d[np.arange(len(d)), pivot]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot, pa.int32()), pa.array(distance)], [*batch.schema.names, "pivot", "distance"])

    keys = staged(rows.mapInArrow(keyed, f"{_VECTORS}, pivot int, distance double"), "nearest-keys")
    counts = {r.pivot: r["count"] for r in keys.groupBy("pivot").count().collect()}  # PIVOTS rows at most
    rings = int(np.clip(-(-max(counts.values()) // block_rows), 1, RINGS))
    shares = [x / rings for x in range(1, rings)]
    edges = np.full((pivots, len(shares)), np.inf)
    if shares:
        for r in keys.groupBy("pivot").agg(F.percentile_approx("distance", shares, 10_000).alias("e")).collect():
            edges[r.pivot] = r.e

    def ringed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, distance = batch.column("pivot").to_numpy(), batch.column("distance").to_numpy()
            ring = np.zeros(len(pivot), np.int32)
            for p in np.unique(pivot):
                ring[pivot == p] = np.searchsorted(edges[p], distance[pivot == p])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("pivot"), pa.array(ring)], ["row", "pivot", "ring"])

    ring = keys.select("row", "pivot", "distance").mapInArrow(ringed, "row long, pivot int, ring int")
    sizes = ring.groupBy("pivot", "ring").count()  # PIVOTS x RINGS rows at most
    parts = np.ones((pivots, rings), np.int64)
    for r in sizes.collect():
        parts[r.pivot, r.ring] = -(-r["count"] // block_rows)
    first = (np.cumsum(parts.ravel()) - parts.ravel()).reshape(parts.shape)

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, distance = batch.column("pivot").to_numpy(), batch.column("distance").to_numpy()
            at = np.zeros(len(pivot), np.int64)
            for p in np.unique(pivot):
                at[pivot == p] = np.searchsorted(edges[p], distance[pivot == p])
            spread = batch.column("spread").to_numpy() % parts[pivot, at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(first[pivot, at] + spread)], [*batch.schema.names[:-1], "block"])

    dealt = keys.withColumn("spread", F.pmod(F.xxhash64("row"), F.lit(1 << 40)))
    dealt = dealt.mapInArrow(numbered, f"{_VECTORS}, pivot int, distance double, block long")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("distance", "ascending"), ("row", "ascending")])
        column = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        distances, asking = column("distance"), np.flatnonzero(column("asks")).astype(np.int32)
        packed = {
            "block": table.column("block")[0].as_py(),
            "pivot": table.column("pivot")[0].as_py(),
            "nearest": float(distances[0]),
            "farthest": float(distances[-1]),
            "n": table.num_rows,
            "rows": column("row").tobytes(),
            "ids": column("id").tobytes(),
            "named": column("named").astype(bool).tobytes(),
            "distances": distances.tobytes(),
            "v": _matrix(table.column("v").to_pylist(), space.dims).tobytes(),
        }
        here, best = Block(packed, space.dims), Best(k, np.full(len(asking), -np.inf))
        for numbers in np.split(np.arange(len(asking)), range(_QUERIES_AT_ONCE, len(asking), _QUERIES_AT_ONCE)):
            if len(numbers):
                some = asking[numbers]
                here.search(space, here.v[some], here.rows[some], numbers, distances[some], best)
        packed |= {"asking": asking.tobytes(), "least": best.least.tobytes()}
        return pa.Table.from_pylist([packed], schema=_ARROW_BLOCK)

    return staged(dealt.groupBy("block").applyInArrow(pack, _BLOCK), "nearest-index")


_ARROW_BLOCK = pa.schema(
    [("block", pa.int64()), ("pivot", pa.int32()), ("nearest", pa.float64()), ("farthest", pa.float64()), ("n", pa.int32())]
    + [(c, pa.binary()) for c in ("rows", "ids", "named", "distances", "v", "asking", "least")]
)
_ASKING = "ask long, q binary, own binary, named binary, ids binary, least binary, reach array<struct<low:double,high:double>>"


def _queries(blocks: DataFrame, space: Space) -> DataFrame:
    """The queries of each block, and for each pivot the distances at which they can find more."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                b, at, least = Block(x, space.dims), np.frombuffer(x["asking"], np.int32), np.frombuffer(x["least"])
                apart, radius = space.of_queries(b.v[at]), space.radius(b.v[at], least)[:, None]
                low, high = (apart - radius).min(axis=0) - space.slack, (apart + radius).max(axis=0) + space.slack
                out.append(
                    {
                        "ask": x["block"],
                        "q": b.v[at].tobytes(),
                        "own": b.rows[at].tobytes(),
                        "named": b.named[at].tobytes(),
                        "ids": b.ids[at].tobytes(),
                        "least": x["least"],
                        "reach": [{"low": a, "high": c} for a, c in zip(low.tolist(), high.tolist(), strict=True)],
                    }
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW_ASKING)

    return blocks.where(F.length("asking") > 0).mapInArrow(each, _ASKING)


_ARROW_ASKING = pa.schema(
    [("ask", pa.int64())]
    + [(c, pa.binary()) for c in ("q", "own", "named", "ids", "least")]
    + [("reach", pa.list_(pa.struct([("low", pa.float64()), ("high", pa.float64())])))]
)
_FOUND = "own long, query_id long, id long, row long, score long"


def _searched(space: Space, k: int):
    """What the queries of a group find in the blocks of a group: annuli nearest first, as far as the radius."""

    def visit(asking: pa.Table, asked: pa.Table) -> pa.Table:
        blocks = [Block(x, space.dims) for x in asked.to_pylist()]
        pivot = np.array([b.pivot for b in blocks], np.int64)
        nearest, farthest = (np.array([b.distances[e] for b in blocks]) for e in (0, -1))
        out = []
        for x in asking.to_pylist():
            own, ids = np.frombuffer(x["own"], np.int64), np.frombuffer(x["ids"], np.int64)
            named, q = np.frombuffer(x["named"], bool), np.frombuffer(x["q"]).reshape(len(own), space.dims)
            best, apart = Best(k, np.frombuffer(x["least"])), space.of_queries(q)
            gap = np.maximum(0.0, np.maximum(apart[:, pivot] - farthest, nearest - apart[:, pivot])) - space.slack
            for b in np.argsort(gap.min(axis=0), kind="stable"):
                radius = space.radius(q, best.least)
                if gap[:, b].min() > radius.max():
                    break
                active = np.flatnonzero(gap[:, b] <= radius)
                for numbers in np.split(active, range(_QUERIES_AT_ONCE, len(active), _QUERIES_AT_ONCE)):
                    if len(numbers):
                        blocks[b].search(space, q[numbers], own[numbers], numbers, apart[numbers, pivot[b]], best)
            if best.score is not None:
                asker, found = pa.array(ids[best.owner], mask=~named[best.owner]), pa.array(best.id, mask=~best.named)
                out.append((own[best.owner], asker, found, best.row, best.score.astype(np.int64)))
        names = ["own", "query_id", "id", "row", "score"]
        columns = [pa.chunked_array([pa.array(o[c], pa.int64()) for o in out], pa.int64()) for c in range(len(names))]
        return pa.Table.from_arrays(columns, names)

    return visit


def top_products(table: DataFrame, asks: Column, k: int = 10, id_column: str = "vec_id", column: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for each row where ``asks`` holds the ``k`` rows, itself
    excepted, with the greatest inner product of the components floor(scale * x); ties to the smaller id.
    """
    spark = table.sparkSession
    given = vectors(table, asks, id_column, column, scale)
    facts = given.agg(F.count("*").alias("n"), F.max("squared").alias("longest"), F.max("dims").alias("dims")).first()
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = given.orderBy(F.xxhash64("v"), "id").limit(SAMPLE).select("v").collect()
    space = Space(_matrix([r.v for r in sample], max(1, facts.dims)), float(facts.longest), facts.n)
    block_rows = int(np.clip(4 * np.sqrt(facts.n), 256, min(BLOCK_ROWS, max(256, BLOCK_BYTES // (8 * space.dims)))))
    blocks = _blocks(given, space, k, block_rows)
    queries = staged(_queries(blocks, space), "nearest-queries")
    n_blocks, n_queries = blocks.count(), queries.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    per_group = max(1, min(GROUP_BLOCKS, GROUP_BYTES // (8 * space.dims * block_rows)))
    reach = queries.select("ask", F.posexplode("reach").alias("pivot", "r")).select("ask", "pivot", "r.low", "r.high")
    pairs = reach.join(blocks.select("block", "pivot", "nearest", "farthest"), "pivot").where("farthest >= low and nearest <= high")
    ask_group = group_number("ask", groups_of(n_queries, GROUP_QUERIES)).alias("ask_group")
    block_group = group_number("block", groups_of(n_blocks, per_group)).alias("block_group")
    pairs = staged(pairs.select("ask", "block", ask_group, block_group), "nearest-pairs")
    asking = pairs.select("ask", "ask_group", "block_group").distinct().join(queries.drop("reach"), "ask")
    asked = pairs.select("block", "ask_group", "block_group").distinct().join(blocks.drop("nearest", "farthest", "n", "asking", "least"), "block")
    found = met(asking, asked, _searched(space, k), _FOUND)
    order = Window.partitionBy("own").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
