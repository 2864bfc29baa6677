"""Exact ranked lexical search over sparse ball trees.

A document is the sparse vector of its terms' saturated frequencies, a query that of its terms' weights, and
the score their inner product in whole numbers.  Documents are laid out in order of their most telling
terms and cut into trees; a node has the centroid of its documents and the radius around it, so that no
document below it scores more than query x centroid + |query| x radius.  Nodes are opened best first over
all trees of a task and the search stops when the best bound, widened for rounding, is under the k-th
score found; leaves are scored in 64-bit integers.

The bounds live in a scaled space: a term's coordinate is stretched in documents and shrunk in queries by
the root of about its weight, which changes no product and makes balls of common words small.  The
stretch goes by a table of ``CELLS`` cells of terms, whatever the vocabulary.

Documents keep the terms of queries only, sifted by a bit table of ``FILTER_BITS`` bits; what passes it wrongly
meets no query.  Terms are compared by 64-bit hashes: two terms of one corpus meet with odds of about the
product of both vocabularies over 2**64.

Null and empty texts have no terms.  Every row of the queries is a query, every row of the documents a
document, repeated ids included; documents without an id come last among equal scores.  A very long
text is a tree of its own and needs memory in proportion.  Only ids and texts are read, so other columns may
have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import CHUNK_BYTES, WORD_TABLE, Tokens, bounded, byte_classes, bytes_of, staged, texts
from fleetlake.llm.dealing import group_number, groups_of, met

FILTER_BITS, CELLS = 24, 1 << 16
#: Documents and values of a tree, documents of a leaf, trees that a task holds.
TREE_ROWS, TREE_VALUES, LEAF_ROWS, GROUP_TREES = 4096, 1 << 19, 256, 4
#: Queries of a block.
BLOCK_QUERIES = 128
#: Scale of a document's values, slope and pivot of the length term, in hundredths.
SCALE, SLOPE, SATURATION = 1_000_000_000, 90, 8

_BLANK = byte_classes(b" \n")
_ROOM = 1e-9


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """For each term of a batch of texts its text's number and its hash."""
    tokens = Tokens([t.translate(WORD_TABLE) for t in texts(batch)], _BLANK)
    return tokens.doc, tokens.hashes()


def _parted(owner: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns' values for each of ``n`` owners; ``owner`` is in order."""
    ends = np.searchsorted(owner, np.arange(n + 1))
    for k in range(n):
        yield tuple(c[ends[k] : ends[k + 1]] for c in columns)


def _items(items: DataFrame, id_column: str) -> DataFrame:
    """Each query's row number, id and distinct terms."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            owner, h = _hashed(batch)
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order].view(np.int64)
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            found = [pa.array(x) for (x,) in _parted(owner[new], batch.num_rows, h[new])]
            terms = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), pa.concat_arrays(found))
            yield pa.RecordBatch.from_arrays([batch.column("ask"), batch.column("item_id"), terms], ["ask", "item_id", "terms"])

    given = items.select(F.monotonically_increasing_id().alias("ask"), F.col(f"`{id_column}`").alias("item_id"), bytes_of())
    schema = given.select("ask", "item_id").withColumn("terms", F.lit(None).cast("array<long>")).schema
    return staged(given.mapInArrow(each, schema), "lexical-items")


def _filter(terms: DataFrame) -> np.ndarray:
    """The bit table of the queries' terms, by the upper bits of their hashes."""
    place = F.shiftrightunsigned("term", 64 - FILTER_BITS)
    words = terms.select((place / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(term, {64 - FILTER_BITS}) % 64 as int))").alias("bit"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # one row for each 64 bits at most
        table[r.word] = r.bits
    return table.view(np.uint64)


_COUNTED = "row long, doc_id long, n long, terms binary, tf binary"


def _counted(docs: DataFrame, id_column: str, table: np.ndarray) -> DataFrame:
    """Each document's number of terms, and the frequencies of those that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in bounded(batches, limit=CHUNK_BYTES // 2):
            owner, h = _hashed(batch)
            n = np.bincount(owner, minlength=batch.num_rows)
            place = h >> np.uint64(64 - FILTER_BITS)
            passes = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            owner, h = owner[passes], h[passes]
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            begin = np.flatnonzero(first)
            tf = np.diff(begin, append=len(h)).astype(np.int32)
            parts = list(_parted(owner[begin], batch.num_rows, h[begin], tf))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64())]
                + [pa.array([p[c].tobytes() for p in parts], pa.binary()) for c in (0, 1)],
                ["row", "doc_id", "n", "terms", "tf"],
            )

    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("long").alias("doc_id"), bytes_of())
    return staged(given.mapInArrow(each, _COUNTED), "lexical-counted")


def _frequencies(counted: DataFrame) -> DataFrame:
    """In how many documents each term stands."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, df = np.unique(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df, pa.int64())], ["term", "df"])

    return counted.select("terms").mapInArrow(each, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Corpus:
    """What the values of a document depend on besides itself."""

    def __init__(self, documents: int, terms: int, weights: np.ndarray):
        self.documents, self.terms, self.stretch = documents, terms, np.sqrt(np.maximum(weights, 1.0))

    def values(self, n: int, tf: np.ndarray) -> np.ndarray:
        m = 100 - SLOPE + (SLOPE * n * self.documents) // self.terms
        return (SCALE * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + SATURATION * m)

    def stretched(self, terms: np.ndarray) -> np.ndarray:
        return self.stretch[terms & np.int64(CELLS - 1)]


def _corpus(counted: DataFrame, weighed: DataFrame) -> Corpus:
    facts = counted.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(CELLS)
    cells = weighed.groupBy(F.col("term").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.avg("w").alias("w"))
    for r in cells.collect():  # CELLS rows at most
        weights[r.cell] = r.w
    return Corpus(facts.documents, facts.terms, weights)


def _grown(y: np.ndarray, owner: np.ndarray, term: np.ndarray, rows: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """An order of ``rows`` sparse rows, and the spans of the nodes in it, the root first, children behind each other."""
    order, spans, at = np.arange(rows), [(0, rows)], 0
    width = int(term.max(initial=-1)) + 1
    begin = np.searchsorted(owner, np.arange(rows + 1))
    lengths = np.bincount(owner, y * y, rows)

    def apart(some: np.ndarray, point: np.ndarray) -> np.ndarray:
        sizes = begin[some + 1] - begin[some]
        at_ = np.repeat(begin[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return lengths[some] - 2 * np.bincount(np.repeat(np.arange(len(some)), sizes), y[at_] * point[term[at_]], len(some))

    def point(k: int) -> np.ndarray:
        out = np.zeros(width)
        out[term[begin[k] : begin[k + 1]]] = y[begin[k] : begin[k + 1]]
        return out

    while at < len(spans):
        low, high = spans[at]
        if high - low > LEAF_ROWS:
            some = order[low:high]
            one = point(some[np.argmax(apart(some, point(some[0])))])
            from_one = apart(some, one)
            other = apart(some, point(some[np.argmax(from_one)]))
            order[low:high] = some[np.argsort(from_one - other, kind="stable")]
            middle = (low + high) // 2
            spans += [(low, middle), (middle, high)]
        at += 1
    return order, spans


_TREE = "block long, docs binary, named binary, rows binary, sizes binary, terms binary, x binary, spans binary, node_sizes binary, node_terms binary, node_values binary, radii binary"
_TREE_COLUMNS = [f.split()[0] for f in _TREE.split(", ")]


def _tree(batch: list[dict], corpus: Corpus) -> dict:
    """A ball tree of some documents, packed."""
    sizes = np.array([len(r["terms"]) // 8 for r in batch], np.int64)
    every = np.frombuffer(b"".join(r["terms"] for r in batch), np.int64)
    x = np.concatenate([corpus.values(r["n"], np.frombuffer(r["tf"], np.int32)) for r in batch])
    own, term = np.unique(every, return_inverse=True)
    owner, stretch = np.repeat(np.arange(len(batch)), sizes), corpus.stretched(own)
    order, spans = _grown(x * stretch[term], owner, term, len(batch))
    place = np.empty(len(batch), np.int64)
    place[order] = np.arange(len(batch))
    by_place = np.argsort(place[owner], kind="stable")
    term, x, sizes, owner = term[by_place], x[by_place], sizes[order], place[owner][by_place]
    ends, y = np.cumsum(sizes), x * stretch[term]
    node_terms, node_values, radii = [], [], []
    room = np.sqrt(8 * np.finfo(float).eps * (sizes.max() + 16))  # what rounding may hide in a sum, after the root
    for low, high in spans:
        part = slice(ends[low] - sizes[low], ends[high - 1])
        centre = np.bincount(term[part], y[part], len(own)) / (high - low)
        local = owner[part] - low
        squared = np.bincount(local, y[part] * (y[part] - 2 * centre[term[part]]), high - low) + centre @ centre
        longest = np.sqrt(np.bincount(local, y[part] ** 2, high - low).max())
        radii.append(np.sqrt(max(0.0, squared.max())) + room * longest)
        held = np.flatnonzero(centre)
        node_terms.append(held)
        node_values.append(centre[held])
    ids = [batch[k]["doc_id"] for k in order]
    return {
        "block": batch[0]["row"],
        "docs": np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64).tobytes(),
        "named": np.array([i is not None for i in ids]).tobytes(),
        "rows": np.array([batch[k]["row"] for k in order], np.int64).tobytes(),
        "sizes": sizes.astype(np.int32).tobytes(),
        "terms": own[term].tobytes(),
        "x": x.astype(np.int32).tobytes(),
        "spans": np.array(spans, np.int32).tobytes(),
        "node_sizes": np.array([len(t) for t in node_terms], np.int32).tobytes(),
        "node_terms": own[np.concatenate(node_terms)].tobytes(),
        "node_values": np.concatenate(node_values).tobytes(),
        "radii": np.array(radii).tobytes(),
    }


def _trees(counted: DataFrame, corpus: Corpus) -> DataFrame:
    """The documents that hold a query's term, in order of their two most telling terms, as trees."""

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for k, (terms, tf, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("terms", "tf", "n")), strict=True)):
                t = np.frombuffer(terms, np.int64)
                value = corpus.values(n, np.frombuffer(tf, np.int32)) * corpus.stretched(t) ** 2
                best = np.lexsort((t, -value))[:2]
                first[k], second[k] = t[best[0]], t[best[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), pa.array(second)], [*batch.schema.names, "first", "second"])

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, values = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if kept and (len(kept) >= TREE_ROWS or values + len(r["terms"]) // 8 > TREE_VALUES):
                    yield pa.RecordBatch.from_pylist([_tree(kept, corpus)], schema=_ARROW_TREE)
                    kept, values = [], 0
                kept.append(r)
                values += len(r["terms"]) // 8
        if kept:
            yield pa.RecordBatch.from_pylist([_tree(kept, corpus)], schema=_ARROW_TREE)

    marked = counted.where(F.length("terms") > 0).mapInArrow(told, f"{_COUNTED}, first long, second long")
    keys = ["first", "second", "n", "row"]
    return staged(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(grow, _TREE), "lexical-trees")


_ARROW_TREE = pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in _TREE_COLUMNS[1:]])


class Tree:
    """A packed tree as far as the terms of some queries go."""

    def __init__(self, row: dict, terms: np.ndarray):
        self.docs, self.named, self.rows = (np.frombuffer(row[c], t) for c, t in (("docs", np.int64), ("named", bool), ("rows", np.int64)))
        self.spans, self.radii = np.frombuffer(row["spans"], np.int32).reshape(-1, 2), np.frombuffer(row["radii"])
        #: Values of the documents and of the nodes' centroids, by the number of their term in ``terms``.
        self.term, self.x, self.ends = self._known(row["terms"], np.frombuffer(row["x"], np.int32).astype(np.int64), row["sizes"], terms)
        self.node_term, self.value, self.node_ends = self._known(row["node_terms"], np.frombuffer(row["node_values"]), row["node_sizes"], terms)
        #: The first child of each node, or 0 for a leaf; the second is behind it.
        inner = self.spans[:, 1] - self.spans[:, 0] > LEAF_ROWS
        self.child = np.where(inner, 2 * np.cumsum(inner) - 1, 0)

    @staticmethod
    def _known(packed: bytes, values: np.ndarray, sizes: bytes, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        every, counts = np.frombuffer(packed, np.int64), np.frombuffer(sizes, np.int32)
        number = np.minimum(np.searchsorted(terms, every), len(terms) - 1)
        known = terms[number] == every
        before = np.concatenate([[0], np.cumsum(known)])
        return number[known].astype(np.int32), values[known], before[np.concatenate([[0], np.cumsum(counts)])]

    def bound(self, node: int, query: np.ndarray, length: float) -> float:
        """No document below ``node`` scores more."""
        part = slice(self.node_ends[node], self.node_ends[node + 1])
        at_centre = query[self.node_term[part]] @ self.value[part]
        return (at_centre + length * self.radii[node]) * (1 + _ROOM)

    def scores(self, leaf: int, weights: np.ndarray) -> np.ndarray:
        low, high = self.spans[leaf]
        ends = self.ends[low : high + 1]
        part = slice(ends[0], ends[-1])
        sums = np.concatenate([[0], np.cumsum(weights[self.term[part]] * self.x[part])])
        return np.diff(sums[ends - ends[0]])


def _best_first(trees: list[Tree], weights: np.ndarray, query: np.ndarray, k: int) -> list[tuple[int, int, bool, int]]:
    """Score, document, whether it is named, and row of the ``k`` best documents over all trees."""
    length, found = float(np.sqrt(query @ query)), []
    open_ = [(-t.bound(0, query, length), n, 0) for n, t in enumerate(trees)]
    heapq.heapify(open_)
    least = 1
    while open_ and -open_[0][0] >= least:
        _, n, node = heapq.heappop(open_)
        tree = trees[n]
        if child := int(tree.child[node]):
            for c in (child, child + 1):
                bound = tree.bound(c, query, length)
                if bound >= least:
                    heapq.heappush(open_, (-bound, n, c))
            continue
        scores, low = tree.scores(node, weights), tree.spans[node][0]
        good = np.flatnonzero(scores >= least)
        if len(good) > k:
            cut = np.partition(scores[good], len(good) - k)[len(good) - k]
            good = good[scores[good] >= cut]
        at = good + low
        found += zip((-scores[good]).tolist(), tree.docs[at].tolist(), (~tree.named[at]).tolist(), tree.rows[at].tolist(), strict=True)
        found = sorted(found)[:k]
        if len(found) == k:
            least = max(1, -found[-1][0])
    return found


_FOUND = "ask long, score long, doc_id long, row long"
_ARROW_FOUND = pa.schema([(f.split()[0], pa.int64()) for f in _FOUND.split(", ")])


def _searched(corpus: Corpus, k: int):
    def visit(asking: pa.Table, asked: pa.Table) -> pa.Table:
        queries = [q for block in asking.to_pylist() for q in block["queries"]] if asked.num_rows else []
        if not queries:  # no query was dealt to this group
            return pa.Table.from_pylist([], schema=_ARROW_FOUND)
        terms = np.unique(np.array([t["term"] for q in queries for t in q["terms"]], np.int64))
        stretch, trees = corpus.stretched(terms), [Tree(row, terms) for row in asked.to_pylist()]
        out: list[tuple] = []
        for q in queries:
            weights = np.zeros(len(terms), np.int64)
            weights[np.searchsorted(terms, [t["term"] for t in q["terms"]])] = [t["w"] for t in q["terms"]]
            for score, doc, unnamed, row in _best_first(trees, weights, weights / stretch, k):
                out.append((q["ask"], -score, None if unnamed else doc, row))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW_FOUND)

    return visit


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_column: str = "doc_id", item_column: str = "item_id") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``k`` documents with the greatest scores above zero for each item.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), its value in a document 10**9 tf div (1000 tf + 8 m), where
    m is 10 + 90 n N div L: N documents with terms, L their terms, n this document's.
    """
    asked = _items(items, item_column)
    empty = asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    terms = asked.select("ask", F.explode("terms").alias("term"))
    counted = _counted(docs, doc_column, _filter(terms.select("term")))
    facts = counted.where("n > 0").agg(F.count("*").alias("n")).first()
    share = F.lit(2.0 * facts.n + 2) / (2 * F.col("df") + 1)
    weighed = staged(_frequencies(counted).join(terms.select("term").distinct(), "term", "left_semi").withColumn("w", F.floor(1000 * F.log(share)).cast("long")), "lexical-weights")
    corpus = _corpus(counted, weighed)
    trees = _trees(counted, corpus)
    asking = terms.join(weighed, "term").groupBy("ask").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    n_trees, n_items = trees.count(), asking.count()
    if not n_trees or not n_items:
        return empty
    ask_groups, block_groups = groups_of(n_items, BLOCK_QUERIES), groups_of(n_trees, GROUP_TREES)
    dealt = asking.groupBy(group_number("ask", ask_groups).alias("ask_group")).agg(F.collect_list(F.struct("ask", "terms")).alias("queries"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = staged(dealt, "lexical-queries").withColumn("block_group", every(block_groups))
    data = trees.withColumn("block_group", group_number("block", block_groups)).withColumn("ask_group", every(ask_groups))
    found = met(queries, data, _searched(corpus, k), _FOUND)
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("ask", "item_id"), "ask").select("item_id", "rank", "doc_id", "score")
