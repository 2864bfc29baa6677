"""Benchmark decontamination over a positional inverted index that is spread over document shards.

``build_index`` writes one row per shard (some documents, in whole): the postings of every term that the
test texts use, as positions in the shard, and the table of the shard's documents.  Positions of
different documents are more than ``gap`` apart, so no match crosses them.  ``search`` reads the index
alone.  For each test window it starts from the shard's rarest term and keeps the positions near which
every further term occurs (proximity), then those where every term stands at its own offset (exact
phrase).  A term that a shard lacks ends the window there.

Words: lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of whole texts.  Nulls and empty texts have none.
Test texts are taken in blocks of at most ``BLOCK_WORDS`` words (or one text), each with an index of its
terms, so what a task holds does not grow with their number.  Rows with one ``item_id`` are one item; an
item without id hits words but is never listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import WORD_TABLE, bounded, bytes_of, staged, texts

#: Words of a window.
WINDOW = 10
#: Words more than its own length over which a window's terms may be spread in a proximity match.
SLOP = 5
BLOCK_WORDS = 500_000
SHARD_BYTES = 8 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


@dataclass
class Tests:
    """Test windows by number of terms: term ids of each, and the item of each."""

    terms: dict[bytes, int] = field(default_factory=dict)
    windows: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    items: list[str | None] = field(default_factory=list)

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], window: int) -> Tests:
        out, by_size, number = cls(), {}, {}
        for item, text in rows:
            ids = [out.terms.setdefault(w, len(out.terms)) for w in words_of(text)]
            k = min(window, len(ids))
            if item not in number:
                number[item] = len(out.items)
                out.items.append(item)
            for at in range(len(ids) - k + 1 if k else 0):
                by_size.setdefault(k, {}).setdefault((*ids[at : at + k], number[item]))
        for k, found in by_size.items():
            both = np.array(list(found), np.int64)
            out.windows[k] = both[:, :k], both[:, k]
        return out


def _runs(positions: np.ndarray) -> bytes:
    """Increasing positions as bytes: differences compress well."""
    return np.diff(positions, prepend=np.int32(0)).astype(np.int32).tobytes()


INDEX = "doc_id array<long>, text_key array<long>, first array<int>, n_words array<int>, terms array<int>, ends array<int>, postings binary"


def build_index(docs: DataFrame, tests: Tests, gap: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard; ``terms[k]``'s postings end at ``ends[k]``."""
    terms = docs.sparkSession.sparkContext.broadcast(tests.terms)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = terms.value.get
        for batch in bounded(batches, limit=shard_bytes):
            ids, counts = [], []
            for text in texts(batch):
                words = words_of(text)
                ids.append(np.fromiter((number(w, -1) for w in words), np.int32, len(words)))
                counts.append(len(words))
            n_words = np.array(counts, np.int32)
            first = np.concatenate([[0], np.cumsum(n_words + gap)[:-1]]).astype(np.int32)
            every = np.concatenate(ids)
            at = np.arange(len(every), dtype=np.int32) + np.repeat(np.arange(len(ids), dtype=np.int32) * gap, n_words)
            known = every >= 0
            every, at = every[known], at[known]
            order = np.argsort(every, kind="stable")
            term, begin = np.unique(every[order], return_index=True)
            ends = np.append(begin[1:], len(every)).astype(np.int32) if len(term) else begin.astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": [batch.column("doc_id").to_pylist()],
                    "text_key": [batch.column("text_key").to_pylist()],
                    "first": [first],
                    "n_words": [n_words],
                    "terms": [term.astype(np.int32)],
                    "ends": [ends],
                    "postings": [_runs(at[order])],
                },
                schema=_ARROW,
            )

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), bytes_of()).mapInArrow(each, INDEX)


_ARROW = pa.schema(
    [*((c, pa.list_(pa.int64())) for c in ("doc_id", "text_key")), *((c, pa.list_(pa.int32())) for c in ("first", "n_words", "terms", "ends")), ("postings", pa.binary())]
)


def matches(postings: list[np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """From the postings of a phrase's terms: where the exact phrase starts, and the places of its rarest
    term that have every other term within ``slop`` words more than the phrase's length."""
    rarest_first = sorted(range(len(postings)), key=lambda k: len(postings[k]))
    rare, span = rarest_first[0], len(postings) + slop - 1
    near = postings[rare]
    for k in rarest_first[1:]:
        own = postings[k]
        low = np.searchsorted(own, near - span)
        near = near[(low < len(own)) & (own[np.minimum(low, len(own) - 1)] <= near + span)]
        if not len(near):
            return near, near
    starts = near - rare
    for k in rarest_first[1:]:
        own, wanted = postings[k], starts + k
        at = np.searchsorted(own, wanted)
        starts = starts[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] == wanted)]
        if not len(starts):
            break
    return starts, near


FOUND = "doc_id long, text_key long, n_words long, hits array<long>, items array<string>, near_items array<string>"


def search(index: DataFrame, tests: Tests, slop: int) -> DataFrame:
    """For every document: the word positions hit, the items that hit, and the items that come near."""
    given = index.sparkSession.sparkContext.broadcast(tests)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _searched(row, given.value, slop)

    return index.mapInArrow(each, FOUND)


def _searched(row: dict, tests: Tests, slop: int) -> pa.RecordBatch:
    terms, ends = np.array(row["terms"], np.int64), np.array(row["ends"], np.int64)
    n_words, first = np.array(row["n_words"], np.int64), np.array(row["first"], np.int64)
    positions = np.cumsum(np.frombuffer(row["postings"], np.int32), dtype=np.int64)
    begins = np.concatenate([[0], ends])
    slot_of = np.full(len(tests.terms), -1, np.int64)
    slot_of[terms] = np.arange(len(terms))
    hits, items, near_items = ([set() for _ in n_words] for _ in range(3))
    for k, (windows, owners) in tests.windows.items():
        slots = slot_of[windows]
        present = (slots >= 0).all(axis=1)
        for slot, item in zip(slots[present].tolist(), owners[present].tolist(), strict=True):
            starts, near = matches([positions[begins[s] : ends[s]] for s in slot], slop)
            for d in set((np.searchsorted(first, near, "right") - 1).tolist()):
                near_items[d].add(item)
            for start in starts.tolist():
                d = int(np.searchsorted(first, start, "right")) - 1
                items[d].add(item)
                hits[d].update(range(start - int(first[d]), start - int(first[d]) + k))
    named = lambda found: [sorted(n for n in map(tests.items.__getitem__, s) if n is not None) for s in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row["doc_id"], pa.int64()),
            pa.array(row["text_key"], pa.int64()),
            pa.array(n_words, pa.int64()),
            pa.array(list(map(sorted, hits)), pa.list_(pa.int64())),
            pa.array(named(items), pa.list_(pa.string())),
            pa.array(named(near_items), pa.list_(pa.string())),
        ],
        ["doc_id", "text_key", "n_words", "hits", "items", "near_items"],
    )


def _blocks(tests: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    block: list[tuple[str | None, bytes]] = []
    room = block_words
    for item, text in tests.select(F.col("item_id").cast("string"), bytes_of()).toLocalIterator():
        block.append((item, bytes(text)))
        room -= len(words_of(block[-1][1]))
        if room <= 0:
            yield block
            block, room = [], block_words
    if block or room == block_words:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``text_key`` (hash of the text), ``n_words``, ``hits``, ``items``, ``near_items``."""
    found = []
    for block in _blocks(benchmark, block_words):
        tests = Tests.of(block, window)
        found.append(search(staged(build_index(docs, tests, gap=window + slop + 1), "postings"), tests, slop))
    if len(found) == 1:
        return found[0]
    every = reduce(DataFrame.union, found)
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)  # noqa: E731  as many as there are blocks
    rows = every.groupBy("doc_id", "text_key", "n_words").agg(
        *map(merged, ("hits", "items", "near_items")), (F.count("*") / len(found)).cast("int").alias("copies")
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of ``benchmark`` occurs."""
    hit = find(docs, benchmark, window, slop=0).where(F.size("hits") > 0)
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    return docs.join(hit, docs.doc_id.eqNullSafe(hit._id) & (F.xxhash64("text") == hit._text), "left_anti")
