"""Exact substring dedup by super-k-mers.

A window is ``WINDOW`` consecutive words.  Its minimiser is the least hash of the runs of ``RUN`` words in
it.  Consecutive windows with the same minimiser are a super-k-mer and travel as one packed string to the
minimiser's bucket.  All copies of a window meet there, since the minimiser depends on the window alone.
A bucket sorts its windows by hash, compares neighbours of equal hash word for word, and returns the spans
of words whose windows occur more than once.

Minimisers are counted first, in cells.  A cell of more than ``HOT_WINDOWS`` windows holds a minimiser that
stands among many different words.  Its windows travel one by one to the bucket of their own hash, where
all copies of a window meet as well, so no bucket grows with such a minimiser.

Before the shuffle a task merges equal super-k-mers: their windows are known to repeat, so their spans are
settled at once and one string goes on for all of them.  A passage with any number of copies therefore
sends a bucket no more than one string per batch.  Strings of one bucket are compressed together.

Words are runs of other bytes than blanks, unchanged.  Null texts have none.  Rows that repeat a
``doc_id`` are kept, and each counts as an occurrence.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import (
    BLANKS,
    Tokens,
    bounded,
    byte_classes,
    bytes_of,
    mixed,
    range_sums,
    span_hashes,
    texts,
    unpacked,
    whole_row,
)

WINDOW = 35
RUN = 5
#: Bytes of text whose super-k-mers a task merges at once, and bytes of strings that a reducing task gets on average.
MERGE_BYTES, TASK_BYTES = 12 << 20, 24 << 20
BUCKETS_PER_TASK = 8
#: Cells of minimisers for each bucket, of some 40,000 windows on average, and windows beyond which a cell is dealt anew.
CELLS_PER_BUCKET, HOT_WINDOWS = 4, 250_000

_WORDS = byte_classes(BLANKS)
PACKED = "bucket int, packed binary, keys binary, starts binary, ends binary, many binary"
_PACKED = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("packed", "keys", "starts", "ends", "many"))])
SPANS = "key long, start int, stop int"
ADDED = ("kept", "n_words", "n_removed")


def _window_min(values: np.ndarray, length: int) -> np.ndarray:
    """The least of ``length`` values from each place on."""
    out, have = values, 1
    while have < length:
        step = min(have, length - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def super_kmers(tokens: Tokens, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word (of all) and number of windows of each super-k-mer, and its minimiser."""
    h = tokens.hashes()
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(h) - run + 1)
    least = _window_min(range_sums(h, at, at + run), window - run + 1)
    whole = tokens.doc[: len(least)] == tokens.doc[window - 1 :]
    begins = whole & np.concatenate([[True], ~whole[:-1] | (least[1:] != least[:-1])])
    first = np.flatnonzero(begins)
    # A super-k-mer ends before the next one or before the first window that crosses into another text.
    stops = np.flatnonzero(np.concatenate([whole[:-1] & (begins[1:] | ~whole[1:]), whole[-1:]]))
    return first, stops - first + 1, least[first]


def _cells(least: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(least) % np.uint64(buckets * CELLS_PER_BUCKET)).astype(np.int64)


def _load(batches: Iterable[pa.RecordBatch], buckets: int, window: int, run: int) -> Iterator[pa.RecordBatch]:
    """The windows that each cell gets from each batch, equal super-k-mers counted once."""
    for batch in bounded(batches, limit=MERGE_BYTES):
        parts = []
        for part in bounded([batch]):
            t = Tokens(texts(part), _WORDS)
            first, count, least = super_kmers(t, window, run)
            parts.append((range_sums(t.hashes(), first, first + count + window - 1), _cells(least, buckets), count))
        if parts:
            string, cell, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            once = np.unique(string, return_index=True)[1]
            found, at = np.unique(cell[once], return_inverse=True)
            n = np.bincount(at.reshape(-1), count[once], minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["cell", "n"])


def hot_cells(docs: DataFrame, buckets: int, window: int = WINDOW, run: int = RUN) -> np.ndarray:
    """The cells whose windows are dealt one by one, in order: at most one for ``HOT_WINDOWS`` windows of all texts."""
    loads = docs.select(bytes_of()).mapInArrow(lambda b: _load(b, buckets, window, run), "cell long, n long")
    hot = loads.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > HOT_WINDOWS)
    return np.array(sorted(r.cell for r in hot.select("cell").collect()), np.int64)


def _dealt(t: Tokens, buckets: int, hot: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of windows of what travels as one string, and its bucket."""
    first, count, least = super_kmers(t, window, run)
    cell = _cells(least, buckets)
    bucket, alone = cell % buckets, np.isin(cell, hot)
    if not alone.any():
        return first, count, bucket
    n = count[alone]
    single = np.repeat(first[alone] - np.cumsum(n) + n, n) + np.arange(n.sum())
    own = (range_sums(t.hashes(), single, single + window) % np.uint64(buckets)).astype(np.int64)
    rest = ~alone
    return (
        np.concatenate([first[rest], single]),
        np.concatenate([count[rest], np.ones(len(single), np.int64)]),
        np.concatenate([bucket[rest], own]),
    )


def _pack(batches: Iterable[pa.RecordBatch], buckets: int, window: int, run: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, limit=MERGE_BYTES):
        merged, size = _Merged(buckets), 0
        for part in bounded([batch]):
            if size > 4 * MERGE_BYTES:  # more than all super-k-mers of a batch: windows dealt one by one
                yield from merged.rows()
                merged, size = _Merged(buckets), 0
            docs = [b" ".join(t.split()) for t in texts(part)]
            t = Tokens(docs, _WORDS)
            first_word = np.searchsorted(t.doc, np.arange(len(docs)))
            first, count, bucket = _dealt(t, buckets, hot, window, run)
            doc = t.doc[first]
            begin, stop = t.start[first], t.end[first + count + window - 2]
            merged.add(t.buffer, begin, stop, part.column("key").to_numpy()[doc], first - first_word[doc], count, bucket, window)
            size += int((stop - begin).sum())
        yield from merged.rows()


class _Merged:
    """The strings of some texts, equal ones once, and the spans that this settles."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.seen: dict[bytes, int] = {}
        self.at: list[tuple[int, int, int]] = []
        self.many: list[bool] = []
        self.bucket_of: list[int] = []
        self.spans: list[tuple[int, int, int]] = []

    def add(self, buffer: bytes, begin, stop, key, start, count, bucket, window: int) -> None:
        seen, at, many, bucket_of, spans = self.seen, self.at, self.many, self.bucket_of, self.spans
        for a, z, own, s, n, b in zip(*(c.tolist() for c in (begin, stop, key, start, count, bucket)), strict=True):
            k = seen.setdefault(buffer[a:z], len(at))
            if k == len(at):
                at.append((own, s, n))
                many.append(False)
                bucket_of.append(b)
            else:
                if not many[k]:
                    many[k] = True
                    spans.append((at[k][0], at[k][1], at[k][1] + at[k][2] + window - 1))
                spans.append((own, s, s + n + window - 1))

    def rows(self) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        strings = list(self.seen)
        order = np.argsort(np.array(self.bucket_of, np.int64), kind="stable")
        sorted_buckets = np.array(self.bucket_of, np.int64)[order]
        cuts = [0, *(np.flatnonzero(sorted_buckets[1:] != sorted_buckets[:-1]) + 1).tolist(), len(order)] if len(order) else [0]
        info = np.array(self.at, np.int64).reshape(-1, 3)
        flags = np.array(self.many, np.uint8)
        rows: list[tuple] = []
        for a, z in zip(cuts, cuts[1:], strict=False):
            some = order[a:z]
            rows.append(
                (
                    int(sorted_buckets[a]),
                    squeeze(b"\n".join([strings[k] for k in some.tolist()])),
                    info[some, 0].tobytes(),
                    info[some, 1].astype(np.int32).tobytes(),
                    None,
                    flags[some].tobytes(),
                )
            )
        if self.spans:
            s = np.array(self.spans, np.int64)
            ends = (s[:, 1].astype(np.int32).tobytes(), s[:, 2].astype(np.int32).tobytes())
            rows.append((int(s[0, 0] % self.buckets), None, s[:, 0].tobytes(), *ends, None))
        for at_row in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows[at_row : at_row + 64], strict=True), _PACKED, strict=True)], schema=_PACKED
            )


class Bucket:
    """The strings of one bucket and what is needed to count their windows."""

    def __init__(self, window: int):
        self.window = window
        self.buffers: list[bytes] = []
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, packed: bytes, keys: bytes, starts: bytes, many: bytes) -> None:
        buffer = packed + b"\n"
        raw = np.frombuffer(buffer, np.uint8)
        blank, line = np.flatnonzero((raw == 0x20) | (raw == 0x0A)), np.flatnonzero(raw == 0x0A)
        end = blank
        begin = np.concatenate([[0], blank[:-1] + 1])
        string = np.searchsorted(line, end, "left")
        at = np.flatnonzero(string[: len(string) - self.window + 1] == string[self.window - 1 :])
        a, z = begin[at], end[at + self.window - 1]
        first = np.searchsorted(string, np.arange(len(line)))
        owner = string[at]
        start = np.frombuffer(starts, np.int32)[owner] + (at - first[owner])
        self.buffers.append(buffer)
        number = np.full(len(at), len(self.buffers) - 1, np.int32)
        multi = np.frombuffer(many, np.uint8)[owner]
        self.parts.append((span_hashes(raw, a, z), number, a, z, np.frombuffer(keys, np.int64)[owner], start, multi))

    def spans(self) -> np.ndarray:
        """Rows of key, first word and end of the words in windows that occur more than once."""
        h, number, a, z, key, start, multi = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(h, kind="stable")
        group = np.concatenate([[0], np.cumsum(h[order][1:] != h[order][:-1])])
        size = np.bincount(group)
        inside = np.flatnonzero((size[group][1:] > 1) & (group[1:] == group[:-1])) + 1
        text = lambda k: self.buffers[number[k]][a[k] : z[k]]
        differ = [i for i in inside.tolist() if text(order[i]) != text(order[i - 1])]
        for g in {int(group[i]) for i in differ}:  # equal hash, other words: told apart by their bytes
            members = np.flatnonzero(group == g)
            names = {}
            group[members] = [len(size) + names.setdefault(text(order[m]), len(names)) for m in members.tolist()]
            size = np.append(size, [0] * len(names))
        weight = np.bincount(group, 1 + multi[order], minlength=len(size))
        again = np.zeros(len(h), bool)
        again[order] = weight[group] > 1
        again &= multi == 0  # the spans of the others are settled
        key, start = key[again], start[again]
        if not len(key):
            return np.zeros((0, 3), np.int64)
        by = np.lexsort((start, key))
        key, start = key[by], start[by]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] > start[:-1] + self.window)])
        last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(key) - 1]])
        return np.stack([key[new], start[new], start[last] + self.window], axis=1)


def _count(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    def out(s: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(s[:, 0]), *(pa.array(s[:, k].astype(np.int32)) for k in (1, 2))], ["key", "start", "stop"])

    now, bucket = None, Bucket(window)
    for batch in batches:
        for row in batch.to_pylist():
            if row["packed"] is None:
                columns = (np.frombuffer(row["keys"], np.int64), *(np.frombuffer(row[c], np.int32) for c in ("starts", "ends")))
                yield out(np.stack(columns, axis=1))
                continue
            if row["bucket"] != now and bucket.parts:
                yield out(bucket.spans())
                bucket = Bucket(window)
            now = row["bucket"]
            bucket.add(zstandard.decompress(row["packed"]), row["keys"], row["starts"], row["many"])
    if bucket.parts:
        yield out(bucket.spans())


def _key():
    return F.xxhash64(F.col("doc_id").cast("string"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``key`` of the document and the ``spans`` of its words that lie in a window which occurs again."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size * 3.2 / TASK_BYTES))
    buckets = tasks * BUCKETS_PER_TASK
    hot = hot_cells(docs, buckets, window, run)
    packed = docs.select(_key().alias("key"), bytes_of()).mapInArrow(lambda b: _pack(b, buckets, window, run, hot), PACKED)
    spans = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _count(b, window), SPANS)
    # A document has no more spans than words.
    return spans.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def without_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``docs`` with ``kept``, its other words joined by one blank, ``n_words`` and ``n_removed``."""
    spans = repeated_spans(docs, window, run)
    joined = docs.select(whole_row(docs), _key().alias("key"), bytes_of()).join(spans, "key", "left").select("_row", "text", "spans")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            kept, n_words, n_removed = [], [], []
            for text, own in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                left = np.ones(len(words), bool)
                for span in own or ():
                    left[span["start"] : span["stop"]] = False
                n_words.append(len(words))
                n_removed.append(len(words) - int(left.sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(left).tolist()] if n_removed[-1] else words).decode())
            arrays = [batch.column("_row"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["_row", *ADDED])

    zero = F.lit(0).cast("long")
    shape = joined.select("_row", *(c.alias(n) for c, n in zip((F.lit(""), zero, zero), ADDED, strict=True))).schema
    return joined.mapInArrow(cut, shape).select(*unpacked([c for c in docs.columns if c not in ADDED]), *ADDED)
