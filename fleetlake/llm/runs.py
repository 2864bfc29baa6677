"""Periodic runs of words, found in a grammar of the texts.

A task makes one grammar for a batch of texts by Re-Pair in rounds: each round counts all adjacent pairs
and replaces those that are more frequent than the pairs they overlap.  When no pair recurs, neighbours
are paired until each text is one symbol.  A run lies whole in the lowest symbol whose expansion holds
it, and crosses the boundary between that symbol's two parts.  So the runs that cross a boundary are
computed once per nonterminal, from common extensions left and right of the boundary at each period,
and then translated to every place where the nonterminal is derived.  What a place shows only in part
is inside the whole run of the same period that a higher symbol shows: intervals of one text and period
are merged to the maximal ones.

Words are compared as bytes.  Extensions are compared by two polynomial hashes over prime fields, which
err with odds below the number of comparisons times the text's length over 2**61.

Null and empty texts have no words and no runs.  Rows are looked at one by one: repeated rows, null
ids and ties change nothing.  Memory in a task is about 200 bytes for each word of the larger of a batch
and one text, so a very long text needs room in proportion.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import bounded, bytes_of, texts, unpacked, whole_row

LEAST_LENGTH = 12
_AT_ONCE = 1 << 20
_BATCH_BYTES = 1 << 20

_rng = np.random.default_rng(20250311)
_PRIMES = np.array([2147483629, 2147483587], np.int64)
_BASES = _rng.integers(1 << 20, 1 << 30, 2)
_MIX = _rng.integers(1, 1 << 62, 3).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class _Extensions:
    """Longest common extensions of positions in one sequence of numbers."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.powers = [], []
        for p, base in zip(_PRIMES, _BASES, strict=True):
            powers = np.ones(len(ids) + 1, np.int64)
            done = 1
            while done < len(powers):
                more = min(done, len(powers) - done)
                powers[done : done + more] = powers[:more] * (powers[done - 1] * base % p) % p
                done += more
            sums = np.zeros(len(ids) + 1, np.int64)
            np.cumsum((ids + 1) * powers[:-1] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(powers)

    def _equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` numbers from ``a`` equal those from ``b``, where ``a <= b``."""
        same = np.ones(len(a), bool)
        for p, sums, powers in zip(_PRIMES, self.sums, self.powers, strict=True):
            same &= (sums[a + n] - sums[a]) % p * powers[b - a] % p == (sums[b + n] - sums[b]) % p
        return same

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
        """How far, up to ``limit``, equality goes on from ``a`` and ``b``: rightwards, or leftwards if ``way`` is -1."""
        low, high = np.zeros(len(a), np.int64), np.maximum(limit, 0)
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            shift = 0 if way > 0 else middle
            same = self._equal(a - shift, b - shift, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low


def _frequent(symbol: np.ndarray, codes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Places of pairs that recur and are more frequent than those they overlap; of ``aaa`` every second."""
    again = np.bincount(symbol)[symbol] > 1  # a pair recurs only if both its symbols do
    maybe = np.flatnonzero(allowed & again[:-1] & again[1:])
    distinct, number, times = np.unique(codes[maybe], return_inverse=True, return_counts=True)
    rank = np.full(len(codes), -1)
    rank[maybe] = np.where(times[number] > 1, times[number] * len(distinct) + number, -1)
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
    group = rank[first]
    edge = np.array([-1])
    top = (group > np.concatenate([edge, group[:-1]])) & (group > np.concatenate([group[1:], edge]))
    sizes = np.diff(first, append=len(rank))
    offset = np.arange(len(rank)) - np.repeat(first, sizes)
    return np.flatnonzero(np.repeat(top, sizes) & (offset % 2 == 0))


class Grammar:
    """A straight-line grammar of several sequences, and the runs in them."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        """``ids``: the sequences one after the other; ``sizes``: the length of each."""
        self.ids, self.sizes, self.terminals = ids, sizes, int(ids.max(initial=-1)) + 1
        #: Of each nonterminal: its parts, a place where it stands, the lengths of both parts.
        self.left, self.right, self.at, self.n_left, self.n_right = ([] for _ in range(5))
        self.levels: list[int] = [self.terminals]
        self._build()

    def _build(self) -> None:
        symbol, start, doc = self.ids, np.arange(len(self.ids)), np.repeat(np.arange(len(self.sizes)), self.sizes)
        recurring, upper = True, self.terminals
        while len(symbol) > 1:
            allowed = doc[1:] == doc[:-1]
            if not allowed.any():
                break
            codes = symbol[:-1] << 32 | symbol[1:]
            chosen = _frequent(symbol, codes, allowed) if recurring else np.zeros(0, np.int64)
            if not len(chosen):
                recurring = False
                first = np.concatenate([[True], ~allowed])
                offset = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
                chosen = np.flatnonzero(allowed & (offset[:-1] % 2 == 0))
            ends = np.append(start[1:], len(self.ids))
            _, example, number = np.unique(codes[chosen], return_index=True, return_inverse=True)
            example = chosen[example]
            self.left.append(symbol[example])
            self.right.append(symbol[example + 1])
            self.at.append(start[example])
            self.n_left.append(ends[example] - start[example])
            self.n_right.append(ends[example + 1] - ends[example])
            symbol = symbol.copy()
            symbol[chosen] = upper + number
            upper += len(example)
            self.levels.append(upper)
            kept = np.ones(len(symbol), bool)
            kept[chosen + 1] = False
            symbol, start, doc = symbol[kept], start[kept], doc[kept]
        self.roots = symbol, start

    def runs(self, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sequence number, first position in ``ids``, end and smallest period of every maximal run.

        ``least`` is 9 or more, so that a run has five equal neighbours at its period.
        """
        if least < 9:
            raise ValueError("runs of fewer than nine words are not looked for")
        nothing = (np.zeros(0, np.int64),) * 4
        if not self.left:
            return nothing
        left, right, at, n_left, n_right = map(np.concatenate, (self.left, self.right, self.at, self.n_left, self.n_right))
        owner, start, end, period = self._crossing(at, n_left, n_right, least)
        if not len(owner):
            return nothing
        start, end = start - at[owner], end - at[owner]
        bears = np.zeros(self.levels[-1], bool)
        bears[self.terminals + owner] = True
        for low, high in zip(self.levels[:-1], self.levels[1:], strict=True):
            parts = slice(low - self.terminals, high - self.terminals)
            bears[low:high] |= bears[left[parts]] | bears[right[parts]]
        begin = np.searchsorted(owner, np.arange(len(at) + 1))
        found: list[tuple[np.ndarray, ...]] = []
        symbol, place = self.roots
        while len(symbol):
            bearing = bears[symbol]
            symbol, place = symbol[bearing] - self.terminals, place[bearing]
            n = begin[symbol + 1] - begin[symbol]
            which = np.repeat(begin[symbol], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            base = np.repeat(place, n)
            found.append((base + start[which], base + end[which], period[which]))
            symbol, place = np.concatenate([left[symbol], right[symbol]]), np.concatenate([place, place + n_left[symbol]])
        return self._maximal(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def _crossing(self, at: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
        """Runs in each nonterminal's expansion that cross its boundary, in order of the nonterminals."""
        ids = self.ids.astype(np.uint64)
        three = np.zeros(len(ids) + 6, np.uint32)  # place j + 3 holds a hash of the three numbers from j on
        with np.errstate(over="ignore"):
            mixed = ids[:-2] * _MIX[0] + ids[1:-1] * _MIX[1] + ids[2:] * _MIX[2]
            three[3 : 3 + len(mixed)] = (mixed * _MIX[0]) >> np.uint64(32)
        nodes = np.flatnonzero(n_left + n_right >= least)
        boundary, end, half = at + n_left, at + n_left + n_right, (n_left + n_right) // 2
        near: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for way, reach in ((1, np.minimum(n_right, half)), (-1, np.minimum(n_left, half))):
            totals = np.cumsum(reach[nodes])
            first = 0
            while first < len(nodes):
                done = totals[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(totals, done + _AT_ONCE, "right")))
                some = nodes[first:stop]
                n, b = reach[some], boundary[some]
                shifted = np.repeat(b + way - way * (np.cumsum(n) - n), n) + way * np.arange(n.sum())
                # Five equal neighbours at its period: three of them on one side of the boundary.
                hit = np.flatnonzero((three[shifted + 3] == np.repeat(three[b + 3], n)) | (three[shifted] == np.repeat(three[b], n)))
                if len(hit):
                    whose = np.repeat(some, n)[hit]
                    a, c = np.minimum(shifted[hit], boundary[whose]), np.maximum(shifted[hit], boundary[whose])
                    near.append((whose, a, c))
                first = stop
        if not near:
            return (np.zeros(0, np.int64),) * 4
        owner, a, c = (np.concatenate(x) for x in zip(*near, strict=True))
        extensions, period = _Extensions(self.ids), c - a
        before = extensions.common(a, c, a - at[owner], -1)
        after = extensions.common(a, c, end[owner] - c, 1)
        good = before + after >= np.maximum(period, least - period)
        owner, start, stop, period = owner[good], (a - before)[good], (c + after)[good], period[good]
        order = np.lexsort((period, stop, start, owner))
        owner, start, stop, period = (x[order] for x in (owner, start, stop, period))
        new = np.ones(len(owner), bool)  # of one interval the smallest period
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
        return owner[new], start[new], stop[new], period[new]

    def _maximal(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
        """Intervals that lie in no other of the same sequence and period, in order of sequence, start and period."""
        doc = np.searchsorted(np.cumsum(self.sizes), start, "right")
        order = np.lexsort((-end, start, period, doc))
        doc, start, end, period = (x[order] for x in (doc, start, end, period))
        group = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (period[1:] != period[:-1])]))
        reach = np.maximum.accumulate(group * (len(self.ids) + 1) + end)
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (reach[1:] > reach[:-1])])
        doc, start, end, period = doc[new], start[new], end[new], period[new]
        order = np.lexsort((period, start, doc))
        return doc[order], start[order], end[order], period[order]


def runs_of(docs: list[list], least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Start, length and smallest period of every run in each sequence, by start, then period."""
    number: defaultdict = defaultdict(count().__next__)
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.fromiter((number[w] for d in docs for w in d), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    doc, start, end, period = Grammar(ids, sizes).runs(least)
    for d, s, n, p in zip(doc.tolist(), (start - first[doc]).tolist(), (end - start).tolist(), period.tolist(), strict=True):
        out[d].append((s, n, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: what any run holds after its first period goes."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return list(compress(words, kept.tolist()))


_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``runs`` (by start, then period) and ``collapsed``.

    A run is a stretch of words with smallest period q and at least ``least`` and 2 q words that no neighbour
    extends.  ``collapsed`` has the words that no run repeats, joined by one blank; it is never null.
    Other columns pass through; an input column of one of these three names is replaced.
    """
    given = docs.select(whole_row(docs), bytes_of())
    added = {"n_words": "long", "runs": _RUNS, "collapsed": "string"}
    schema = docs.select(whole_row(docs)).withColumns({c: F.lit(None).cast(t) for c, t in added.items()}).schema

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, limit=_BATCH_BYTES):
            words = [t.split() for t in texts(batch)]
            found = runs_of(words, least)
            left = [b" ".join(collapsed(w, r)) for w, r in zip(words, found, strict=True)]
            starts = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            flat = np.array([x for r in found for x in r], np.int64).reshape(-1, 3)
            runs = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array([len(w) for w in words], pa.int64()), runs.cast(_RUNS_ARROW), pa.array(left, pa.binary()).cast(pa.string())],
                ["_row", *added],
            )

    kept = [c for c in docs.columns if c not in added]
    return given.mapInArrow(each, schema).select(*unpacked(kept), *added)
