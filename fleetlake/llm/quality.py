"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Tokens are runs of word bytes, of symbols, or of punctuation; words are lower-cased, and a word that begins
with two capitals gives a further feature.  Features are the hashes of tokens and of token pairs, and skip
pairs of equal tokens (a token that repeats the one ``k`` before).  A document's value of a feature is its
share of the document's tokens, so length alone says nothing.

At most ``SAMPLE`` labelled rows are used, drawn by a hash of ``doc_id``; the same document is drawn
whatever else is there.  They are dealt to ``SHARDS`` tasks.  In each round every shard runs
follow-the-regularised-leader from the common weights, and the results are averaged.  Scores are sparse
dot products over whole texts.

Null texts count as empty; an empty text's score is that of the bias.  A ``doc_id`` with several labels
has the lowest; null labels are ignored.  Without any label all scores are one half.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import Tokens, bounded, bytes_of, mixed, staged, texts, unpacked, whole_row

SAMPLE = 20_000
SHARDS = 8
ROUNDS = 6
BITS = 18
#: Weights that are averaged together: tasks average the shards part by part, and the driver gets the mean alone.
PART = 1 << 12
THRESHOLD = 0.3
#: Follow-the-regularised-leader: step size, its smoothing, and the penalties on weights.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-5, 1e-5
#: Documents of one update, scale of the shares, and how far back a repeated token is looked for.
MINI_BATCH, SCALE, LAGS = 32, 20.0, 8

_KIND = np.ones(256, np.uint8)
_KIND[:0x21] = 0
_KIND[list(b"#*$%&|<>~^=+@\\_`{}[]/")] = 2
_KIND[list(b".,;:!?'\"()-")] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PAIR = np.uint64(0x9FB21C651E98DF25)


def features(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number and bucket of every feature found, and the tokens of each document."""
    t = Tokens(docs, _KIND)
    h, shift = t.hashes(_LOWER[t.raw]), np.uint64(64 - BITS)
    counts = np.bincount(t.doc, minlength=len(docs))
    capital = (t.raw >= 65) & (t.raw <= 90)
    loud = (t.end - t.start > 1) & capital[t.start] & capital[np.minimum(t.start + 1, len(t.raw) - 1)]
    with np.errstate(over="ignore"):
        found = [(t.doc, h >> shift), (t.doc[loud], np.full(loud.sum(), 1, np.uint64))]
        if len(h) > 1:
            inside = t.doc[1:] == t.doc[:-1]
            found.append((t.doc[1:][inside], mixed(h[:-1] * _PAIR + h[1:])[inside] >> shift))
    for lag in range(1, min(LAGS, len(h) - 1) + 1):
        again = (h[lag:] == h[:-lag]) & (t.doc[lag:] == t.doc[:-lag])
        found.append((t.doc[lag:][again], np.full(again.sum(), 1 + lag, np.uint64)))
    return np.concatenate([d for d, _ in found]), np.concatenate([b for _, b in found]).astype(np.int64), counts


def margins(docs: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Log-odds of each document; the last weight is the bias."""
    doc, bucket, counts = features(docs)
    dots = np.bincount(doc, weights[bucket], minlength=len(docs))
    return weights[-1] + SCALE * dots / np.maximum(counts, 1)


class Leader:
    """Per-coordinate follow-the-regularised-leader."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray):
        self.w, self.n = weights.astype(np.float64), squares.astype(np.float64)
        self.z = -self.w * self._rate() - np.sign(self.w) * L1

    def _rate(self) -> np.ndarray:
        return (BETA + np.sqrt(self.n)) / ALPHA + L2

    def update(self, docs: list[bytes], labels: np.ndarray) -> None:
        doc, bucket, counts = features(docs)
        value = SCALE / np.maximum(counts, 1)
        p = 1 / (1 + np.exp(-np.clip(self.w[-1] + np.bincount(doc, self.w[bucket], minlength=len(docs)) * value, -30, 30)))
        off = (p - labels) / len(docs)
        g = np.append(np.bincount(bucket, (off * value)[doc], minlength=len(self.w) - 1), off.sum())
        at = np.flatnonzero(g)
        g = g[at]
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * self.w[at]
        self.n[at] += g * g
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        self.w[at] = np.where(np.abs(self.z[at]) <= L1, 0, -(self.z[at] - np.sign(self.z[at]) * L1) / rate)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weights, bias last."""
    spark = docs.sparkSession
    marked = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("label"))
    drawn = marked.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("doc_id", bytes_of(), "label")  # ``sample`` rows at most
    # A row's shard and place go by the row alone, so that the model doesn't depend on how rows lie in files.
    key = F.xxhash64("doc_id", "text")
    rows = staged(rows.withColumns({"shard": F.pmod(key, F.lit(SHARDS)).cast("int"), "key": key}), "quality-sample")
    rows = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "key", "doc_id", "text")
    weights, squares = np.zeros((1 << BITS) + 1, np.float32), np.zeros((1 << BITS) + 1, np.float32)
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((weights, squares))

        def fit(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            for shard, parts in groupby(_mini_batches(batches), key=lambda m: m[0]):
                leader, seen = Leader(*state.value), 0
                for _, some, labels_ in parts:
                    leader.update(some, np.array(labels_, float))
                    seen += len(some)
                w, n = leader.w.astype(np.float32), leader.n.astype(np.float32)
                at = range(0, len(w), PART)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": list(range(len(at))),
                        "shard": [shard] * len(at),
                        "seen": [seen] * len(at),
                        "w": [w[k : k + PART].tobytes() for k in at],
                        "n": [n[k : k + PART].tobytes() for k in at],
                    },
                    schema=_SHARD,
                )

        fitted = rows.mapInArrow(fit, "part int, shard int, seen long, w binary, n binary")
        ordered = fitted.repartition(SHARDS, "part").sortWithinPartitions("part", "shard")
        parts = ordered.mapInArrow(_averaged, "part int, w binary, n binary").collect()  # one model, however many shards
        state.destroy()
        if not parts:
            break
        parts.sort(key=lambda r: r.part)
        weights, squares = (np.concatenate([np.frombuffer(r[c], np.float32) for r in parts]) for c in ("w", "n"))
    return weights


_SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("seen", pa.int64()), ("w", pa.binary()), ("n", pa.binary())])
_AVERAGE = pa.schema([("part", pa.int32()), ("w", pa.binary()), ("n", pa.binary())])


def _averaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of the shards for each part of the model, by the documents that each has seen; rows are in order of part and shard."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for part, of in groupby(rows, key=lambda r: r["part"]):
        shards = list(of)
        share = np.array([r["seen"] for r in shards]) / sum(r["seen"] for r in shards)
        mean = lambda c: sum(s * np.frombuffer(r[c], np.float32) for s, r in zip(share, shards, strict=True)).astype(np.float32)  # noqa: B023, E731
        yield pa.RecordBatch.from_pydict({"part": [part], "w": [mean("w").tobytes()], "n": [mean("n").tobytes()]}, schema=_AVERAGE)


def _mini_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """Shard, texts and labels of each mini-batch, whatever batches the rows come in."""
    shard, some, labels = -1, [], []
    for batch in batches:
        for number, text, label in zip(batch.column("shard").to_pylist(), texts(batch), batch.column("label").to_pylist(), strict=True):
            if some and (number != shard or len(some) == MINI_BATCH):
                yield shard, some, labels
                some, labels = [], []
            shard = number
            some.append(text)
            labels.append(label)
    if some:
        yield shard, some, labels


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``row``, a struct of the columns of ``docs``, and ``score``, the probability of label 1."""
    given = docs.sparkSession.sparkContext.broadcast(weights)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            found = 1 / (1 + np.exp(-np.clip(margins(texts(batch), given.value), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.float64())], ["row", "score"])

    packed = docs.select(whole_row(docs, "row"), bytes_of())
    return packed.mapInArrow(each, packed.select("row", F.lit(0.0).alias("score")).schema)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""
    return score(docs, train(docs, labels)).where(F.col("score") >= threshold).select(*unpacked(docs.columns, "row"))
