"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased (A-Z) runs of non-blanks and one end of text.  Words are counted over all training
texts.  The most frequent words, up to ``HEAD``, fall into classes of about equal mass by frequency; all
others are the tail class.  P(word | history) = P(class | history) * P(word | class).  The class softmax has
hashed features of the history: the last word, the last two, the word before the last, and the words two
and three back.  Within a class the word itself is the only feature, whose maximum-entropy weight is its
log count; tail words and unknown ones are smoothed by one half.

Training runs in rounds over disjoint shares of all training texts.  Each task takes gradient steps from
the common weights; the results are summed per block of weights in Spark, so the driver gets one model
a round.  Scoring is done in sparse numpy batches.  Counts of tail words reach their documents by a join,
so nothing that grows with the vocabulary is held by a task or the driver.

Null texts count as empty: they have the end token alone.  Rows that repeat a ``doc_id`` are scored one by
one.  A null ``doc_id`` is held out like fold 1.  With nothing to learn from, all words are unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import BLANKS, Tokens, bounded, byte_classes, bytes_of, mixed, staged, texts

#: Words in classes by frequency at most, classes in all (the last is the tail's), and rows of weights.
HEAD, CLASSES, BITS = 65_536, 64, 14
ROUNDS, STEP, MINI_BATCH = 4, 0.25, 8_192
COUNT_BYTES, BATCH_BYTES, BLOCKS = 12 << 20, 1 << 20, 16
FEATURES = 4
END = b"\n"  # no word has a blank

_WORDS = byte_classes(BLANKS)
#: Head words are found by the upper bits of their hashes: what those are shifted by, and masks of a word's first bytes.
_SLOT = np.uint64(64 - 18)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SALT = np.array([0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F, 0xD1B54A32D192ED03], np.uint64)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(True))


def _tokens(docs: list[bytes]) -> Tokens:
    return Tokens([d.lower() for d in docs], _WORDS)


def _binary(lengths: np.ndarray, data: bytes | np.ndarray) -> pa.Array:
    """Values of these lengths that stand one after another in ``data``."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``c``, over all texts and their ends."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, limit=COUNT_BYTES):
            words = []
            for some in bounded([batch], limit=BATCH_BYTES):
                tokens = _tokens(texts(some))
                words.append(_binary(tokens.end - tokens.start, tokens.buffer.translate(None, BLANKS)))
            found = pc.value_counts(pa.chunked_array([*words, pa.array([END] * batch.num_rows, pa.binary())]))
            yield pa.RecordBatch.from_arrays(found.flatten(), ["word", "n"])

    return docs.select(bytes_of()).mapInArrow(each, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _most_frequent(counts: DataFrame) -> DataFrame:
    """The words in the upper classes of a fine histogram of counts, as many classes as have ``HEAD`` words at most."""
    step = F.floor(F.log2("c") * 16).cast("int")
    least = math.inf
    left = HEAD
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):  # 16 rows for each doubling
        left -= row["count"]
        if left < 0:
            break
        least = row.step
    return counts.where(step >= least) if least < math.inf else counts.where("false")


@dataclass
class Vocabulary:
    """Head words in order of frequency: number, class, and logs (base 10) of both probabilities."""

    number: dict[bytes, int]
    classes: np.ndarray  # of each head word; one more at the end for the tail
    within: np.ndarray  # log10 P(word | class)
    base: np.ndarray  # log10 of the smoothed share
    bias: np.ndarray  # natural log of each class's mass
    total: int
    distinct: int
    tail_mass: float  # of (c + 0.5) over tail words and the unknown one

    @property
    def scale(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @cached_property
    def heads(self) -> Heads:
        return Heads(self.number)

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        top = _most_frequent(counts).collect()  # ``HEAD`` rows at most
        top.sort(key=lambda r: (-r.c, bytes(r.word)))
        c = np.array([r.c for r in top], np.float64)
        share = np.cumsum(c**0.75)
        classes = np.minimum((share / max(share[-1], 1) * (CLASSES - 1)).astype(int), CLASSES - 2) if len(c) else np.zeros(0, int)
        mass = np.bincount(classes, c, minlength=CLASSES)
        tail = total - c.sum() + 0.5 * (distinct - len(c) + 1)
        with np.errstate(divide="ignore"):
            within = np.log10(c / mass[classes]) if len(c) else c
        mass[-1] = tail
        bias = np.log(np.maximum(mass, 0.5) / np.maximum(mass, 0.5).sum())
        scale = total + 0.5 * (distinct + 1)
        return cls(
            {bytes(r.word): k for k, r in enumerate(top)}, np.append(classes, CLASSES - 1), within, np.log10((c + 0.5) / scale), bias, total, distinct, tail
        )


class Heads:
    """Finds head words by hash; what is found is compared byte by byte."""

    def __init__(self, number: dict[bytes, int]):
        self.number = number
        words = [w for w in number if w != END]
        tokens = Tokens(words, _WORDS)
        hashes = tokens.hashes()
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], np.uint64(0))
        self.first = np.searchsorted(hashes[order] >> _SLOT, np.arange((1 << 64 - int(_SLOT)) + 1, dtype=np.uint64))
        self.words = [words[k] for k in order] + [b""]
        self.numbers = np.fromiter((number[w] for w in self.words[:-1]), np.int64, len(words))
        self.numbers = np.append(self.numbers, -1)
        self.length, self.head, self.rear = (np.append(x[order], x.dtype.type(0)) for x in self._seen(tokens, slice(None)))

    @staticmethod
    def _seen(tokens: Tokens, some: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The length of some tokens, their first eight bytes, and their last eight if they are longer."""
        start, end = tokens.start[some], tokens.end[some]
        eight = np.ndarray(len(tokens.buffer), "<u8", tokens.buffer + b"\0" * 8, strides=(1,))
        length = end - start
        head = eight[start] & _FIRST[np.minimum(length, 8)]
        rear, more = np.zeros(len(start), np.uint64), np.flatnonzero(length > 8)
        rear[more] = eight[end[more] - 8]
        return length, head, rear

    def find(self, tokens: Tokens, h: np.ndarray) -> np.ndarray:
        """The number of each token's word or -1.  ``h``: the tokens' hashes."""
        slot = (h >> _SLOT).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        same = (self.hashes[at] == h) & (at < stop)
        left = np.flatnonzero(~same & (stop - at > 1))
        while len(left):  # few words share a slot
            at[left] += 1
            same[left] = self.hashes[at[left]] == h[left]
            left = left[~same[left] & (stop[left] - at[left] > 1)]
        found = np.flatnonzero(same)
        at = at[found]
        length, head, rear = self._seen(tokens, found)
        equal = (self.length[at] == length) & (self.head[at] == head) & (self.rear[at] == rear)
        for k in np.flatnonzero(equal & (length > 16)):
            t = found[k]
            equal[k] = self.words[at[k]] == tokens.buffer[tokens.start[t] : tokens.end[t]]
        number = np.full(len(h), -1)
        number[found] = self.numbers[at]
        for t in found[~equal]:  # another word with the same hash
            number[t] = self.number.get(tokens.buffer[tokens.start[t] : tokens.end[t]], -1)
        return number


@dataclass
class Histories:
    """Every token of some texts, ends included: its document, its head number or -1, and its buckets."""

    doc: np.ndarray
    number: np.ndarray
    buckets: np.ndarray
    raw: np.ndarray
    start: np.ndarray  # of each token in ``raw``; an end is the line feed after its text
    end: np.ndarray

    def tails(self) -> tuple[np.ndarray, pa.Array]:
        """Documents and words of the tokens that are no head words."""
        tail = np.flatnonzero(self.number < 0)
        length = self.end[tail] - self.start[tail]
        skipped = self.start[tail] - (np.cumsum(length) - length)
        return self.doc[tail], _binary(length, self.raw[np.repeat(skipped, length) + np.arange(length.sum())])


def histories(docs: list[bytes], vocabulary: Vocabulary) -> Histories:
    tokens = _tokens(docs)
    n = np.bincount(tokens.doc, minlength=len(docs)) + 1
    last = np.cumsum(n) - 1
    doc = np.repeat(np.arange(len(docs)), n)
    is_word = np.ones(len(doc), bool)
    is_word[last] = False
    number = np.full(len(doc), vocabulary.number.get(END, -1))
    h, start, end = np.zeros(len(doc), np.uint64), np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    own = tokens.hashes()
    h[is_word], start[is_word], end[is_word] = own, tokens.start, tokens.end
    start[last], end[last] = tokens.first[1:] - 1, tokens.first[1:]
    number[is_word] = vocabulary.heads.find(tokens, own)
    within = np.arange(len(number)) - np.repeat(last + 1 - n, n)
    back = []
    for k in (1, 2, 3):
        b = np.full(len(h), np.uint64(k))
        b[k:] = np.where(within[k:] >= k, h[:-k], np.uint64(k)) if len(h) > k else b[k:]
        back.append(b)
    with np.errstate(over="ignore"):
        one, two, three = back
        mixes = (one * _SALT[0], one * _SALT[1] + mixed(two), two * _SALT[2] + np.uint64(1), mixed(two) * _SALT[3] + three)
        buckets = np.stack([mixed(m) >> np.uint64(64 - BITS) for m in mixes]).astype(np.int64)
    return Histories(doc, number, buckets, tokens.raw, start, end)


#: Tokens whose class scores are worked out at once, so that they stay in a processor's cache.
_CACHED = 1024
#: Scores of which no exponential, nor the sum of a class's, leaves the range of 32-bit floats.
_SAFE = 80
#: Buckets of so many rows at most are added up together, the others one by one.
_ROWS_EACH = 24


def _exponentials(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray, classes: np.ndarray | None, out: np.ndarray) -> np.ndarray | None:
    """Fills ``out`` with class probabilities up to a factor; returns the logs that ``classes`` have there."""
    np.take(weights, buckets[0], axis=0, out=out, mode="clip")
    out += bias
    more = np.empty_like(out)
    for b in buckets[1:]:
        out += np.take(weights, b, axis=0, out=more, mode="clip")
    if max(out.max(), -out.min()) > _SAFE:
        out -= out.max(axis=1, keepdims=True)
    own = None if classes is None else out[np.arange(len(out)), classes]
    np.exp(out, out=out)
    return own


def _softmax(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Class probabilities."""
    whole = np.empty((buckets.shape[1], len(bias)), np.float32)
    ones = np.ones(len(bias), np.float32)
    for at in range(0, len(whole), _CACHED):
        out = whole[at : at + _CACHED]
        _exponentials(weights, bias, buckets[:, at : at + _CACHED], None, out)
        out *= (1 / (out @ ones))[:, None]
    return whole


def _log_probability(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each token's own class."""
    found = np.empty(len(classes))
    ones = np.ones(len(bias), np.float32)
    for at in range(0, len(classes), _CACHED):
        some = slice(at, at + _CACHED)
        out = np.empty((len(classes[some]), len(bias)), np.float32)
        own = _exponentials(weights, bias, buckets[:, some], classes[some], out)
        found[some] = own - np.log(out @ ones)
    return found


def _summed(buckets: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets and the sums of their rows of ``off``."""
    order = np.argsort(buckets.astype(np.uint16), kind="stable")  # a bucket has ``BITS`` bits; so short, numpy sorts by radix
    there = buckets[order]
    begin = np.flatnonzero(np.concatenate([[True], there[1:] != there[:-1]]))
    counts = np.diff(begin, append=len(order))
    capped = np.minimum(counts, _ROWS_EACH + 1).astype(np.int8)
    by_count = np.argsort(-capped, kind="stable")  # the buckets of most rows first
    begin, counts, capped = begin[by_count], counts[by_count], capped[by_count]
    g = np.take(off, order[begin], axis=0, mode="clip")
    hot = np.count_nonzero(capped > _ROWS_EACH)
    ones = np.ones(counts.max(), np.float32)
    for j in range(hot):
        np.matmul(ones[: counts[j]], np.take(off, order[begin[j] : begin[j] + counts[j]], axis=0, mode="clip"), out=g[j])
    for k in range(1, _ROWS_EACH):  # the next row of every other bucket that has one
        some = slice(hot, np.count_nonzero(capped > k))
        if some.start == some.stop:
            break
        g[some] += np.take(off, order[begin[some] + k], axis=0, mode="clip")
    return there[begin], g


class Trainer:
    """Gradient steps on rows of weights, each scaled by the row's past gradients."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray, bias: np.ndarray):
        self.weights, self.squares, self.bias, self.seen = weights.copy(), squares.copy(), bias, 0

    def _step(self, rows: np.ndarray, g: np.ndarray) -> None:
        squares = self.squares[rows] + np.einsum("ij,ij->i", g, g) / CLASSES
        self.squares[rows] = squares
        g *= (-STEP / np.sqrt(squares + 1e-6))[:, None]
        g += np.take(self.weights, rows, axis=0, mode="clip")
        self.weights[rows] = g

    def update(self, buckets: np.ndarray, classes: np.ndarray) -> None:
        off = _softmax(self.weights, self.bias, buckets)
        off[np.arange(len(classes)), classes] -= 1
        for b in buckets:
            rows, g = _summed(b, off)
            for at in range(0, len(rows), _CACHED):
                self._step(rows[at : at + _CACHED], g[at : at + _CACHED])
        self.seen += len(classes)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The weights of the class softmax after ``rounds`` rounds over disjoint shares of ``docs``."""
    spark = docs.sparkSession
    rows = 1 << BITS
    model = np.zeros((rows, CLASSES + 1), np.float32)  # the last column: squares of past gradients
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for r in range(rounds):
        state = spark.sparkContext.broadcast((model, vocabulary))

        def steps(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            given, v = state.value
            trainer = Trainer(given[:, :-1], given[:, -1], v.bias.astype(np.float32))
            for batch in bounded(batches, limit=BATCH_BYTES):
                found = histories(texts(batch), v)
                classes = v.classes[found.number]
                for at in range(0, len(classes), MINI_BATCH):
                    trainer.update(found.buckets[:, at : at + MINI_BATCH], classes[at : at + MINI_BATCH])
            if trainer.seen:
                out = np.concatenate([trainer.weights, trainer.squares[:, None]], axis=1) * np.float32(trainer.seen)
                parts = [p.astype(np.float32).tobytes() for p in np.split(out, BLOCKS)]
                yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "seen": [trainer.seen] * BLOCKS, "part": parts})

        def total(pdf: pd.DataFrame) -> pd.DataFrame:
            part = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in pdf["part"])
            return pd.DataFrame({"block": pdf["block"][:1], "seen": [pdf["seen"].sum()], "part": [part.tobytes()]})

        # As many tasks as there are cores, whatever the size of the corpus: each gives one model.
        taught = docs.where(share == r).select(bytes_of()).coalesce(spark.sparkContext.defaultParallelism)
        summed = taught.mapInArrow(steps, "block int, seen long, part binary").groupBy("block").applyInPandas(total, "block int, seen long, part binary")
        found = sorted(summed.collect(), key=lambda x: x.block)
        if found:
            model = np.concatenate([np.frombuffer(x.part, np.float64) / x.seen for x in found]).reshape(rows, CLASSES + 1).astype(np.float32)
        state.unpersist()
    return model[:, :-1]


HEAD_SCORES = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_base double, head_score double, tail array<binary>"
)


def score(docs: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, counts: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10) for every row."""
    state = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = state.value
        row, bias = TaskContext.get().partitionId() << 33, v.bias.astype(np.float32)
        within, base = np.append(v.within, 0), np.append(v.base, 0)
        for batch in bounded(batches, limit=BATCH_BYTES):
            found = histories(texts(batch), v)
            number = found.number
            gained = _log_probability(w, bias, found.buckets, v.classes[number]) / math.log(10) + within[number]
            sums = lambda x: np.bincount(found.doc, x, minlength=batch.num_rows)  # noqa: B023, E731
            of, words = found.tails()
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.bincount(found.doc, minlength=batch.num_rows)),
                    pa.array(sums(number >= 0).astype(np.int64)),
                    pa.array(sums(base[number])),
                    pa.array(sums(gained)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_head", "head_base", "head_score", "tail"],
            )
            row += batch.num_rows

    scored = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), bytes_of()).mapInArrow(each, HEAD_SCORES)
    scored = staged(scored, "lm-scores")  # the row numbers hold from here
    tail = scored.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    tail = tail.groupBy("row").agg(
        F.count_if(c > 0).alias("tail_known"),
        F.count("*").alias("n_tail"),
        F.sum(F.log10(c + 0.5)).alias("tail_log"),
    )
    tail_log, n_tail = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("n_tail", F.lit(0))
    return scored.drop("tail").join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("head_base") + tail_log - n_tail * math.log10(vocabulary.scale)).alias("base_score"),
        (F.col("head_score") + tail_log - n_tail * math.log10(vocabulary.tail_mass)).alias("score"),
    )


def language_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row from a model of those that are not held out, and ``train_tokens``."""
    docs = docs.select("doc_id", "text")
    taught = docs.where(~held_out())
    counts = staged(word_counts(taught), "lm-counts")
    vocabulary = Vocabulary.of(counts)
    weights = train(taught, vocabulary)
    return score(docs, vocabulary, weights, counts).withColumn("train_tokens", F.lit(vocabulary.total).cast("long"))
