"""What several operators share: reading, staging in the shared folder, words and hashes of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.workspace import work_dir

#: Bytes of text that a task turns into arrays at once.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no earlier step."""
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct: whatever they are called, they meet no column of an operator."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def unpacked(columns: list[str], name: str = "_row", **changed: Column) -> list[Column]:
    """The columns of ``whole_row`` again, some of them changed."""
    return [changed.get(c, F.col(name)[c]).alias(c) for c in columns]


def bytes_of(column: str = "text"):
    """The column as UTF-8 bytes for Python; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias(column)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return batch.column(column).to_pylist()


def bounded(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` bytes of text, or of one row."""
    for batch in batches:
        ends, start = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values spread so that their upper bits depend on all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        both = [np.full(size, b, np.uint64) for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64))]
        with np.errstate(over="ignore"):
            for p in both:
                p[0] = 1
                np.cumprod(p, out=p)
        _powers = both[0], both[1]
    return _powers[0][:n], _powers[1][:n]


def range_sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each pair: equal ranges have equal hashes wherever they are."""
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values * up[:-1], out=sums[1:])
        return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_sums(_BYTE[raw], start, end)


class Tokens:
    """The tokens of several texts: which text each is of, where it is, and its hash."""

    def __init__(self, docs: list[bytes], kind: np.ndarray):
        """``kind``: for each byte value 0 if it separates tokens, else the class whose runs are tokens."""
        lengths = np.fromiter((len(d) for d in docs), np.int64, len(docs))
        self.buffer = b"\n".join(docs) + b"\n"
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        raw = np.frombuffer(self.buffer, np.uint8)
        classes = kind[raw]
        edge = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        is_token = classes[edge] != 0
        ends = np.concatenate([edge[1:], [len(raw)]])
        self.start, self.end = edge[is_token], ends[is_token]
        self.kind = classes[self.start]
        self.doc = np.searchsorted(self.first, self.start, "right") - 1
        self.raw = raw

    def hashes(self, raw: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each token's bytes."""
        return span_hashes(self.raw if raw is None else raw, self.start, self.end)


def byte_classes(separators: bytes) -> np.ndarray:
    kind = np.ones(256, np.uint8)
    kind[list(separators)] = 0
    return kind


#: The separators of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
BLANKS = b" \t\n\x0b\x0c\r"
NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Lower-cases A-Z and turns every separator of lower-cased words into a blank.
WORD_TABLE = bytes(
    0x20 if chr(b).lower().encode("latin-1")[0] in NOT_WORD and b < 0x80 else ord(chr(b).lower()) if b < 0x80 else b
    for b in range(256)
)
