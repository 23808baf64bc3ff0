"""What the operators share: tables in the shared folder, and word hashes of Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import shared_folder

#: Hashing takes some dozen times a piece's bytes, which each Python worker then holds; pieces of this size also stay in the processor's cache.
CHUNK_BYTES = 256 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters and digits; every byte of a character beyond ASCII counts as a letter.
WORDLIKE = np.zeros(256, dtype=bool)
WORDLIKE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


#: Spark's setting under which a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of the bytes from which a batch for Python is sent.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write df as a Parquet table into the shared folder and read it back: its lineage ends here, and lost executors cost nothing.

    What was shuffled for it goes when it is written. discard() deletes the table itself.
    batch_bytes: Python gets batches of about so many bytes, else those of the session's settings.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyframe-{uuid.uuid4().hex}/{name}"
    own = {_CLEANUP: "true"} | ({_BATCH: str(batch_bytes)} if batch_bytes else {})
    before = {key: spark.conf.get(key, "false") if key == _CLEANUP else spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that keep() returned, when all that is derived from them has been written; others are passed over."""
    for df in tables:
        if not getattr(df, "kept_at", None):
            continue
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def let(value: Column, use) -> Column:
    """use(value), with value computed once: an expression that is named twice, or inside a lambda, would be computed each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcasting if it has at most so many rows (df should be cheap to count); else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= CHUNK_BYTES + 1:
            _powers[kind] = have
    return have[:n]


class Texts:
    """Some rows of a text column as one byte array: row i is raw[starts[i]:starts[i + 1]] (null counts as empty)."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, first: int):
        self.raw, self.starts, self.first = raw, starts, first

    def __len__(self) -> int:
        return len(self.starts) - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of bytes for which inside holds, cut at the rows' borders."""
        if not len(self.raw):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        border = np.zeros(len(self.raw) + 1, dtype=bool)
        border[self.starts] = True
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        return np.flatnonzero(inside & (~before | border[:-1])), np.flatnonzero(inside & (~after | border[1:])) + 1

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        """Sums of all prefixes of the polynomial hash."""
        out = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(raw)), out=out[1:])
        return out

    def hashes(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each raw[begin:end], the same wherever the bytes stand."""
        sums = self.prefix(raw)
        return mix((sums[end] - sums[begin]) * _power("down", _INVERSE, len(raw) + 1)[begin] + (end - begin).astype(np.uint64))

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in lower case (A-Z), and where each row's words begin (with the end, last)."""
        raw = LOWER[self.raw]
        begin, end = self.runs(inside[self.raw])
        return self.hashes(raw, begin, end), np.searchsorted(begin, self.starts)


def texts(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in pieces of about so many bytes; a longer row is a piece of its own."""
    column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1)
        to = min(to, len(column))
        yield Texts(raw[starts[at] : starts[to]], starts[at : to + 1] - starts[at], at)
        at = to


def lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A list column: row i is values[starts[i]:starts[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(starts, type=pa.int32()), pa.array(values, type=kind))
