"""Helpers shared by the operators: tables, written intermediates, hashing of text bytes.

Python operators work on Arrow batches. Inside a batch the bytes of many texts are handled
as one numpy array, cut into pieces of bounded size.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import clickmeter
from clickmeter.session import scratch_folder

ROWS_PER_BATCH = 512
PIECE_BYTES = 1 << 17  # arrays of 8 bytes for each stay in a core's cache


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, as a row may be a very long text; and this package for the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if not getattr(context, "_clickmeter_sent", False):
        root = Path(clickmeter.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="clickmeter-")).resolve() / "clickmeter.zip"
        with zipfile.ZipFile(archive, "w") as out:  # the driver serves it as long as it runs
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._clickmeter_sent = True
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives lost executors.

    Shuffle files of the write go when it ends, as nothing reads them again.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each text starts; a null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `size` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0xD6E8FEB86659FD93 | 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)


_POWERS = {BASE: np.ones(1, np.uint64), BASE_INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64; up to a few pieces long they are kept."""
    known = _POWERS[base]
    if len(known) < n:
        known = np.full(max(n, 2 * PIECE_BYTES), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if len(known) <= 8 * PIECE_BYTES:
            _POWERS[base] = known
    return known[:n]


class SpanHashes:
    """Hashes of any spans of a byte array, from one running polynomial sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(BASE, n), out=self.sums[1:])
        self.undo = powers(BASE_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.undo[starts] + (ends - starts).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """Of every span of `length` bytes, in order of its start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.undo[:n])


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the first word of each text (one more at the end).

    A word is a run of bytes other than blank and the controls 09 to 0D.
    """
    inside = ~IS_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[edges - 1] = inside[edges - 1]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def list_array(flat: pa.Array | np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat if isinstance(flat, pa.Array) else pa.array(flat))


def first_of_runs(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it."""
    if len(values) == 0:
        return np.zeros(0, np.int64)
    changed = np.empty(len(values), bool)
    changed[0] = True
    np.not_equal(values[1:], values[:-1], out=changed[1:])
    return np.flatnonzero(changed)


OF_ROW = np.uint64(0x9FB21C651E98DF25)


def in_row(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One hash for a value of a row."""
    return mixed(values.view(np.uint64) + rows.astype(np.uint64) * OF_ROW)


def flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row of every entry of a list column, and the entries."""
    bounds = lists.offsets.to_numpy()
    entries = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    return np.repeat(np.arange(len(lists), dtype=np.uint64), np.diff(bounds)), entries


def among(rows: np.ndarray, values: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether a value is in the list of its row."""
    owner, entries = flat(lists)
    return np.isin(in_row(rows, values), in_row(owner, entries.to_numpy()))
