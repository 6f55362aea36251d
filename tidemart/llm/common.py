"""What several corpus operators share: word pattern, table access, and words in numpy.

Words are the runs of bytes other than space and the controls 9 to 13. UTF-8 never uses those
bytes inside a longer character, so words can be cut on bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import tune

WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes per Arrow batch: long texts must fit a Python worker many times over.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: Bytes of text handled at once inside a Python worker.
CHUNK = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(rows: DataFrame) -> DataFrame:
    """The rows, to be handed to Python in batches of few: texts are long."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows


def give_back() -> None:
    """Return freed memory to the machine; workers outlive their tasks and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function over batches that gives memory back now and then, and when its task ends."""

    @wraps(run)
    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for n, out in enumerate(run(batches)):
                yield out
                if n % 32 == 31:
                    give_back()
        finally:
            give_back()

    return call


def word_count(text: str) -> Column:
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


_MASK = np.ones(256, bool)
_MASK[[0x20, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64))


class Words:
    """Words of one chunk of bytes: where they start and end, which text they belong to."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool):
        """bounds: where each text starts, and the end."""
        self.data = _LOWER[data] if lower else data
        inside = _MASK[data]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        first = bounds[:-1]
        before[first[first < len(data)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:] & before[1:]
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(bounds, self.starts, "right") - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit value per word; equal words have equal values."""
        n = len(self.data)
        up, down = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[self.data] * up[:n], out=sums[1:])
        return _mix((sums[self.ends] - sums[self.starts]) * down[self.starts])


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 4096)
        steps = [np.full(size, b, np.uint64) for b in (_BASE, _INVERSE)]
        for s in steps:
            s[0] = 1
        _POWERS[:] = [np.cumprod(s, dtype=np.uint64) for s in steps]
    return _POWERS[0], _POWERS[1]


def pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, number of texts, bytes, bounds) over a column, about CHUNK bytes at a time.

    A long text comes as several pieces in a row, cut where a word ends; null is empty. bounds
    has where each text starts in the bytes, and the end.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        j = min(j, len(texts))
        begin, end = int(at[i]), int(at[j])
        while end - begin > 2 * CHUNK:  # one text only
            cut = begin + CHUNK
            while cut < end and _MASK[data[cut]]:
                cut += 1
            yield i, 1, data[begin:cut], np.array([0, cut - begin])
            begin = cut
        bounds = at[i:j + 1] - begin
        bounds[0] = 0
        yield i, j - i, data[begin:end], bounds
        i = j


def chunks(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """The words of each of `pieces`; Word.text counts from the piece's first text."""
    for i, n, data, bounds in pieces(texts):
        yield i, n, Words(data, bounds, lower)
