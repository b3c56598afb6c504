"""Words of whole texts as NumPy arrays, for Arrow batches inside tasks.

Both word classes of the operators separate at ASCII characters only, so words can be found on the UTF-8 bytes:
every byte of a non-ASCII character belongs to a word. Texts are scanned in blocks of about 1 MB, so memory stays
bounded by the block plus 24 bytes per word of the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
BATCH_ROWS = 1000


def _splitmix(n: int, seed: int) -> np.ndarray:
    z = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(z)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTES = np.arange(256)
#: Bytes of `[^\x20\x09-\x0D]+`.
SPACED = ~(((_BYTES >= 9) & (_BYTES <= 13)) | (_BYTES == 32))
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in text with A-Z lower-cased.
LETTERS = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | ((_BYTES >= 65) & (_BYTES <= 90)) | (_BYTES >= 128)
)

EXACT_TABLE = _splitmix(256, 7)
#: A-Z hash as a-z.
FOLDED_TABLE = EXACT_TABLE.copy()
FOLDED_TABLE[65:91] = EXACT_TABLE[97:123]

_STEP = 0xD6E8FEB86659FD93


class _Powers:
    """Powers of the odd hash base modulo 2**64, and their inverses; made where they are used, never sent with a job."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 4096)
            self.up, self.down = (self._series(base, size) for base in (_STEP, pow(_STEP, -1, 1 << 64)))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


powers = _Powers()


def prefix_hash(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any byte range follows; see `range_hash`."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * powers(len(data))[0], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


class Texts:
    """A string column of one Arrow batch as bytes and row bounds; NULL reads as empty."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_binary())
        bounds, data = column.buffers()[1:3]
        self.bounds = np.zeros(1, dtype=np.int64)
        if len(column):
            self.bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def row(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Runs of rows with at most about `BLOCK_BYTES` of text, or one longer row."""
        lo = 0
        while lo < len(self):
            hi = int(np.searchsorted(self.bounds, self.bounds[lo] + BLOCK_BYTES, side="right")) - 1
            hi = min(max(hi, lo + 1), len(self))
            yield lo, hi
            lo = hi


class Words:
    """Words of rows lo..hi of a batch: byte `starts` and `ends`, `hash`, and `first`, the first word of each row."""

    def __init__(self, texts: Texts, lo: int, hi: int, kind: np.ndarray, table: np.ndarray) -> None:
        bounds = texts.bounds[lo : hi + 1]
        found = [self._piece(texts.data, a, b, bounds, kind, table) for a, b in self._pieces(texts.data, bounds, kind)]
        self.starts, self.ends, self.hash = (np.concatenate(x) for x in zip(*found))
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)
        self.rows = np.repeat(np.arange(hi - lo), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    @staticmethod
    def _pieces(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, int]]:
        """The byte range in pieces that end outside words."""
        a, end = int(bounds[0]), int(bounds[-1])
        while True:
            b = min(a + BLOCK_BYTES, end)
            while b < end and kind[data[b - 1]]:
                ahead = data[b : min(b + 4096, end)]
                rest = np.flatnonzero(~kind[ahead])
                b += int(rest[0]) + 1 if len(rest) else len(ahead)
            yield a, b
            if b >= end:
                return
            a = b

    @staticmethod
    def _piece(data, a, b, bounds, kind, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = data[a:b]
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = kind[part]
        cut = np.zeros(len(part) + 1, dtype=bool)
        edges = bounds[(bounds >= a) & (bounds <= b)] - a
        cut[edges] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        return starts + a, ends + a, range_hash(prefix_hash(part, table), starts, ends)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n consecutive words within a row, and the index of their first word."""
        total = len(self) - n + 1
        if total <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        h = np.zeros(total, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(0xF1357AEA2E62A9C5) + self.hash[j : j + total]
        at = np.flatnonzero(self.rows[:total] == self.rows[n - 1 :])
        return mix(h[at] + np.uint64(n)), at

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each row."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.first[1:]] - total[self.first[:-1]]


def map_texts(
    df: DataFrame, text: str, out: list[T.StructField], make: Callable[[Texts, int, int], list[pa.Array]], keep_text: bool = False
) -> DataFrame:
    """``df`` with columns computed from whole texts: ``make(texts, lo, hi)`` returns an array per field of ``out``.

    The text column itself is dropped unless ``keep_text``.
    """
    keep = [c for c in df.columns if keep_text or c != text]
    schema = T.StructType([df.schema[c] for c in keep] + out)

    def run(batches):
        for batch in batches:
            texts = Texts(batch.column(text))
            kept = [batch.column(c) for c in keep]
            for lo, hi in texts.blocks():
                made = make(texts, lo, hi)
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in kept] + made, names=schema.fieldNames())

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold at most `BATCH_ROWS` rows: whole texts are long rows, and the default of 10,000 of them
    is held several times over between the JVM and Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))
