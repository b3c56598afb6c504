"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over whole training texts."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.words import FOLDED_TABLE, LETTERS, Texts, Words, longs, small_batches
from vitrine.spark_tools import staged

WINDOW = 10
#: Benchmark text that one broadcast may hold, about 50 MB with its index; a larger benchmark is scanned in blocks of this size.
BLOCK_CHARS = 8 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FILTER_BITS = 20


class WindowIndex:
    """Windows of a bounded set of items as sorted hashes, each with its item and first word; a hit is verified against the item's text.

    About 20 bytes per window besides the text. ``plain()`` is its content as built-in and NumPy values, for a broadcast.
    """

    def __init__(self, items: list[tuple[object, str | None]], n: int) -> None:
        self.items = [None if i is None else str(i) for i, _ in items]
        texts = Texts(pa.array([t for _, t in items], pa.large_string()))
        self.data = texts.data
        starts, ends, parts, held = [], [], {}, 0
        for lo, hi in texts.blocks():
            words = Words(texts, lo, hi, LETTERS, FOLDED_TABLE)
            starts.append(words.starts)
            ends.append(words.ends)
            for size in sorted({int(min(n, c)) for c in np.unique(words.counts) if c}):
                hashes, at = words.grams(size)
                fits = (words.counts[words.rows[at]] >= n) if size == n else (words.counts[words.rows[at]] == size)
                rows = (lo + words.rows[at[fits]]).astype(np.int32)
                parts.setdefault(size, []).append((hashes[fits], rows, (held + at[fits]).astype(np.int32)))
            held += len(words)
        kind = np.int32 if len(self.data) < 1 << 31 else np.int64
        self.starts, self.ends = (np.concatenate(x).astype(kind) if x else np.zeros(0, dtype=kind) for x in (starts, ends))
        #: Per window size: hashes in order, and the item and first word of each.
        self.windows = {}
        self.filters = {}
        for size, found in parts.items():
            hashes, rows, at = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((rows, hashes))
            self.windows[size] = (hashes[order], rows[order], at[order])
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
            bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters[size] = bits

    def plain(self) -> dict:
        return vars(self)

    @classmethod
    def of(cls, plain: dict) -> WindowIndex:
        index = cls.__new__(cls)
        vars(index).update(plain)
        return index

    def _words(self, k: int, n: int) -> bytes:
        return _joined(self.data[self.starts[k] : self.ends[k + n - 1]])

    def hits(self, texts: Texts, words: Words):
        """(first word, number of words, items) of every verified occurrence."""
        for size, (keys, items, places) in self.windows.items():
            hashes, at = words.grams(size)
            some = np.flatnonzero(self.filters[size][hashes >> np.uint64(64 - _FILTER_BITS)])
            low, high = (np.searchsorted(keys, hashes[some], side=side) for side in ("left", "right"))
            real = np.flatnonzero(high > low)
            for i, a, b in zip(some[real].tolist(), low[real].tolist(), high[real].tolist()):
                k = int(at[i])
                said = spoken(texts, words, k, size)
                found = {int(items[j]) for j in range(a, b) if self._words(int(places[j]), size) == said}
                if found:
                    yield k, size, found


def _joined(part: np.ndarray) -> bytes:
    return b" ".join(_WORD.findall(part.tobytes().lower()))


def spoken(texts: Texts, words: Words, k: int, n: int) -> bytes:
    """The n words from word k on, lower-cased and joined by spaces."""
    return _joined(texts.data[words.starts[k] : words.ends[k + n - 1]])


def scan_benchmark(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", item: str = "item_id", item_text: str = "text",
    clean: bool = False, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items`` (sorted strings) and, with ``clean``, ``clean_text``.

    A window is n consecutive words of an item (all words of a shorter one); a document word inside any occurrence is hit.
    Hash hits are verified word by word. ``clean_text`` is the text without hit stretches, from the start of their first
    word to the end of their last. NULL and empty texts and items have no words; items with a NULL id are matched but not
    listed; repeated items count once; repeated documents each get their row. Columns of ``docs`` with the names of
    result columns are replaced.

    One broadcast holds at most about ``block_chars`` of benchmark text; beyond, the documents are scanned once per block
    of items and the stretches found are merged from block to block.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("body")).where(F.col("body").isNotNull())
    size = tests.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    blocks = -(-size // block_chars) or 1
    made = ("n_words", "n_hit", "hit_items", "clean_text", "_spans")
    found = docs.drop(*made).withColumns({"_spans": F.lit(None).cast("array<int>"), "hit_items": F.lit(None).cast("array<string>")})
    for k in range(blocks):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("body", "item"), F.lit(blocks)) == k)
        table = part.toArrow()
        index = spark.sparkContext.broadcast(WindowIndex(list(zip(table["item"].to_pylist(), table["body"].to_pylist())), n).plain())
        found = _scan(found, text, index, clean and k == blocks - 1)
        if k < blocks - 1:
            found = staged(found.drop("n_words", "n_hit"), "decontaminate")
    return found.drop("_spans")


def _scan(docs: DataFrame, text: str, index, clean: bool) -> DataFrame:
    out = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
           T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("_spans", T.ArrayType(T.IntegerType()))]
    if clean:
        out.append(T.StructField("clean_text", T.StringType()))
    keep = [c for c in docs.columns if c not in ("hit_items", "_spans")]
    schema = T.StructType([docs.schema[c] for c in keep] + out)

    def run(batches):
        held = WindowIndex.of(index.value)
        for batch in batches:
            texts = Texts(batch.column(text))
            for lo, hi in texts.blocks():
                words = Words(texts, lo, hi, LETTERS, FOLDED_TABLE)
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                items: dict[int, set[str]] = defaultdict(set)
                for k, size, hit in held.hits(texts, words):
                    edges[k] += 1
                    edges[k + size] -= 1
                    items[int(words.rows[k])] |= {held.items[i] for i in hit if held.items[i] is not None}
                for row, (spans, had) in enumerate(zip(batch.column("_spans").slice(lo, hi - lo).to_pylist(),
                                                       batch.column("hit_items").slice(lo, hi - lo).to_pylist())):
                    items[row] |= set(had or ())
                    for a, b in zip((spans or ())[::2], (spans or ())[1::2]):
                        edges[words.first[row] + a] += 1
                        edges[words.first[row] + b] -= 1
                covered = np.cumsum(edges[:-1]) > 0
                runs = _runs(words, covered)
                made = [longs(words.counts), longs(words.sums(covered)),
                        pa.array([sorted(items[r]) for r in range(hi - lo)], pa.list_(pa.string())),
                        pa.array([[int(x - words.first[r]) for s in runs[r] for x in s] for r in range(hi - lo)], pa.list_(pa.int32()))]
                if clean:
                    made.append(pa.array(_without(texts, words, runs, batch.column(text), lo, hi), pa.string()))
                kept = [batch.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays(kept + made, names=schema.fieldNames())

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _runs(words: Words, covered: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Maximal hit runs of words per row; runs of different rows never join."""
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    hit = np.flatnonzero(covered)
    if len(hit):
        new = np.flatnonzero((np.diff(hit) > 1) | (np.diff(words.rows[hit]) > 0)) + 1
        for a, b in zip(hit[np.concatenate(([0], new))], hit[np.concatenate((new - 1, [len(hit) - 1]))]):
            runs[int(words.rows[a])].append((int(a), int(b) + 1))
    return runs


def _without(texts: Texts, words: Words, runs, column: pa.Array, lo: int, hi: int) -> list[str | None]:
    out = []
    for row in range(lo, hi):
        if not column[row].is_valid:
            out.append(None)
            continue
        at, parts = texts.bounds[row], []
        for a, b in runs.get(row - lo, ()):
            parts.append(texts.data[at : words.starts[a]].tobytes())
            at = words.ends[b - 1]
        parts.append(texts.data[at : texts.bounds[row + 1]].tobytes())
        out.append(b"".join(parts).decode())
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """``docs``, with its own columns, without contaminated documents or (``remove="spans"``) without hit stretches."""
    text = options.get("text", "text")
    held = [f"_c{i}" for i in range(len(docs.columns))]
    body = held[docs.columns.index(text)]
    found = scan_benchmark(docs.toDF(*held), benchmark, **(options | {"text": body, "clean": remove == "spans"}))
    if remove == "documents":
        return found.where(F.col("n_hit") == 0).select(*held).toDF(*docs.columns)
    return found.select(*["clean_text" if c == body else c for c in held]).toDF(*docs.columns)


def items_digest(items):
    return F.sha2(F.concat_ws(",", items), 256)
