"""Substring dedup against earlier documents: relative Lempel-Ziv parsing over indexed anchors.

Every document is a reference block for those with larger ids. Each window of words is indexed at one place only, its anchor: the word
run of half its length that hashes lowest in it. Equal windows have equal anchors, so about one word in four is indexed. A document
is then parsed from left to right: a factor starts at an anchor that an earlier document has, refers to the earliest such document,
and goes on greedily while the next anchor is found at the same distance there; anchors overlap or touch, so all words between them
are equal too. Factors as long as a window become spans. Windows at the ends of factors, or across two of them, are looked up by
themselves among all windows with the same anchors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.words import EXACT_TABLE, SPACED, Texts, Words, longs, mix, small_batches
from vitrine.spark_tools import staged

WINDOW = 13
#: Bits of a filter, 8 MB: larger sets of keys only filter less.
FILTER_BITS = 1 << 26
_SLOT_BITS = 32768


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size that marks the keys of a table by their low bits."""
    place = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1))
    slots = keys.groupBy(F.floor(place / _SLOT_BITS).alias("slot")).agg(
        F.bitmap_construct_agg(F.pmod(place, F.lit(_SLOT_BITS))).alias("bits")).toLocalIterator()
    bits = np.zeros((FILTER_BITS // _SLOT_BITS, _SLOT_BITS // 8), dtype=np.uint8)
    for slot, part in slots:
        bits[slot] = np.frombuffer(part, dtype=np.uint8)
    return bits.ravel()


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, first, last) of the anchors of a block of rows: windows that start from the first to the last have their anchor there."""
    gram = window // 2 + 1
    none = np.zeros(0, dtype=np.int64)
    if len(words) < window:
        return none, none, none, none
    runs = words.hash[: len(words) - gram + 1].copy()
    for j in range(1, gram):
        runs = runs * np.uint64(0xF1357AEA2E62A9C5) + words.hash[j : len(words) - gram + 1 + j]
    runs = mix(runs)
    starts = np.flatnonzero(words.rows[: len(words) - window + 1] == words.rows[window - 1 :])
    if not len(starts):
        return none, none, none, none
    lowest = np.lib.stride_tricks.sliding_window_view(runs, window - gram + 1).argmin(axis=1)
    place = starts + lowest[starts]
    new = np.flatnonzero((np.diff(place) != 0) | (words.rows[starts[1:]] != words.rows[starts[:-1]])) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new - 1, [len(starts) - 1]))
    return runs[place[first]].view(np.int64), place[first], starts[first], starts[last]


def _body_key(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def _scan(docs: DataFrame, schema: str, make) -> DataFrame:
    """``make(ids, texts, lo, words)`` per block of rows of (``doc_id``, ``text``)."""

    def run(batches):
        for batch in batches:
            texts = Texts(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi in texts.blocks():
                yield make(ids[lo:hi], texts, lo, Words(texts, lo, hi, SPACED, EXACT_TABLE))

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _index(docs: DataFrame, window: int) -> DataFrame:
    """(``key``, ``ref``, ``ref_at``) of anchors that two documents or more have: the earliest of these, and a place in it."""

    def make(ids, texts, lo, words):
        key, place, _, _ = anchors(words, window)
        row = words.rows[place]
        doc, at = ids[row], place - words.first[row]
        # A block sends each key once or twice, as its first and last document: large groups of copies combine here.
        order = np.lexsort((at, doc, key))
        key, doc, at = key[order], doc[order], at[order]
        edge = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=bool)
        keep = edge | np.concatenate((edge[1:], [True])) if len(key) else edge
        return pa.RecordBatch.from_arrays([longs(key[keep]), longs(doc[keep]), pa.array(at[keep], pa.int32())], names=["key", "doc_id", "at"])

    rows = _scan(docs, "key long, doc_id long, at int", make)
    found = rows.repartition("key").groupBy("key").agg(
        F.min("doc_id").alias("ref"), F.max("doc_id").alias("last"), F.min_by("at", "doc_id").alias("ref_at"))
    return found.where("ref < last").drop("last")


def _places(docs: DataFrame, window: int, wanted: np.ndarray) -> DataFrame:
    """Anchors whose key the filter marks: (``key``, ``doc_id``, ``body``, ``at``, ``near``, ``far``), the last two up to its window starts."""

    def make(ids, texts, lo, words):
        key, place, first, last = anchors(words, window)
        pick = np.flatnonzero(_marked(wanted, key))
        key, place, first, last = key[pick], place[pick], first[pick], last[pick]
        row = words.rows[place]
        body = np.zeros(len(ids), dtype=np.int64)
        for r in np.unique(row):
            body[r] = _body_key(texts.row(lo + r))
        return pa.RecordBatch.from_arrays(
            [longs(key), longs(ids[row]), longs(body[row]), pa.array(place - words.first[row], pa.int32()),
             pa.array(place - last, pa.int16()), pa.array(place - first, pa.int16())],
            names=["key", "doc_id", "body", "at", "near", "far"])

    return _scan(docs, "key long, doc_id long, body long, at int, near short, far short", make)


def parse(at: np.ndarray, near: np.ndarray, far: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, window: int):
    """Factors of one document from its indexed anchors, by place: ((start, end) of long ones, anchors with windows outside of these)."""
    gram = window // 2 + 1
    step = np.diff(at)
    cut = (step > gram) | (np.diff(ref) != 0) | (np.diff(ref_at) != step)
    begin = np.concatenate(([0], np.flatnonzero(cut) + 1))
    end = np.concatenate((begin[1:] - 1, [len(at) - 1]))
    low, high = at[begin], at[end] + gram
    of = np.repeat(np.arange(len(begin)), end - begin + 1)
    within = (high - low)[of] >= window
    inside = within & (at - far >= low[of]) & (at - near + window <= high[of])
    long_ones = np.flatnonzero(high - low >= window)
    return low[long_ones], high[long_ones], np.flatnonzero(~inside)


_SPANS = "array<struct<start:int,end:int>>"


def _factors(places: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(``doc_id``, ``body``, ``spans`` of long factors, ``open`` keys of anchors with windows still to be looked up)."""
    one = F.struct("at", "near", "far", "ref", "ref_at", "key")
    lists = places.join(index, "key").where("ref < doc_id").groupBy("doc_id", "body").agg(F.collect_list(one).alias("found"))

    def run(batches):
        for batch in batches:
            found = batch.column("found")
            bounds = found.offsets.to_numpy()
            flat = found.flatten()
            held = {name: flat.field(i).to_numpy(zero_copy_only=False) for i, name in enumerate(("at", "near", "far", "ref", "ref_at", "key"))}
            spans, opened = [], []
            for a, b in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0]):
                # Equal rows of a table share id and text: each place counts once.
                _, order = np.unique(held["at"][a:b], return_index=True)
                at, near, far, ref, ref_at, key = (held[c][a:b][order].astype(np.int64) for c in ("at", "near", "far", "ref", "ref_at", "key"))
                low, high, rest = parse(at, near, far, ref, ref_at, window)
                spans.append([{"start": s, "end": e} for s, e in zip(low.tolist(), high.tolist())])
                opened.append(np.unique(key[rest]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(opened, pa.list_(pa.int64()))], names=["doc_id", "body", "spans", "open"])

    return lists.mapInArrow(run, f"doc_id long, body long, spans {_SPANS}, open array<long>")


def _windows(docs: DataFrame, window: int, wanted: np.ndarray) -> DataFrame:
    """All windows whose anchor the filter marks: 128-bit ``hash`` as two halves, ``doc_id``, ``body``, ``start``."""

    def make(ids, texts, lo, words):
        key, place, first, last = anchors(words, window)
        pick = np.flatnonzero(_marked(wanted, key))
        count = last[pick] - first[pick] + 1
        start = np.repeat(first[pick] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(pick) else first[:0]
        halves = [np.zeros(len(start), dtype=np.uint64) for _ in range(2)]
        for half, base in zip(halves, (0xF1357AEA2E62A9C5, 0x9FB21C651E98DF25)):
            for j in range(window):
                half *= np.uint64(base)
                half += mix(words.hash[start + j] ^ np.uint64(base))
        row = words.rows[start]
        body = np.zeros(len(ids), dtype=np.int64)
        for r in np.unique(row):
            body[r] = _body_key(texts.row(lo + r))
        return pa.RecordBatch.from_arrays(
            [longs(mix(halves[0]).view(np.int64)), longs(mix(halves[1]).view(np.int64)), longs(ids[row]), longs(body[row]),
             pa.array(start - words.first[row], pa.int32())], names=["hash", "rest", "doc_id", "body", "start"])

    return _scan(docs, "hash long, rest long, doc_id long, body long, start int", make)


def earlier_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(``doc_id``, ``body``, ``spans``) of (``doc_id``, ``text``): stretches of words made of windows that also start in an earlier document."""
    docs = docs.where(F.col("doc_id").isNotNull())
    index = staged(_index(docs, window), "earlier-index")
    factors = staged(_factors(_places(docs, window, key_filter(index, "key")), index, window), "earlier-factors")
    opened = staged(factors.select(F.explode("open").alias("key")).distinct(), "earlier-open")
    windows = staged(_windows(docs, window, key_filter(opened, "key")), "earlier-windows")
    first = windows.groupBy("hash", "rest").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("last")).where("ref < last")
    first = staged(first.select("hash", "rest", "ref"), "earlier-first")
    single = windows.join(first, ["hash", "rest"]).where("ref < doc_id").select(
        "doc_id", "body", F.struct("start", (F.col("start") + window).alias("end")).alias("span"))
    every = single.unionByName(factors.select("doc_id", "body", F.explode("spans").alias("span")))
    return every.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def remove_earlier(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``n_removed``, ``kept_sha256``, and, if asked, the ``kept`` words joined by spaces.

    Removed is each word covered by a window of words that also starts in a row with a smaller id; windows are judged on the input.
    NULL and empty texts have no words. Rows with a NULL id keep all, and no row is compared with them; rows with equal ids, repeated
    ones included, are not earlier than each other. Columns named like a result column are replaced, all others kept as they are.
    A text's anchors travel as one row, like the text itself.
    """
    made = ("n_words", "n_removed", "kept_sha256", "kept")
    kept = [c for c in docs.columns if c not in made and c != text]
    held = [f"_c{i}" for i in range(len(kept))]
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spans = staged(earlier_spans(narrow, window), "earlier-spans")
    wanted = key_filter(spans, "body")
    rows = docs.select(*[F.col(c).alias(h) for c, h in zip(kept, held)], F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))

    def digest(body: bytes, cuts) -> tuple[int, int, str, str]:
        words = body.split()
        left, at, removed = [], 0, 0
        for s in cuts or ():
            if s["end"] > at:
                start = max(s["start"], at)
                left += words[at:start]
                removed += s["end"] - start
                at = s["end"]
        whole = b" ".join(left + words[at:])
        return len(words), removed, hashlib.sha256(whole).hexdigest(), whole.decode() if keep_text else None

    digests = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType()), ("kept", T.StringType())]
    passing = T.StructType([rows.schema[c] for c in (*held, "_id")])
    scanned = T.StructType([
        *passing.fields, T.StructField("_body", T.LongType()), *(T.StructField(n, t) for n, t in digests),
        T.StructField("_size", T.LongType()), T.StructField("_packed", T.BinaryType())])

    def judged(results) -> list[pa.Array]:
        columns = list(zip(*results)) if results else [()] * 4
        return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))]

    def scan(batches):
        """Texts that surely keep all are done here; only the others travel, compressed."""
        for batch in batches:
            texts = Texts(batch.column("_text"))
            numbers = batch.column("_id")
            for lo, hi in texts.blocks():
                bodies = [texts.row(r) for r in range(lo, hi)]
                keys = np.array([_body_key(b) for b in bodies], dtype=np.int64)
                cut = _marked(wanted, keys) & ~np.asarray(numbers.slice(lo, hi - lo).is_null())
                results = [(None, None, None, None) if c else digest(b, None) for b, c in zip(bodies, cut)]
                packed = [pa.compress(b, codec="zstd", asbytes=True) if c else None for b, c in zip(bodies, cut)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in passing.fieldNames()), longs(keys), *judged(results),
                     longs([len(b) for b in bodies]), pa.array(packed, pa.binary())], names=scanned.fieldNames())

    out = T.StructType([*passing.fields[:-1], *(T.StructField(n, t) for n, t in digests)])

    def finish(batches):
        for batch in batches:
            packed, sizes, cuts = (batch.column(c).to_pylist() for c in ("_packed", "_size", "spans"))
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                old = list(zip(*(part.column(n).to_pylist() for n, _ in digests)))
                results = [
                    o if p is None else digest(pa.decompress(p, decompressed_size=size, codec="zstd", asbytes=True), c)
                    for o, p, size, c in zip(old, packed[lo : lo + 64], sizes[lo : lo + 64], cuts[lo : lo + 64])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in held), *judged(results)], names=out.fieldNames())

    small_batches(docs.sparkSession)
    marked = rows.mapInArrow(scan, scanned)
    on = [marked["_id"] == spans["doc_id"], marked["_body"] == spans["body"]]
    done = marked.join(spans, on, "left").drop("doc_id", "body").mapInArrow(finish, out)
    return done.select(*[F.col(h).alias(c) for c, h in zip(kept, held)], *(n for n, _ in digests if keep_text or n != "kept"))
