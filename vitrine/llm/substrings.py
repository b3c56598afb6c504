"""Suffix-array dedup: prefix doubling over sampled positions removes every byte of strings that occur twice.

A plain suffix array ranks every byte of the corpus in every round. Here each string of the threshold's length is ranked at one
position only: the one among its own bytes whose window of half that length hashes lowest (the leftmost of equals). Equal strings
choose equal positions, so nothing is missed, and about one byte in a hundred becomes a row. Each round then widens the
windows and re-ranks the positions whose windows were still shared: half the threshold, then all but `CELL` bytes, then all of it.
A position drops out when its window is unique, and is done when what it can stand for lies within one shared window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bitmaps import likely
from vitrine.llm.words import BLOCK_BYTES, EXACT_TABLE, Texts, longs, map_texts, prefix_hash, range_hash
from vitrine.spark_tools import staged

THRESHOLD = 400
#: String starts that one row of the second round stands for.
CELL = 16
_PLACE = np.uint64((1 << 24) - 1)


def _digest(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def text_key(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest()


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` keys, from running minima within blocks of that width."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def sampled(data: np.ndarray, bounds: np.ndarray, length: int):
    """(row, place, first start, last start, window hash) of the sampled positions, all relative to ``data``.

    The strings that start from the first to the last start are ranked at the place.
    """
    half = length // 2
    width = length - half + 1
    if len(data) < length:
        return None
    sums = prefix_hash(data, EXACT_TABLE)
    at = np.arange(len(data) - half + 1)
    hashes = range_hash(sums, at, at + half)
    lowest = _lowest((hashes & ~_PLACE) | at.astype(np.uint64), width)
    row = np.searchsorted(bounds, np.arange(len(lowest)), side="right") - 1
    starts = np.flatnonzero(np.arange(len(lowest)) + length <= bounds[np.minimum(row + 1, len(bounds) - 1)])
    if not len(starts):
        return None
    place = (lowest[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new - 1, [len(starts) - 1]))
    return row[starts[first]], place[first], starts[first], starts[last], hashes[place[first]].view(np.int64)


def _positions(docs: DataFrame, text: str, length: int) -> DataFrame:
    """A row per sampled position: text key, ``at``, the nearest and farthest string start before it, window and whole-stretch hash."""
    schema = "key binary, at int, near short, far short, window long, stretch long"

    def run(batches):
        for batch in batches:
            texts = Texts(batch.column(0))
            for lo, hi in texts.blocks():
                keys = pa.array([text_key(texts.row(r)) for r in range(lo, hi)], pa.binary())
                begin, end = int(texts.bounds[lo]), int(texts.bounds[hi])
                # Longer rows come alone, in pieces that overlap by one string less a byte.
                for a in range(begin, max(end, begin + 1), BLOCK_BYTES) if hi == lo + 1 else [begin]:
                    b = min(a + BLOCK_BYTES + length - 1, end) if hi == lo + 1 else end
                    part = texts.data[a:b]
                    found = sampled(part, np.clip(texts.bounds[lo : hi + 1], a, b) - a, length)
                    if found is None:
                        continue
                    row, place, first, last, window = found
                    body = part.tobytes()
                    stretch = [_digest(body[x : y + length]) for x, y in zip(first.tolist(), last.tolist())]
                    origin = texts.bounds[lo + row] - a
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(row)), pa.array(place - origin, pa.int32()), pa.array(place - last, pa.int16()),
                         pa.array(place - first, pa.int16()), pa.array(window), longs(stretch)],
                        names=["key", "at", "near", "far", "window", "stretch"])

    return docs.select(text).mapInArrow(run, schema)


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_key`` and the text compressed as ``_body``, in place of the text."""

    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        bodies = [texts.row(r) for r in range(lo, hi)]
        return [pa.array(list(map(text_key, bodies)), pa.binary()), longs(list(map(len, bodies))),
                pa.array([pa.compress(b, codec="zstd", asbytes=True) for b in bodies], pa.binary())]

    out = [T.StructField("_key", T.BinaryType()), T.StructField("_bytes", T.LongType()), T.StructField("_body", T.BinaryType())]
    return map_texts(docs, text, out, make)


def _unpack(body: bytes, size: int) -> bytes:
    return pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)


def _split(rows: DataFrame, rank: list[str], whole: list[str]) -> tuple[DataFrame, DataFrame]:
    """Re-ranks positions: (those done, those to widen).

    Of ``rows`` (with ``copies``, and ``open``: not yet done), positions alone in their ``rank`` drop out. Done are open ones whose
    ``whole`` occurs again. Ranks that still have open positions go on with these and one of each set of equals.
    """
    classes = rows.groupBy(*rank, *whole).agg(
        F.sum("copies").alias("copies"), F.min(F.struct("key", "at")).alias("one"), F.max("open").alias("open"))
    classes = staged(classes, "sub-classes")
    left = classes.groupBy(*rank).agg(F.sum("copies").alias("all"), F.max((F.col("copies") == 1) & F.col("open")).alias("some")).where("all > 1")
    shared = staged(left.select(*rank, "some"), "sub-ranks")
    done = staged(classes.where(F.col("open") & (F.col("copies") > 1)).select(*rank, *whole), "sub-done")
    widen = classes.join(shared.where("some").select(*rank), rank, "left_semi").select(
        *rank, *whole, "one.*", "copies", ((F.col("copies") == 1) & F.col("open")).alias("open"))
    return rows.where("open").join(done, [*rank, *whole], "left_semi"), widen


def repeated_spans(docs: DataFrame, text: str = "text", length: int = THRESHOLD) -> DataFrame:
    """(``key`` of a text, ``start``, ``end``) stretches of bytes, each made of strings of ``length`` bytes that also start elsewhere."""
    positions = _positions(docs, text, length)
    again = staged(positions.groupBy("window").count().where("count > 1").select("window"), "sub-windows")
    # A window that passes the filter by chance is alone in its rank, and drops out there; no row is dealt by its window here.
    kept = likely(positions, again, "window").groupBy("key", "at", "near", "far", "window", "stretch").agg(F.count("*").alias("copies"))
    kept = staged(kept.withColumn("open", F.lit(True)), "sub-kept")
    done, widen = _split(kept, ["window"], ["near", "far", "stretch"])
    spans = [done.select("key", "at", "near", "far")]

    # The bytes around the positions that go on: at most twice the threshold each.
    ask = widen.groupBy("key").agg(F.collect_list(F.struct("at", "near", "far", "window", "copies", "open")).alias("ask"))
    ask = staged(ask, "sub-ask")
    bodies = _packed(docs.select(text), text).join(ask, F.col("_key") == F.col("key")).drop("_key")
    around = staged(bodies.mapInArrow(_cut(length), "key binary, at int, near short, far short, window long, copies long, open boolean, body binary"), "sub-around")
    around = around.groupBy("key", "at", "near", "far", "window", "copies", "open").agg(F.first("body").alias("body"))
    around = staged(around, "sub-around")

    cells = staged(around.mapInArrow(_cells(length), "key binary, at int, near short, far short, copies long, open boolean, cell short, window long, stretch long"), "sub-cells")
    done, widen = _split(cells, ["cell", "window"], ["near", "far", "stretch"])
    spans.append(done.select("key", "at", "near", "far"))

    widen = widen.select("key", "at", F.col("near").alias("low"), F.col("far").alias("high"), F.col("copies").alias("times"), F.col("open").alias("asked"))
    widen = staged(widen, "sub-widen")
    # A position of a text read in pieces may stand for two ranges of starts.
    inside = (F.col("low") >= F.col("near")) & (F.col("high") <= F.col("far"))
    last = around.select("key", "at", "near", "far", "body").join(widen, ["key", "at"]).where(inside)
    single = last.mapInArrow(_singles(length), "key binary, at int, near short, copies long, open boolean, whole binary")
    single = staged(single, "sub-single")
    twice = staged(single.groupBy("whole").agg(F.sum("copies").alias("n")).where("n > 1").select("whole"), "sub-twice")
    found = single.where("open").join(twice, "whole", "left_semi")
    spans.append(found.select("key", "at", "near", F.col("near").alias("far")))
    every = spans[0].unionByName(spans[1]).unionByName(spans[2])
    return every.select("key", (F.col("at") - F.col("far")).alias("start"), (F.col("at") - F.col("near") + length).alias("end"))


def _cut(length: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                body = _unpack(r["_body"], r["_bytes"])
                ask = r["ask"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["key"]] * len(ask), pa.binary()), pa.array([x["at"] for x in ask], pa.int32()),
                    pa.array([x["near"] for x in ask], pa.int16()), pa.array([x["far"] for x in ask], pa.int16()),
                    longs([x["window"] for x in ask]), longs([x["copies"] for x in ask]), pa.array([x["open"] for x in ask], pa.bool_()),
                    pa.array([body[x["at"] - x["far"] : x["at"] - x["near"] + length] for x in ask], pa.binary()),
                ], names=["key", "at", "near", "far", "window", "copies", "open", "body"])

    return run


def _cells(length: int):
    """Round two: the starts of a position in cells of `CELL`, each with the hash of the bytes all its strings share, and of all their bytes."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                far, body = r["far"], r["body"]
                for cell in range(r["near"] // CELL, far // CELL + 1):
                    low, high = cell * CELL, cell * CELL + CELL - 1
                    shared = body[far - low : far - high + length] if low <= far else b""
                    near, end = max(low, r["near"]), min(high, far)
                    rows.append((r["key"], r["at"], near, end, r["copies"], r["open"], cell, _digest(shared), _digest(body[far - end : far - near + length])))
            yield _batch(rows, [("key", pa.binary()), ("at", pa.int32()), ("near", pa.int16()), ("far", pa.int16()), ("copies", pa.int64()),
                                ("open", pa.bool_()), ("cell", pa.int16()), ("window", pa.int64()), ("stretch", pa.int64())])

    return run


def _singles(length: int):
    """Last round: every start by itself, with a 128-bit hash of its string."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for start in range(r["low"], r["high"] + 1):
                    whole = r["body"][r["far"] - start : r["far"] - start + length]
                    rows.append((r["key"], r["at"], start, r["times"], r["asked"], text_key(whole)))
            yield _batch(rows, [("key", pa.binary()), ("at", pa.int32()), ("near", pa.int16()), ("copies", pa.int64()), ("open", pa.bool_()),
                                ("whole", pa.binary())])

    return run


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def remove_repeats(docs: DataFrame, text: str = "text", length: int = THRESHOLD, keep_bytes: bool = False) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and, if asked, the ``kept`` bytes.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else, in the same document or another;
    all places of a repeated string go, and strings are judged on the input. NULL reads as empty; shorter texts keep all; repeated rows
    repeat each other. Columns named like a result column are replaced. Lengths up to 32,000.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "_key", "_bytes", "_body", "_spans")
    docs = docs.drop(*made)
    spans = repeated_spans(docs, text, length).distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    spans = staged(spans.withColumnRenamed("key", "_key"), "sub-spans")
    rows = _packed(docs, text).join(spans, "_key", "left")
    keep = [c for c in docs.columns if c != text]
    out = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    out += [T.StructField("kept", T.BinaryType())] if keep_bytes else []
    schema = T.StructType([docs.schema[c] for c in keep] + out)

    def run(batches):
        for batch in batches:
            sizes, bodies, asked = (batch.column(c).to_pylist() for c in ("_bytes", "_body", "_spans"))
            for lo in range(0, len(sizes), 64):
                made = []
                for size, packed, ask in zip(sizes[lo : lo + 64], bodies[lo : lo + 64], asked[lo : lo + 64]):
                    body, kept, at, spans, removed = _unpack(packed, size), [], 0, 0, 0
                    end = -1
                    for s in ask or ():
                        if s["start"] > end:
                            spans += 1
                            kept.append(body[at : s["start"]])
                            end = s["start"]
                        if s["end"] > end:
                            removed += s["end"] - end
                            at = end = s["end"]
                    kept.append(body[at:])
                    left = b"".join(kept)
                    made.append((size, removed, spans, hashlib.sha256(left).hexdigest(), left))
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, 64) for c in keep] + columns[: len(out)], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)
