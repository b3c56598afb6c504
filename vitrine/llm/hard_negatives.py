"""Hard-negative mining: exact integer scores by matrix products of residues, then negatives from a window below each positive's score.

Component matrices are reduced modulo a few small primes and multiplied in float32, where every sum stays below 2**24 and so is exact;
Chinese remaindering gives the signed score. All anchors meet all rows block by block: rows stay in groups of bounded size, blocks of
anchors are sent to each group, and a task holds one group, one block of anchors and the best candidates so far.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.words import longs
from vitrine.spark_tools import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative scores from 30 % to 90 % of the positive.
LOW, HIGH, WHOLE = 30, 90, 100
#: Rows and components of one block, rows of a group (in blocks), components of one product.
BLOCK_ROWS, BLOCK_CELLS, GROUP_BLOCKS, CHUNK = 4096, 1 << 18, 64, 1024
ANCHOR_ROWS = 512
_EXACT = 1 << 24
_LEAST = np.iinfo(np.int64).min


def residue_primes(width: int, most: int) -> list[int]:
    """Largest primes whose balanced residues of ``width`` components multiply exactly in float32, enough to tell scores up to ``most``."""
    limit = 2 * math.isqrt((_EXACT - 4096) // min(max(width, 1), CHUNK)) + 1
    limit = min(limit, 2047)
    primes, product = [], 1
    for p in range(limit, 2, -1):
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            primes.append(p)
            product *= p
            if product > 4 * most + 4:
                return primes
    raise ValueError("no set of small primes tells scores of this size")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """float32 whole numbers below 2**24 reduced to about -p/2..p/2."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    r = x % p
    return (r - p * (r > p // 2)).astype(np.float32)


def scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """Exact int64 inner products of the rows of ``a`` with those of ``b`` (whole numbers), by residues and mixed-radix digits."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        r = np.zeros((len(a), len(b)), dtype=np.float32)
        for at in range(0, a.shape[1], CHUNK):
            r = _balanced(r + _residues(a[:, at : at + CHUNK], p) @ _residues(b[:, at : at + CHUNK], p).T, p)
        for j in range(i):
            back = pow(primes[j], -1, p)
            r = _balanced((r - digits[j]) * np.float32(back - p if back > p // 2 else back), p)
        digits.append(r)
    # Digits are balanced, so partial sums may wrap modulo 2**64 but the whole lies within the bound.
    total, unit = np.zeros((len(a), len(b)), dtype=np.int64), 1
    for p, digit in zip(primes, digits):
        total += digit.astype(np.int64) * np.uint64(unit % (1 << 64)).astype(np.int64)
        unit *= p
    return total


def first_of_each(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each group by descending score, then name."""
    order = np.lexsort((name, -score, group))
    sorted_group = group[order]
    begins = np.flatnonzero(np.concatenate(([True], sorted_group[1:] != sorted_group[:-1]))) if len(order) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[place < k]


class Best:
    """The first ``k`` candidates of each of ``n`` queries so far; `offer` takes whole blocks of scores."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.floor = np.full(n, _LEAST, dtype=np.int64)
        self.query, self.score, self.name = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def offer(self, block: np.ndarray, allowed: np.ndarray, names: np.ndarray, query: np.ndarray) -> None:
        """``block`` has a row of scores per entry of ``query``; of the ``allowed`` ones all that may be among the first are merged."""
        allowed = allowed & (block >= self.floor[query][:, None])
        if block.shape[1] > self.k:
            # Ties with the last of the block's own first k stay in.
            own = np.partition(np.where(allowed, block, _LEAST), block.shape[1] - self.k, axis=1)[:, block.shape[1] - self.k]
            allowed &= block >= own[:, None]
        row, column = np.nonzero(allowed)
        if not len(row):
            return
        group = np.concatenate((self.query, query[row]))
        score = np.concatenate((self.score, block[row, column]))
        name = np.concatenate((self.name, names[column]))
        keep = first_of_each(group, score, name, self.k)
        self.query, self.score, self.name = group[keep], score[keep], name[keep]
        full = np.bincount(self.query, minlength=len(self.floor)) >= self.k
        least = np.full(len(self.floor), np.iinfo(np.int64).max)
        np.minimum.at(least, self.query, self.score)
        self.floor = np.where(full, least, _LEAST)


def _packed(rows: DataFrame, width: int, per_block: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (``vec_id``, ``label``, ``parts``, further long columns) as blocks of ``n`` rows, each column one binary value."""
    names = ("vec_id", "label", *extra)

    def matrix(column: pa.Array) -> np.ndarray:
        sizes = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(sizes), width), dtype=np.int64)
        out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
        return out

    def run(batches):
        held: list[tuple] = []

        def block(parts):
            columns = [np.concatenate(x) for x in zip(*parts)]
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], names=["n", *names, "parts"])

        count = 0
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
            parts = matrix(batch.column("parts"))
            at = 0
            while at < len(parts):
                take = min(per_block - count, len(parts) - at)
                held.append((*(c[at : at + take] for c in columns), parts[at : at + take]))
                count, at = count + take, at + take
                if count == per_block:
                    yield block(held)
                    held, count = [], 0
        if held:
            yield block(held)

    schema = "n int, " + ", ".join(f"{c} binary" for c in (*names, "parts"))
    return rows.select(*names, "parts").mapInArrow(run, schema)


def _longs(value) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype=np.int64)


def _met(anchors: DataFrame, blocks: DataFrame, groups: int, schema: str, judge: Callable) -> DataFrame:
    """Each block of anchors with every block of rows, in order of the anchors' blocks; ``judge`` turns such a run into candidates."""
    everywhere = anchors.withColumn("block", F.monotonically_increasing_id()).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = everywhere.select("group", F.col("block").alias("ask"), *[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    pairs = asked.repartition(groups, "group").join(blocks.repartition(groups, "group").hint("merge"), "group")

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            asks = batch.column("ask").to_pylist()
            for i, ask in enumerate(asks):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                if ask != now:
                    if state is not None:
                        yield state.result()
                    now, state = ask, judge(row)
                state.take(row)
        if state is not None:
            yield state.result()

    return pairs.mapInArrow(run, schema)


class _Ask:
    """A block of anchors on its way through the rows of a group."""

    def __init__(self, row: dict, width: int, primes: list[int]) -> None:
        self.width, self.primes = width, primes
        self.row, self.ids, self.labels = _longs(row["a_row"]), _longs(row["a_vec_id"]), _longs(row["a_label"])
        self.parts = _longs(row["a_parts"]).reshape(-1, width)

    def block(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, names, whether the label is the anchor's, and scores."""
        names, labels = _longs(row["vec_id"]), _longs(row["label"])
        rows = row["first"].as_py() + np.arange(len(names))
        return rows, names, self.labels[:, None] == labels, scores(self.parts, _longs(row["parts"]).reshape(-1, self.width), self.primes)


class _Positives(_Ask):
    def __init__(self, row: dict, width: int, primes: list[int], k: int) -> None:
        super().__init__(row, width, primes)
        self.best = Best(len(self.ids), k)

    def take(self, row: dict) -> None:
        rows, names, same, found = self.block(row)
        self.best.offer(found, same & (self.row[:, None] != rows), names, np.arange(len(self.ids)))

    def result(self) -> pa.RecordBatch:
        b = self.best
        return pa.RecordBatch.from_arrays(list(map(longs, (self.row[b.query], b.name, b.score))), names=["row", "positive_id", "positive_score"])


class _Negatives(_Ask):
    def __init__(self, row: dict, width: int, primes: list[int], k: int, bounds: tuple[int, int, int]) -> None:
        super().__init__(row, width, primes)
        low, high, whole = bounds
        self.place, self.positive, score = (_longs(row[f"a_{c}"]) for c in ("place", "positive_id", "positive_score"))
        self.low, self.high = -(-score * low // whole), score * high // whole
        self.positive_score, self.best = score, Best(len(score), k)

    def take(self, row: dict) -> None:
        _, names, same, found = self.block(row)
        fits = ~same & (found >= self.low[:, None]) & (found <= self.high[:, None])
        self.best.offer(found, fits, names, np.arange(len(self.ids)))

    def result(self) -> pa.RecordBatch:
        b = self.best
        made = (self.row[b.query], self.ids[b.query], self.place[b.query], self.positive[b.query], self.positive_score[b.query], b.name, b.score)
        names = ["row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.RecordBatch.from_arrays(list(map(longs, made)), names=names)


def _usable(rows: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """(``vec_id``, ``label``, ``scaled``) of rows with an id, a label, and a vector of finite components."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.when(~F.coalesce(bad, F.lit(True)), scaled).alias("scaled"))
    return held.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull())


def mine_hard_negatives(
    rows: DataFrame, vec_id: str = "vec_id", label: Column | None = None, vector: str = "embedding", anchor: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES, bounds: tuple[int, int, int] = (LOW, HIGH, WHOLE),
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``), scores of whole components.

    Each component x counts as floor(256 * x). Anchors are rows for which ``anchor`` (of ``vec_id``; by default those divisible by 100)
    holds. An anchor's positives are its first other rows of the same label, by score, then id; each positive's negatives are the
    first rows of other labels whose score lies from 30 % to 90 % of the positive's. NULL ids, labels, vectors or components, NaN and
    infinite components take a row out. Shorter vectors count as filled up with zeros. Equal ids are different rows. An empty table,
    or one without anchors, gives no rows. Other columns are ignored. A table whose scores might exceed 62 bits raises ValueError.
    """
    label = F.col("label") if label is None else label
    anchor = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    spark = rows.sparkSession
    usable = _usable(rows, vec_id, label, vector)
    size = F.coalesce(F.greatest(F.array_max("scaled"), -F.array_min("scaled")), F.lit(0.0))
    n, width, most = usable.agg(
        F.count("*"), F.coalesce(F.max(F.size("scaled")), F.lit(0)), F.coalesce(F.max(size), F.lit(0.0))).first()
    width = max(width, 1)
    if width * most * most >= 2.0**62:
        raise ValueError("scores may exceed 62 bits")
    primes = residue_primes(width, width * int(most) ** 2)
    per_block = max(16, min(BLOCK_ROWS, BLOCK_CELLS // width))
    whole = usable.select("vec_id", "label", F.transform("scaled", lambda x: x.cast("long")).alias("parts"))
    blocks = _packed(whole, width, per_block).withColumn("first", F.monotonically_increasing_id() * per_block)
    # As many groups as the rows need; for few rows, enough to keep the session's tasks busy.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-n // (per_block * GROUP_BLOCKS)), min(-(-n // per_block), tasks))
    blocks = staged(blocks.withColumn("group", F.pmod(F.xxhash64("first"), F.lit(groups)).cast("int")), "neg-blocks")

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, parts = (_longs(batch.column(c)[i]) for c in ("vec_id", "label", "parts"))
                offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays(
                    [longs(batch.column("first")[i].as_py() + np.arange(len(ids))), longs(ids), longs(labels),
                     pa.ListArray.from_arrays(offsets, pa.array(parts))], names=["row", "vec_id", "label", "parts"])

    singles = blocks.select("first", "vec_id", "label", "parts").mapInArrow(unpack, "row long, vec_id long, label long, parts array<long>")
    anchors = staged(singles.where(anchor), "neg-anchors")
    asks = staged(_packed(anchors, width, ANCHOR_ROWS, ("row",)), "neg-asks")
    near = _met(asks, blocks, groups, "row long, positive_id long, positive_score long", lambda row: _Positives(row, width, primes, positives))
    by_score = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    near = staged(near.withColumn("place", F.row_number().over(by_score).cast("long")).where(F.col("place") <= positives), "neg-positives")
    with_positives = anchors.join(near, "row")
    asks = staged(_packed(with_positives, width, ANCHOR_ROWS, ("row", "place", "positive_id", "positive_score")), "neg-asks")
    schema = "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _met(asks, blocks, groups, schema, lambda row: _Negatives(row, width, primes, negatives, bounds))
    by_score = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
