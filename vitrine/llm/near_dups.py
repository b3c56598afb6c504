"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters, each pair verified once."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bitmaps import likely
from vitrine.llm.components import components
from vitrine.llm.words import FOLDED_TABLE, SPACED, Texts, Words, longs, map_texts, small_batches
from vitrine.spark_tools import staged

#: Counters of shingle frequency: a fixed number, so what is broadcast never grows.
BUCKETS = 1 << 18
#: Ranges of the shingle space whose sizes bound the difference of two sets: few that travel with each row, more for the pairs left.
RANGES, FINE = 8, 64


def shingle_sets(texts: Texts, lo: int, hi: int, n: int):
    """Sorted distinct shingle hashes of each row: n words each, or the whole text where it has fewer."""
    words = Words(texts, lo, hi, SPACED, FOLDED_TABLE)
    hashes, at = words.grams(n)
    first = np.searchsorted(at, words.first)
    short = {}
    for size in range(1, n):
        if np.any(words.counts == size):
            whole, start = words.grams(size)
            fits = words.counts[words.rows[start]] == size
            short.update(zip(words.rows[start[fits]].tolist(), whole[fits]))
    for row in range(hi - lo):
        if row in short:
            yield np.array([short[row]], dtype=np.uint64)
        else:
            yield np.unique(hashes[first[row] : first[row + 1]])


def bucket_counts(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Number of documents per bucket of shingles: `BUCKETS` numbers, however large the corpus."""

    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            texts = Texts(batch.column(0))
            for lo, hi in texts.blocks():
                for found in shingle_sets(texts, lo, hi, n):
                    np.add.at(counts, (found % np.uint64(BUCKETS)).astype(np.int64), 1)
        some = np.flatnonzero(counts)
        for lo in range(0, len(some), 1 << 16):
            part = some[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([longs(part), longs(counts[part])], names=["bucket", "n"])

    small_batches(docs.sparkSession)
    summed = docs.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts.astype(np.uint64)


def _set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _short_id(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def with_prefixes(docs: DataFrame, text: str, n: int, p: int, q: int, counts: np.ndarray) -> DataFrame:
    """``docs`` without text, with set size, set key, a 64-bit short id, the sizes of its ranges, and the prefix: rarest shingles first.

    The sizes of `RANGES` are kept modulo 256, a byte each in one long, those of `FINE` as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        weight = shared.value
        sizes, keys, ids, ranges, fine, prefixes = [], [], [], [], [], []
        for found in shingle_sets(texts, lo, hi, n):
            size = len(found)
            sizes.append(size)
            keys.append(_set_key(found))
            ids.append(_short_id(keys[-1]))
            edges = np.searchsorted(found, np.arange(1, FINE, dtype=np.uint64) * np.uint64((1 << 64) // FINE))
            fine.append(np.diff(np.concatenate(([0], edges, [size]))).astype(np.int32))
            ranges.append(fine[-1].reshape(RANGES, -1).sum(axis=1).astype(np.uint8).view(np.int64)[0])
            order = np.argsort(weight[(found % np.uint64(BUCKETS)).astype(np.int64)], kind="stable")
            prefixes.append(found[order[: size - -(-p * size // q) + 1]].view(np.int64) if size else found.view(np.int64))
        return [longs(sizes), pa.array(keys, pa.binary()), longs(ids), longs(ranges), pa.array(fine, pa.list_(pa.int32())),
                pa.array(prefixes, pa.list_(pa.int64()))]

    out = [T.StructField("n_shingles", T.LongType()), T.StructField("_key", T.BinaryType()), T.StructField("_id", T.LongType()),
           T.StructField("_ranges", T.LongType()), T.StructField("_fine", T.ArrayType(T.IntegerType())), T.StructField("_prefix", T.ArrayType(T.LongType()))]
    return map_texts(docs, text, out, make)


class Bounds:
    """Tests on sizes and positions of a pair that J >= p/q implies."""

    def __init__(self, p: int, q: int) -> None:
        self.p, self.q = p, q

    def slack(self, size: Column, pos: Column) -> Column:
        """The slacks of a pair at its first common shingle sum to at least 0."""
        return size * (self.q - self.p) - pos * (self.p + self.q)

    def lengths(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * self.q >= F.greatest(a, b) * self.p

    def positions(self, a: Column, pos_a: Column, b: Column, pos_b: Column) -> Column:
        return F.least(a - pos_a, b - pos_b) * (self.p + self.q) >= (a + b) * self.p

    def suffixes(self, a: Column, ranges_a: Column, b: Column, ranges_b: Column) -> Column:
        """Sets differ by at least the differences of their sizes within each range of shingles, or of these sizes modulo 256."""
        def size(packed: Column, i: int) -> Column:
            return F.shiftright(packed, 8 * i).bitwiseAND(F.lit(255).cast("long"))

        away = [F.abs(size(ranges_a, i) - size(ranges_b, i)) for i in range(RANGES)]
        apart = functools.reduce(Column.__add__, [F.least(d, 256 - d) for d in away])
        return apart * (self.p + self.q) <= (a + b) * (self.q - self.p)

    def finely(self, a: Column, fine_a: Column, b: Column, fine_b: Column) -> Column:
        """The same by the whole sizes of many ranges."""
        apart = F.aggregate(F.zip_with(fine_a, fine_b, lambda x, y: F.abs(x - y)), F.lit(0), lambda acc, x: acc + x)
        return apart * (self.p + self.q) <= (a + b) * (self.q - self.p)

    def fits(self, x: str, y: str) -> Column:
        """All filters on two rows whose columns have the suffixes ``x`` and ``y``."""
        (n_a, pos_a, r_a), (n_b, pos_b, r_b) = ([F.col(f"{c}{side}") for c in ("n", "pos", "ranges")] for side in (x, y))
        return self.lengths(n_a, n_b) & self.positions(n_a, pos_a, n_b, pos_b) & self.suffixes(n_a, r_a, n_b, r_b)


def _packed_texts(docs: DataFrame, text: str, n: int) -> DataFrame:
    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        keys = [_set_key(found) for found in shingle_sets(texts, lo, hi, n)]
        bodies = [pa.compress(texts.row(r), codec="zstd", asbytes=True) for r in range(lo, hi)]
        return [longs([_short_id(k) for k in keys]), pa.array(keys, pa.binary()),
                longs(np.diff(texts.bounds[lo : hi + 1])), pa.array(bodies, pa.binary())]

    out = [T.StructField("id", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("bytes", T.LongType()),
           T.StructField("body", T.BinaryType())]
    return map_texts(docs.select(text), text, out, make)


def _verify(pairs: DataFrame, docs: DataFrame, text: str, n: int, p: int, q: int) -> DataFrame:
    """Links (``a``, ``b`` as set keys, with their short ids) among the pairs of short ids, by comparing the whole sets."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-wanted")
    bodies = likely(_packed_texts(docs, text, n), wanted, "id").join(wanted, "id", "left_semi").groupBy("id", "key").agg(F.first(F.struct("bytes", "body")).alias("text"))
    bodies = staged(bodies.select("id", "key", "text.*"), "near-texts")
    left, right = (bodies.select(*[F.col(c).alias(f"{c}_{side}") for c in bodies.columns]) for side in "ab")
    both = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b")).drop("a", "b")

    def run(batches):
        held: dict[bytes, np.ndarray] = {}

        def whole(key: bytes, size: int, body: bytes) -> np.ndarray:
            if key not in held:
                if len(held) >= 64:
                    held.pop(next(iter(held)))
                texts = Texts(pa.array([pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)], pa.binary()))
                held[key] = next(shingle_sets(texts, 0, 1, n))
            return held[key]

        for batch in batches:
            linked = []
            for r in batch.to_pylist():
                x, y = (whole(r[f"key_{s}"], r[f"bytes_{s}"], r[f"body_{s}"]) for s in "ab")
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common * q >= p * (len(x) + len(y) - common))
            yield batch.select(["id_a", "key_a", "id_b", "key_b"]).filter(pa.array(linked, pa.bool_()))

    return staged(both.mapInArrow(run, "id_a long, key_a binary, id_b long, key_b binary"), "near-links")


def _pairs(rows: DataFrame, fine: DataFrame, bounds: Bounds) -> DataFrame:
    """Distinct pairs of short ids that the finer ranges leave."""
    pairs = rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    for side in "ab":
        pairs = pairs.join(fine.select(*[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "fine")]), F.col(side) == F.col(f"id_{side}"))
    return pairs.where(bounds.finely(F.col("n_a"), F.col("fine_a"), F.col("n_b"), F.col("fine_b"))).select("a", "b").distinct()


def linked_sets(docs: DataFrame, sets: DataFrame, text: str, n: int, p: int, q: int) -> DataFrame:
    """(``node``, ``comp``) of set keys for the sets that links join to a smaller key.

    Only components are asked for, so pairs within them need not all be seen. First each prefix shingle pairs its
    documents with one, that of the most slack: the one with the fewest rarer shingles before it, which most of a group of
    near copies link to if they link at all. Then documents of different components are paired where their slacks allow; a
    document whose slack is too small for every other component at a shingle is dropped there first.
    """
    bounds = Bounds(p, q)
    rows = sets.where(F.col("n_shingles") > 0).select(
        F.col("_id").alias("id"), F.col("n_shingles").alias("n"), F.col("_ranges").alias("ranges"), F.posexplode("_prefix").alias("pos", "shingle")
    )
    # Shingles that two sets meet at by chance are far the most: of just two rows, all filters are judged here.
    place = F.shiftleft("n", 32) + F.col("pos")
    several = rows.groupBy("shingle").agg(
        F.count("*").alias("rows"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(place).alias("x"), F.max(place).alias("y"),
        F.min("ranges").alias("r_x"), F.max("ranges").alias("r_y")).where("lo <> hi")
    (n_x, pos_x), (n_y, pos_y) = ((F.shiftright(c, 32), F.col(c).bitwiseAND((1 << 32) - 1)) for c in "xy")
    several = several.where((F.col("rows") > 2) | (
        bounds.lengths(n_x, n_y) & bounds.positions(n_x, pos_x, n_y, pos_y) & bounds.suffixes(n_x, F.col("r_x"), n_y, F.col("r_y")))).select("shingle")
    several = staged(several, "near-several")
    shared = likely(rows, several, "shingle").join(several, "shingle").distinct()
    shared = staged(shared.withColumn("slack", bounds.slack(F.col("n"), F.col("pos"))), "near-shared")
    some = staged(shared.select("id").distinct(), "near-ids")
    fine = sets.where(F.col("n_shingles") > 0).select(F.col("_id").alias("id"), F.col("n_shingles").alias("n"), F.col("_fine").alias("fine"))
    fine = staged(fine.join(some, "id", "left_semi").distinct(), "near-fine")

    lead = ("slack", "id", "n", "pos", "ranges")
    leaders = shared.groupBy("shingle").agg(F.max(F.struct(*lead)).alias("lead"))
    leaders = staged(leaders.select("shingle", *[F.col(f"lead.{c}").alias(f"{c}_l") for c in lead]), "near-leaders")
    stars = shared.join(leaders, "shingle").where((F.col("id") != F.col("id_l")) & bounds.fits("", "_l"))
    pairs = staged(_pairs(stars.select(F.col("id").alias("x"), F.col("id_l").alias("y")), fine, bounds), "near-pairs")
    links = _verify(pairs, docs, text, n, p, q)
    found = components(links.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))

    rest = staged(_pairs(_between(shared, links, found, bounds), fine, bounds).join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    if rest.isEmpty():
        return found
    more = _verify(rest, docs, text, n, p, q)
    both = links.unionByName(more).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    return components(both)


def _between(shared: DataFrame, links: DataFrame, found: DataFrame, bounds: Bounds) -> DataFrame:
    """Pairs (``x``, ``y``) of different components that share a shingle and pass the length and positional filters."""
    nodes = links.select(F.col("id_a").alias("id"), F.col("key_a").alias("node")).unionByName(
        links.select(F.col("id_b").alias("id"), F.col("key_b").alias("node"))).distinct()
    nodes = staged(nodes.join(found, "node", "left").select("id", F.coalesce("comp", "node").alias("comp")), "near-nodes")
    placed = shared.join(nodes, "id", "left").withColumn("comp", F.coalesce("comp", F.unhex(F.hex("id"))))
    placed = staged(placed, "near-placed")
    best = placed.groupBy("shingle", "comp").agg(F.max("slack").alias("slack"))
    first = best.groupBy("shingle").agg(F.count("*").alias("comps"), F.max(F.struct("slack", "comp")).alias("top")).where("comps > 1")
    first = staged(first.select("shingle", F.col("top.slack").alias("top_slack"), F.col("top.comp").alias("top_comp")), "near-first")
    second = best.join(first, "shingle").where("comp <> top_comp").groupBy("shingle").agg(F.max("slack").alias("next_slack"))
    tops = staged(first.join(second, "shingle"), "near-tops")
    other = F.when(F.col("comp") == F.col("top_comp"), F.col("next_slack")).otherwise(F.col("top_slack"))
    live = staged(placed.join(tops, "shingle").where(F.col("slack") + other >= 0).select(*placed.columns), "near-live")
    a, b = (live.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "pos", "ranges", "comp", "slack")]) for s in "ab")
    return a.join(b, "shingle").where(
        (F.col("comp_a") < F.col("comp_b")) & (F.col("slack_a") + F.col("slack_b") >= 0) & bounds.fits("_a", "_b")
    ).select(F.col("id_a").alias("x"), F.col("id_b").alias("y"))


def near_duplicates(docs: DataFrame, n: int = 5, p: int = 80, q: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) per row: documents link when J >= p/q on sets of n-word shingles.

    ``component_id`` is the smallest id reachable by links. NULL, empty and wordless texts have no shingles and link with nothing, copies
    with the same set are one class; NULL ids are never a component's id unless it has no other. Repeated rows each get their row.

    Any order of the shingles gives whole results; this one goes by the number of documents per bucket of shingles, so
    frequent shingles come last. Equal sets are told apart by a 128-bit key; 64-bit ids only gather candidates.
    """
    return _with_components(_sets(docs, n, p, q, doc_id, text), docs, n, p, q, text).select(
        F.col("_doc").alias(doc_id), "n_shingles", "component_id")


def _sets(docs: DataFrame, n: int, p: int, q: int, doc_id: str, text: str) -> DataFrame:
    named = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    return staged(with_prefixes(named, "_text", n, p, q, bucket_counts(named, "_text", n)), "near-sets")


def _classes(sets: DataFrame, docs: DataFrame, n: int, p: int, q: int, text: str) -> DataFrame:
    found = linked_sets(docs, sets, text, n, p, q)
    classes = sets.where(F.col("n_shingles") > 0).groupBy("_key").agg(F.min("_doc").alias("least"))
    classes = classes.join(found.withColumnRenamed("node", "_key"), "_key", "left").withColumn("comp", F.coalesce("comp", "_key"))
    classes = staged(classes, "near-classes")
    ids = staged(classes.groupBy("comp").agg(F.min("least").alias("component_id")), "near-ids")
    return staged(classes.join(ids, "comp").select("_key", "comp", "component_id"), "near-class-ids")


def _with_components(sets: DataFrame, docs: DataFrame, n: int, p: int, q: int, text: str) -> DataFrame:
    narrow = sets.select("_doc", "n_shingles", "_key")
    some = narrow.where(F.col("n_shingles") > 0).join(_classes(sets, docs, n, p, q, text), "_key")
    none = narrow.where(F.col("n_shingles") == 0).withColumns({"component_id": F.col("_doc"), "comp": F.lit(None).cast("binary")})
    return some.unionByName(none)


def keep_one_each(docs: DataFrame, n: int = 5, p: int = 80, q: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id. Rows without shingles all stay."""
    held = [f"_c{i}" for i in range(len(docs.columns))]
    id_col, body = held[docs.columns.index(doc_id)], held[docs.columns.index(text)]
    rows = docs.toDF(*held)
    marked = _with_components(_sets(rows, n, p, q, id_col, body), rows, n, p, q, body)
    chosen = marked.where((F.col("n_shingles") > 0) & F.col("_doc").eqNullSafe(F.col("component_id")))
    # Of one component's rows with the smallest id, possibly several and of different sets, one set is chosen.
    chosen = chosen.groupBy("comp").agg(F.min("_key").alias("_key"), F.min("_doc").alias("_doc"))
    chosen = staged(chosen.select("_doc", "_key"), "near-chosen")

    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        found = list(shingle_sets(texts, lo, hi, n))
        return [longs([len(f) for f in found]), pa.array([_set_key(f) for f in found], pa.binary())]

    out = [T.StructField("_n", T.LongType()), T.StructField("_key", T.BinaryType())]
    keyed = map_texts(rows, body, out, make, keep_text=True)
    same = (keyed["_key"] == chosen["_key"]) & keyed[id_col].eqNullSafe(chosen["_doc"])
    kept = keyed.where(F.col("_n") > 0).join(chosen, same, "left_semi")
    repeated = marked.where("n_shingles > 0").join(
        chosen.withColumnsRenamed({"_doc": "_d", "_key": "_k"}), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left_semi"
    ).groupBy("_doc", "_key").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["_key", id_col])
    return kept.unionByName(keyed.where(F.col("_n") == 0)).select(*held).toDF(*docs.columns)
