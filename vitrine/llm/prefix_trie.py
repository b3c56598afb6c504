"""Conversation prefix trie by van Emde Boas recursion over the depth.

Sequences are cut at half depth. The cut prefixes get names; equal ones fall together, and their followers become forests below them. The
upper trie and all lower forests are then cut in half again, all pieces of one height at once, until each is one turn high: after
log2(depth) rounds every distinct prefix is one row, whatever the number of conversations. Totals go the other way: the sum of each
lower forest is grafted onto the place of the upper trie that it hangs from, from the first cut to the last.

No step gathers a conversation or a group of equal ones: turns are numbered by range, blocks of turns are named pair by pair, and
pieces meet their sequence's blocks one to one.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.spark_tools import staged

#: Ids of one span when members are listed.
ID_SPAN = 1 << 16
_ROOT = b"\x00" * 32


def _name(*parts: Column | str) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_rows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv_id``, ``pos``, ``name``, ``bytes``): the turns of each conversation numbered from 0, each as a 256-bit name and its text's size.

    Ordered by turn, NULL first, then role and text; NULL roles and texts are empty; rows without a conversation id belong to none.
    Turns are range-partitioned, so that a conversation of any length spreads over tasks, and numbered by counts per partition.
    """
    none = F.lit("")
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), none).alias("role"), F.coalesce(F.col(text), none).alias("text"),
    )
    # Short keys in the same order as the rows.
    short = F.when(F.char_length("role") <= 32, F.left("text", F.lit(64))).otherwise(none)
    spread = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), F.left("role", F.lit(32)), short)
    spread = spread.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("seq", F.monotonically_increasing_id())
    size = F.octet_length("text").cast("long")
    named = _name(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    rows = staged(spread.select("conv_id", "seq", F.shiftright("seq", 33).alias("part"), named.alias("name"), size.alias("bytes")), "trie-turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("seq").alias("begin"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.col("begin") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"))
    return rows.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("seq") - F.col("zero")).alias("pos"), "name", "bytes")


def crossed(rows: DataFrame, every: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (all ids, their rows) from `turn_rows`.

    Conversation c starts with the first h turns of conversation c - c % ``every``, h = crc32(c) % ``longest``, and goes on with its own
    turns after its first h.
    """
    lengths = staged(rows.groupBy("conv_id").agg(F.count("*").alias("turns")), "trie-lengths")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), taken.alias("h"))
    convs = convs.join(lengths.select(F.col("conv_id").alias("base"), "turns"), "base", "left")
    convs = staged(convs.withColumn("head", F.least("h", F.coalesce("turns", F.lit(0)))), "trie-convs")
    own = rows.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "name", "bytes")
    firsts = rows.where((F.col("pos") < longest - 1) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    heads = firsts.join(convs.select("conv_id", "base", "h"), "base").where("pos < h").select("conv_id", "pos", "name", "bytes")
    return convs.select("conv_id"), own.unionByName(heads)


def _blocks(rows: DataFrame) -> list[DataFrame]:
    """Blocks of 2, 4, … turns up to whole conversations: (``conv_id``, ``idx``, ``name``, names of its ``left`` and ``right`` half)."""
    deepest = rows.agg(F.max("pos")).first()[0] or 0
    levels, below = [], rows.select("conv_id", F.col("pos").alias("idx"), "name")
    for _ in range(max(1, deepest.bit_length())):
        halves = [F.max(F.when(F.col("idx") % 2 == side, F.col("name"))).alias(name) for side, name in enumerate(("left", "right"))]
        block = below.groupBy("conv_id", F.shiftright("idx", 1).alias("idx")).agg(*halves)
        block = block.withColumn("name", _name("left", F.coalesce("right", F.lit(b""))))
        levels.append(staged(block, "trie-blocks"))
        below = levels[-1].select("conv_id", "idx", "name")
    return levels


def _pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes, and the piece that each conversation as a whole is.

    A piece is a block of turns below a ``root``, the name of the cut prefix before it. It has a ``key``, its members' smallest
    ``conv_id`` and number ``n``, the cut prefixes above it by level (``roots``), and the keys of the pieces that end where it
    ends (``ends``). Pieces of one turn are the nodes.
    """
    levels = _blocks(rows)
    top = levels[-1].select("conv_id", _name(F.lit(_ROOT), "name").alias("key"))
    pieces = top.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).select(
        "key", F.lit(_ROOT).alias("root"), "conv_id", F.lit(0).cast("long").alias("idx"), "n",
        F.expr("cast(array() as array<struct<level:int,cut:binary>>)").alias("roots"), F.array("key").alias("ends"),
    )
    for level in range(len(levels), 0, -1):
        cut = pieces.withColumnRenamed("key", "_key").join(levels[level - 1].drop("name"), ["conv_id", "idx"])
        upper_key = _name("root", "left")
        # Only a prefix that ends within the left half ends where the upper piece does.
        upper = cut.groupBy(upper_key.alias("key")).agg(
            F.first("root").alias("root"), F.min("conv_id").alias("conv_id"), F.first(F.col("idx") * 2).alias("idx"), F.sum("n").alias("n"),
            F.first("roots").alias("roots"), F.first(F.when(F.col("right").isNull(), F.col("ends")), ignorenulls=True).alias("ends"),
        )
        lower = cut.where(F.col("right").isNotNull()).withColumn("root", upper_key).select(
            _name("root", "right").alias("key"), "root", "conv_id", (F.col("idx") * 2 + 1).alias("idx"), "n",
            F.array_append("roots", F.struct(F.lit(level).alias("level"), F.col("root").alias("cut"))).alias("roots"), "ends",
        )
        both = upper.unionByName(lower).withColumn("ends", F.array_append(F.coalesce("ends", F.expr("cast(array() as array<binary>)")), F.col("key")))
        pieces = staged(both, "trie-pieces")
    return pieces, top


def _members(ending: DataFrame) -> DataFrame:
    """(``key``, ``ends_sha256``): digest of the ascending ids (``key``, ``conv_id``), which are joined span by span and hashed as they come."""
    spans = ending.groupBy("key", F.floor(F.col("conv_id") / ID_SPAN).alias("span")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    ordered = spans.repartition("key").sortWithinPartitions("key", "span")
    return ordered.select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per distinct prefix, from all ids (``conv_id``) and the rows (``conv_id``, ``pos`` from 0 without gaps, ``name``, ``bytes``).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (in its subtree),
    ``saved_tokens`` ((members - 1) times bytes, summed over its subtree), ``ends_sha256`` of the members that end there. The root has
    depth 0 and every conversation, also such without turns; without any conversation there is no root and no row.
    """
    convs, rows = staged(convs.distinct(), "trie-ids"), staged(rows, "trie-rows")
    pieces, top = _pieces(rows)
    last = rows.select("conv_id", F.col("pos").alias("idx"), "bytes")
    nodes = pieces.join(last, ["conv_id", "idx"])
    nodes = staged(nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes")), "trie-nodes")
    places = nodes.select("key", F.explode("ends").alias("cut")).unionByName(rows.sparkSession.range(1).select(
        F.lit(_ROOT).alias("key"), F.lit(_ROOT).alias("cut")))
    places = staged(places, "trie-places")
    parents = nodes.select("key", F.col("root").alias("cut")).join(places.withColumnRenamed("key", "parent"), "cut").select("key", "parent")
    parents = staged(parents, "trie-parents")
    children = staged(parents.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")), "trie-children")

    totals = nodes.join(children, "key", "left").select("key", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"), "saved")
    totals = staged(totals, "trie-totals")
    grafts = nodes.select("key", F.inline("roots")).join(places.withColumnRenamed("key", "onto"), "cut").select("key", "level", "onto")
    grafts = staged(grafts, "trie-grafts")
    for level in range(grafts.agg(F.max("level")).first()[0] or 0, 0, -1):
        forests = totals.join(grafts.where(F.col("level") == level), "key").groupBy(F.col("onto").alias("key")).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals = staged(totals.unionByName(forests).groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-totals")

    ending = convs.join(top, "conv_id", "left").select("conv_id", F.coalesce("key", F.lit(_ROOT)).alias("cut"))
    members = _members(ending.join(places, "cut").select("key", "conv_id"))
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).where("n > 0")
    first = parents.where(F.col("parent") == F.lit(_ROOT)).join(totals, "key").groupBy(F.col("parent").alias("key")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = whole.withColumn("key", F.lit(_ROOT)).join(first, "key", "left").select(
        "key", "conv_id", F.lit(0).cast("long").alias("depth"), "n", F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"))
    every = nodes.join(totals.select("key", "leaves", F.col("saved").alias("saved_tokens")), "key").select(
        "key", "conv_id", (F.col("idx") + 1).alias("depth"), "n", F.col("leaves").alias("n_leaves"), "saved_tokens")
    every = staged(every.unionByName(root), "trie-all")
    named = parents.join(every.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").drop("parent")
    out = every.join(named, "key", "left").join(children, "key", "left").join(members, "key", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of a turn table as it is (conv_id, turn, role, text); other columns are ignored."""
    rows = staged(turn_rows(turns), "trie-rows")
    return prefix_trie(rows.select("conv_id"), rows)
