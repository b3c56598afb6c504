"""Chat formatting: logged snapshots of one conversation collapse to the longest, then each is rendered.

Turns stay rows until the conversations that go on are known: they are numbered and hashed by range, so a conversation of any length spreads
over tasks, and only narrow rows of hashes are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.spark_tools import staged

#: Marks of the rendered form.
TURN_OPEN, TURN_CLOSE = "<|{}|>\n", "<|end|>\n"
#: Independent 64-bit halves of a prefix hash.
LANES = (1, 2)


def hashed_turns(turns: DataFrame) -> DataFrame:
    """Turns as rows (``conv_id``, ``pos`` from 0, ``role``, ``text``) with the rolling hash of their conversation up to and with them.

    Ordered by turn number (NULL first), then role and text; repeated equal rows count once. Rows without a conversation id belong to
    no conversation. A turn's hash depends on its place, and the hash of a prefix is the exclusive or of its turns', so that parts of a
    conversation are hashed by themselves and then put together.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("_")).drop("_")
    order = ["conv_id", "turn", "role", "text"]
    # Short keys in the same order as the rows.
    short = F.when(F.coalesce(F.char_length("role"), F.lit(0)) <= 32, F.left("text", F.lit(64)))
    spread = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), F.asc_nulls_first(F.left("role", F.lit(32))), F.asc_nulls_first(short))
    spread = spread.sortWithinPartitions(*(F.asc_nulls_first(c) for c in order)).withColumn("seq", F.monotonically_increasing_id())
    placed = staged(spread.select("conv_id", "seq", F.shiftright("seq", 33).alias("part"), "role", "text"), "chat-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("conv_id", "part").agg(F.min("seq").alias("begin"), F.count("*").alias("n"))
    counts = counts.withColumn("zero", F.col("begin") - F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    numbered = placed.join(counts.select("conv_id", "part", "zero"), ["conv_id", "part"])
    own = F.struct(F.col("seq") - F.col("zero"), "role", F.col("role").isNull(), "text", F.col("text").isNull())
    within = Window.partitionBy("conv_id", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    running = numbered.withColumns({f"h{i}": F.xxhash64(F.lit(i), own) for i in LANES})
    running = running.withColumns({f"h{i}": F.bit_xor(f"h{i}").over(within) for i in LANES})
    running = staged(running.select("conv_id", "part", (F.col("seq") - F.col("zero")).alias("pos"), "role", "text", *(f"h{i}" for i in LANES)), "chat-hashes")
    ends = running.groupBy("conv_id", "part").agg(*(F.max_by(f"h{i}", "pos").alias(f"e{i}") for i in LANES))
    ends = ends.select("conv_id", "part", *(F.coalesce(F.bit_xor(f"e{i}").over(earlier), F.lit(0).cast("long")).alias(f"e{i}") for i in LANES))
    whole = running.join(ends, ["conv_id", "part"])
    return whole.select("conv_id", "pos", "role", "text", *(F.col(f"h{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"h{i}") for i in LANES))


def maximal(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``n_turns``, ``n_copies``) of conversations that no longer one starts with; of equal ones the smallest id counts."""
    lanes = [f"h{i}" for i in LANES]
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("last"))
    marks = turns.select("conv_id", "pos", *lanes).join(lengths, "conv_id")
    shorter = marks.where("pos < last").select("pos", *lanes).distinct()
    heads = marks.where("pos = last").groupBy("pos", *lanes).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = heads.join(shorter, ["pos", *lanes], "left_anti")
    return kept.select("conv_id", (F.col("pos") + 1).cast("long").alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` and the rendered text; a NULL role reads as ``user``, a NULL text as empty."""
    head, tail = TURN_OPEN.split("{}")
    shown = F.concat(F.lit(head), F.coalesce("role", F.lit("user")), F.lit(tail), F.coalesce("text", F.lit("")), F.lit("\n" + TURN_CLOSE))
    rows = turns.select("conv_id", "pos", shown.alias("shown")).join(kept, "conv_id")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "shown"))), lambda t: t["shown"])
    return rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_join(parts, "").alias("rendered"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations of a turn table (conv_id, turn, role, text), rendered; an empty table gives no rows; other columns are ignored."""
    hashed = staged(hashed_turns(turns.select("conv_id", "turn", "role", "text")), "chats")
    return render(hashed, staged(maximal(hashed), "chats-kept"))
