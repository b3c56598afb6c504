"""Filters by a bitmap of fixed size, before a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bits per row: 8 MB, however many keys are marked.
SLOTS, SLOT_BITS = 2048, 32768


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` isn't in ``wanted`` (a table, as it is read again by the join that follows).

    The broadcast bitmap has its size for any number of keys; when it fills up, fewer rows drop out, and results stay the same.
    """
    place = F.pmod(F.xxhash64(key), F.lit(SLOTS * SLOT_BITS))
    slot, at = F.floor(place / SLOT_BITS), F.pmod(place, F.lit(SLOT_BITS))
    marks = wanted.groupBy(slot.alias("_slot")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = rows.withColumn("_slot", slot).join(F.broadcast(marks), "_slot")
    return held.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_slot", "_bits")
