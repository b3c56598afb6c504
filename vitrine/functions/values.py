"""Numbers, dates, flags and lists read from or shown as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import is_blank, trim_text


def flag(col: Column) -> Column:
    """A setting is on unless it is NULL, '' or '0'."""
    return ~is_blank(col)


def leading_int(col: Column) -> Column:
    """The integer a string starts with, else 0; one out of range reads as the nearest in range."""
    digits = F.regexp_extract(col, r"^\s*([+-]?\d+)", 1)
    beyond = F.when(digits.startswith("-"), -(1 << 63)).when(digits != "", (1 << 63) - 1)
    return F.coalesce(digits.try_cast("long"), beyond, F.lit(0))


def parse_list(col: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), "[,\n]"), trim_text)
    return F.filter(parts, lambda p: ~p.isin("", "0"))


def format_price(col: Column) -> Column:
    """Two decimals, a point, no thousands mark; any size of number."""
    # Adding 0.0 turns -0.0 into 0.0.
    return F.call_function("format_number", F.round(col, 2) + 0.0, F.lit("0.00"))


def format_bytes(col: Column) -> Column:
    kb, mb = F.lit(1024), F.lit(1048576)
    return (
        F.when(col >= mb, F.concat(F.format_number(col / mb, 1), F.lit(" MB")))
        .when(col >= kb, F.concat(F.format_number(col / kb, 1), F.lit(" KB")))
        .otherwise(F.concat(col.cast("string"), F.lit(" B")))
    )


def bcp47(col: Column) -> Column:
    return F.when(F.coalesce(col, F.lit("")) == "", "en-US").otherwise(F.translate(col, "_", "-"))


def utc_time(unix_seconds: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(unix_seconds), F.current_timezone()),
                         "yyyy-MM-dd HH:mm:ss")


def iso_time(unix_seconds: Column) -> Column:
    shown = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(unix_seconds), F.current_timezone()),
                          "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(shown, F.lit("+00:00"))
