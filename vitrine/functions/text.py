"""Text functions on columns: trimming, whitespace, word-safe cuts, escapes, embedding text.

Each takes and returns a ``Column``; all are JVM-side expressions. Functions that read their input
more than once expect a plain column reference, so apply them step by step with ``withColumn``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIM_CHARS = " \t\n\r\0\x0b"
ELLIPSIS = "…"

def _run(kind: str) -> str:
    """Runs of blanks of a kind that are not a single space, as that, the most frequent case, stays as it is."""
    return rf"{kind}(?:(?<! )|{kind}){kind}*+"


_ASCII_SPACE = _run(r"[ \t\n\x0B\f\r]")
_ANY_SPACE = _run(r"[\p{Z}\h\v]")
_BLANKS = _run(r"[ \t]")


def text(col: Column) -> Column:
    """NULL reads as the empty string."""
    return F.coalesce(col, F.lit(""))


def trim_text(col: Column) -> Column:
    return F.btrim(col, F.lit(TRIM_CHARS))


def trim_column(col: Column) -> Column:
    """The same for a plain column: Spark's trim first measures all characters of a text, but a look at its ends tells whether it needs any."""
    ends = functools.reduce(Column.__or__, (col.startswith(c) | col.endswith(c) for c in TRIM_CHARS))
    return F.when(ends, trim_text(col)).otherwise(col)


def cut_spaces(col: Column) -> Column:
    """A plain column without one space at each end, cut by bytes: all that a trim of collapsed text mostly has to do."""
    first, last = col.startswith(" ").cast("int"), col.endswith(" ").cast("int")
    cut = F.substring(col.cast("binary"), first + 1, F.octet_length(col) - first - last).cast("string")
    return F.when(col.startswith(" ") | col.endswith(" "), cut).otherwise(col)


def without_last_newline(col: Column) -> Column:
    """Cut by bytes, as counting the characters of a text takes longer than copying it."""
    cut = F.substring(col.cast("binary"), F.lit(1), F.octet_length(col) - 1).cast("string")
    return F.when(col.endswith("\n"), cut).otherwise(col)


def rtrim_text(col: Column) -> Column:
    return F.rtrim(col, F.lit(TRIM_CHARS))


def is_blank(col: Column) -> Column:
    """Blank in fallbacks: NULL, '' and '0'."""
    return col.isNull() | col.isin("", "0")


def first_filled(first: Column, second: Column) -> Column:
    return text(F.when(is_blank(first), second).otherwise(first))


def collapse_ascii(col: Column) -> Column:
    return F.regexp_replace(col, _ASCII_SPACE, " ")


def collapse_any(col: Column) -> Column:
    return F.regexp_replace(col, _ANY_SPACE, " ")


def one_line(col: Column) -> Column:
    return trim_text(collapse_any(col))


def collapse_lines(col: Column) -> Column:
    """Runs of blanks become one space, three or more newlines become two."""
    blanks = F.when(col.contains("  ") | col.contains("\t"), F.regexp_replace(col, _BLANKS, " ")).otherwise(col)
    return F.when(col.contains("\n\n\n"), F.regexp_replace(blanks, r"\n{3,}", "\n\n")).otherwise(blanks)


def collapse_ws(col: Column, verbosity: Column | str) -> Column:
    """Whitespace as the verbosity wants it, but at the ends."""
    if isinstance(verbosity, str):
        return collapse_any(col) if verbosity == "compact" else collapse_lines(col)
    return F.when(verbosity == "compact", collapse_any(col)).otherwise(collapse_lines(col))


def normalize_ws(col: Column, verbosity: Column | str) -> Column:
    return trim_text(collapse_ws(col, verbosity))


def truncate_words(col: Column, limit: Column | int) -> Column:
    """Cut to ``limit`` code points, at the last space if that lies past 70 % of them, and mark it.

    A limit of NULL or 0 cuts nothing. Characters are counted only where the bytes exceed the limit.
    """
    n = F.lit(limit) if isinstance(limit, int) else limit
    head = F.substring(col, F.lit(1), n)
    tail = F.instr(F.reverse(head), " ")
    at = n - tail
    cut = F.when((tail > 0) & (at > n * F.lit(0.7)), F.substring(head, F.lit(1), at)).otherwise(head)
    return F.when(
        (F.coalesce(n, F.lit(0)) > 0) & (F.octet_length(col) > n) & (F.length(col) > n), F.concat(rtrim_text(cut), F.lit(ELLIPSIS))
    ).otherwise(col)


def escape_markdown(col: Column) -> Column:
    return F.regexp_replace(col, r"([\[\]()|`])", r"\\$1")


def embedding_text(*parts: Column, sep: str = "\n", limit: int = 8000) -> Column:
    joined = F.concat_ws(sep, *[text(p) for p in parts])
    return F.substring(trim_text(joined), 1, limit)
