"""URL and output-name functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import FILE_EXTENSION, FILE_STEM, FORMATS

# fixed values: file names that a document request ends with
DOCUMENT_NAMES = ("llms.txt", "llms-full.txt", "llms.jsonl", "llms-full.jsonl")


def plain_base_url(base_url: Column) -> Column:
    return F.rtrim(base_url, F.lit("/"))


def store_base_url(base_url: Column, store_code: Column, append_code: Column, is_default: Column) -> Column:
    base = plain_base_url(base_url)
    return F.when(append_code & ~is_default, F.concat_ws("/", base, store_code)).otherwise(base)


def absolute_url(base: Column, path: Column) -> Column:
    return F.concat(base, F.lit("/"), F.ltrim(path, F.lit("/")))


def output_name(fmt: Column, store_code: Column) -> Column:
    """``{stem}_{store}.{extension}``"""
    stem = F.lit(None).cast("string")
    extension = F.lit(None).cast("string")
    for name in FORMATS:
        stem = F.when(fmt == name, FILE_STEM[name]).otherwise(stem)
        extension = F.when(fmt == name, FILE_EXTENSION[name]).otherwise(extension)
    return F.concat(stem, F.lit("_"), store_code, F.lit("."), extension)


def route_class(path: Column) -> Column:
    """'document' for the four served names, 'mirror' for ``*.md``, else NULL. Takes a URL path."""
    trimmed = F.btrim(path, F.lit("/"))
    tail = F.substring_index(trimmed, "/", -1)
    return F.when(tail.isin(*DOCUMENT_NAMES), "document").when(tail.endswith(".md"), "mirror")


def url_path(url: Column) -> Column:
    """The path part of a URL; a bare path is returned as it is."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
