"""From blocks to documents: sizes, counts, order and files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import CLOSING_POS, HEADING_POS
from vitrine.functions.text import without_last_newline
from vitrine.spark_tools import SMALL_FILES, freed_shuffles

FILE_BYTES = 128 << 20
ORDER = ("store_code", "section_ord", "position", "entity_id")


def document_sizes(blocks: DataFrame) -> DataFrame:
    """Bytes and items of each document; of staged blocks the text is not read for it."""
    size = F.col("text_bytes") if "text_bytes" in blocks.columns else F.octet_length("text")
    sized = blocks.select("store_code", "format", "items", size.alias("text_bytes"))
    return sized.where(F.col("text_bytes") > 0).groupBy("store_code", "format").agg(
        F.sum("text_bytes").alias("byte_size"), F.sum("items").alias("item_count")
    )


def block_print() -> Column:
    """Hash of a block's text and of its place in the document."""
    return F.xxhash64("section_ord", "position", "entity_id", "text")


def document_prints(blocks: DataFrame) -> DataFrame:
    """(store_code, format, fingerprint, byte_size) of staged blocks: equal for equal documents, in whatever order their blocks are stored."""
    total = F.sum(F.col("text_print").cast("decimal(20,0)")).cast("string")
    return blocks.where(F.col("text_bytes") > 0).groupBy("store_code", "format").agg(
        total.alias("fingerprint"), F.sum("text_bytes").alias("byte_size")
    )


def section_counts(blocks: DataFrame) -> DataFrame:
    """Entities per document and section; headings and closing lines do not count."""
    entity = ~F.col("position").isin(HEADING_POS, CLOSING_POS)
    return blocks.where(entity).groupBy("store_code", "format", "section_ord").agg(F.count("*").alias("entities"))


def write_documents(blocks: DataFrame, path: str, partitions: int | None = None, file_rows: int | None = None, compression: str = "none") -> None:
    """One folder per store, whose part files in name order are the document.

    The blocks are range-partitioned on the full document order, so a very large store spreads over
    many tasks; unless ``partitions`` is given, their number follows from the bytes. Write one format per call: the
    partition column must not be a literal, or the writer sorts again and loses the order inside a store. Range partitioning
    samples its input first, so pass blocks that were staged, not ones still to be rendered. ``file_rows`` limits the blocks of a part file.
    Documents that get published under their own names must stay plain; others may be written with a ``compression``.
    """
    keys = [F.col(c) for c in ORDER]
    if partitions is None:
        size = F.col("text_bytes") if "text_bytes" in blocks.columns else F.octet_length("text")
        total = blocks.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0
        partitions = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / FILE_BYTES))
    ranged = blocks.repartitionByRange(partitions, *keys)
    lines = ranged.sortWithinPartitions(*keys).select("store_code", without_last_newline(F.col("text")).alias("value"))
    writer = lines.write.mode("overwrite").partitionBy("store_code")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows).options(**SMALL_FILES)
    with freed_shuffles(blocks.sparkSession):
        writer.text(path, compression=compression, lineSep="\n")
