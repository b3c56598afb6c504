"""A training corpus from raw documents: identified languages, one of each group of near duplicates, no benchmark text, no secrets, mixed.

Every stage takes any columns beside its own, whatever their names, and gives an empty table for an empty one. Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.decontaminate import decontaminate
from vitrine.llm.languages import keep_identified
from vitrine.llm.mixing import mixed_blocks
from vitrine.llm.near_dups import keep_one_each
from vitrine.llm.secret_scan import mask_secrets
from vitrine.spark_tools import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a learned language fits; the model learns from the labelled rows of ``docs``.

    NULL and empty texts, and such without letters, have no language and go; NULL labels teach nothing; repeated rows share their fate.
    """
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by sets of five-word shingles with a similarity of 0.8 or more.

    The smallest id of a group stays, NULL ids last; of repeated rows one; of rows with that id but different texts, one. NULL, empty and
    wordless texts link with nothing and all stay.
    """
    return keep_one_each(docs, n=5, p=80, q=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark.

    An item of fewer words is one window; NULL and wordless items have none. NULL and empty documents stay, repeated ones share their fate.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their text; NULL texts stay NULL, overlapping secrets are one mask."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and parts of documents by source weights, with ``taken`` words, a ``shard`` and a ``place`` in it.

    NULL, empty and wordless texts are never taken; a NULL source is one source, the last. Which of equal rows has the larger share is open.
    Columns of the documents with those three names are replaced.
    """
    return mixed_blocks(docs)


STAGES = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets),
    ("mixing", mixing),
]
#: Language ID learns a model, and the mix draws at random: neither can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
