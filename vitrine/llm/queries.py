"""The registered queries of the subpackage: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import chats, decontaminate, earlier_text, hard_negatives, languages, licenses, mixing, near_dups, prefix_trie, quality
from vitrine.llm import secret_scan, substrings, urls
from vitrine.spark_tools import staged


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_report(licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text")))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    model = languages.train(docs.where(languages.fold(F.col("doc_id")) != 2))
    found = languages.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(languages.fold(F.col("doc_id")) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("lang_spans").cast("long").alias("n_spans"))


def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chats.format_chats(table(spark, sf, "conversations"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.secrets_report(secret_scan.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))).drop("text")


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf, "documents").select("doc_id", "source", "text")).drop("source")


def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages").select("page_id", "url"))


def op8_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf, "documents"), n=3, p=90, q=100)


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.scan_benchmark(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        decontaminate.items_digest("hit_items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(prefix_trie.turn_rows(table(spark, sf, "conversations")), "trie-rows")
    return prefix_trie.prefix_trie(*prefix_trie.crossed(rows))


def op12_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return earlier_text.remove_earlier(table(spark, sf, "documents").select("doc_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine_hard_negatives(table(spark, sf, "embeddings"), label=label)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_chat_format": op3_chat_format,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_mix_sources": op8_mix_sources,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
