"""Records as entity files arrive, in place of a full run.

Each micro-batch goes through the same steps as the batch jobs, with the listing from the tables: links, URLs, stock and tariffs. Name,
texts, price, status and visibility come with the row, so a product that no table has yet gets its records. Ordering and the
per-store limit stay matters of a full run. Removals and versions: see ``changelog``.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vitrine.constants import CATEGORY_CAP, JSONL, PAGE_CAP, PRODUCT_CAP, PRODUCT_SHORT_CAP
from vitrine.functions.cleaning import Cleaner
from vitrine.functions.text import trim_text
from vitrine.operators.blocks import category_record, json_line, page_record, product_record
from vitrine.operators.entities import (
    category_listing,
    category_versions,
    memo,
    page_listing,
    product_versions,
    sold_products,
    spread_clean,
    with_own_name,
)
from vitrine.operators.lookups import apply_tariff
from vitrine.operators.overrides import own_or
from vitrine.sources.catalog import Catalog, shown_product
from vitrine.spark_tools import freed_shuffles, staged, unsorted_writes

KINDS = ("product", "category", "page")


def entity_key(kind: str) -> str:
    return "page_id" if kind == "page" else "entity_id"


def records_of(
    catalog: Catalog, kind: str, entities: DataFrame, cleaner: Cleaner | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """JSONL records (store_code, value) of a table of product, category or page rows, with the columns to ``keep``."""
    extra = [c for c in keep if c != "entity_id"]
    settings = {"formats": (JSONL,), "cleaner": cleaner}
    if kind == "product":
        # A store's own status or visibility decides after the row has met the stores.
        switches = () if catalog.product_values is None else ("status", "visibility")
        shown = entities if switches else entities.where(shown_product())
        listing = memo(catalog, "sold-products", lambda: sold_products(catalog)).where(F.array_contains("formats", JSONL))
        rows = spread_clean(
            catalog, shown.select("entity_id", "sku", "name", "price", "short_description", "description", *switches, *extra),
            listing.drop("product_limit"), "short_description", "description",
            caps=PRODUCT_CAP, short_cap=PRODUCT_SHORT_CAP, both_in=(JSONL,), versions=product_versions(catalog), **settings,
        )
        if switches:
            rows = with_own_name(rows.withColumns({c: own_or(c) for c in ("price", *switches)}).where(shown_product()))
        rows = apply_tariff(catalog, rows)
        record = product_record()
    elif kind == "category":
        named = F.col("is_active") & (trim_text(F.col("name")) != "")
        own = catalog.category_values is not None
        rows = spread_clean(
            catalog, (entities if own else entities.where(named)).select(
                "entity_id", "name", "is_active", "description", "meta_description", *extra),
            category_listing(catalog, (JSONL,)), "description", "meta_description", caps=CATEGORY_CAP, versions=category_versions(catalog), **settings,
        )
        if own:
            rows = with_own_name(rows).withColumn("is_active", own_or("is_active")).where(named)
        record = category_record()
    elif kind == "page":
        titled = entities.where(F.col("is_active") & (trim_text(F.col("title")) != ""))
        rows = spread_clean(
            catalog, titled.select(F.col("page_id").alias("entity_id"), "title", "identifier", "content", "meta_description", *extra),
            page_listing(catalog, (JSONL,)), "content", "meta_description", caps=PAGE_CAP, **settings,
        )
        record = page_record()
    else:
        raise ValueError(f"kind must be one of {KINDS}")
    return rows.select("store_code", json_line(record).alias("value"), *keep)


def write_stream(
    catalog: Catalog, kind: str, entities: DataFrame, out: str, checkpoint: str, cleaner: Cleaner | None = None
) -> StreamingQuery:
    """Write the records of the entity rows that have arrived on a stream since the last call to ``{out}/version=…/store_code=…``, then stop.

    The version is the batch number: of several records of an entity that of the highest version is current. A batch that is
    run again after a failure writes its folder anew. The files are gzipped lines, as every store repeats the texts.
    """
    def write(batch: DataFrame, number: int) -> None:
        records = records_of(catalog, kind, batch, cleaner)
        with freed_shuffles(records.sparkSession), unsorted_writes(records.sparkSession):
            records.write.mode("overwrite").option("compression", "gzip").partitionBy("store_code").text(f"{out.rstrip('/')}/version={number}")

    return (
        entities.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def current_records(spark: SparkSession, out: str) -> DataFrame:
    """(store_code, value) of the latest version of each entity's record."""
    lines = spark.read.option("basePath", out).schema("value string, version long, store_code string").text(f"{out.rstrip('/')}/version=*")
    keys = ("store_code", "kind", "entity")
    rows = lines.withColumns({"kind": F.get_json_object("value", "$.entity_type"), "entity": F.get_json_object("value", "$.entity_id")})
    # Only records of entities that came again are compared; the text of the others is not moved.
    again = staged(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*(F.col(k).alias(f"_{k}") for k in keys)), "again")
    came_again = functools.reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    latest = rows.join(again, came_again, "left_semi").groupBy(*keys).agg(F.max_by("value", "version").alias("value"))
    return rows.join(again, came_again, "left_anti").select("store_code", "value").unionByName(latest.select("store_code", "value"))
