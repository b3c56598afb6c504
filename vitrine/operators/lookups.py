"""Joins and aggregates on the narrow catalog tables: URLs, stock, price, counts, breadcrumbs, ranks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.functions.text import trim_text
from vitrine.functions.urls import absolute_url
from vitrine.operators.overrides import own_or, own_values
from vitrine.operators.stores import store_context
from vitrine.sources.catalog import Catalog

# Rows ranked together: ids of one store that agree above this many low bits.
RANK_BITS = 16


def canonical_paths(catalog: Catalog, entity_type: str | None = None) -> DataFrame:
    """One request path per (store, type, entity): that of the lowest rewrite id.

    ``min_by`` combines before the shuffle, so an entity with very many rewrites stays one row per task.
    """
    rewrites, keys = catalog.scan_rewrites(), ["store_id", "entity_type", "entity_id"]
    if entity_type is not None:
        # Grouped by the later join's keys alone, so that join needs no further shuffle.
        rewrites, keys = rewrites.where(F.col("entity_type") == entity_type), ["store_id", "entity_id"]
    return rewrites.groupBy(*keys).agg(F.min_by("request_path", "url_rewrite_id").alias("request_path"))


def canonical_urls(catalog: Catalog) -> DataFrame:
    stores = store_context(catalog).select("store_id", "store_code", "link_url")
    return canonical_paths(catalog).join(stores, "store_id").select(
        "store_id", "store_code", "entity_type", "entity_id",
        absolute_url(F.col("link_url"), F.col("request_path")).alias("url"),
    )


def _stock_rows(catalog: Catalog) -> DataFrame:
    """One row per (product, website); of repeated ones the highest status counts."""
    return catalog.scan_stock().groupBy("product_id", "website_id").agg(F.max("stock_status").alias("stock_status"))


def _price_rows(catalog: Catalog) -> DataFrame:
    """One row per (product, group); of repeated ones the lowest prices count, NULL last."""
    tariff = ("group_price", "special_price", "special_from", "special_to")
    order = [F.coalesce(c, F.lit(float("inf"))) for c in tariff[:2]]
    return catalog.prices.groupBy("product_id", "group_id").agg(
        F.min_by(F.struct(*tariff), F.struct(*order, F.col("special_from").isNull(), "special_from", F.col("special_to").isNull(), "special_to")).alias("t")
    ).select("product_id", "group_id", "t.*")


def final_price(base: Column, group: Column, special: Column, start: Column, end: Column, as_of) -> Column:
    """The lowest of base price, group price, and the special price inside its dates; NULLs do not count."""
    now = F.lit(as_of)
    open_now = (start.isNull() | (start <= now)) & (end.isNull() | (end >= now))
    return F.least(base, group, F.when(open_now, special))


TARIFF = ("group_price", "special_price", "special_from", "special_to")


def product_shelf(catalog: Catalog, products: DataFrame | None = None) -> DataFrame:
    """Stock and price rows of each product as short arrays (one entry per website or customer group), with ``products`` (all
    that have any, if not given). A listing picks its own from them after a single join on the product, where joins on
    (product, website) and (product, group) would shuffle it twice more."""
    stock = _stock_rows(catalog).groupBy(F.col("product_id").alias("entity_id")).agg(
        F.collect_list(F.struct("website_id", "stock_status")).alias("_stock")
    )
    shelf = stock if products is None else products.join(stock, "entity_id", "left")
    if catalog.prices is None:
        return shelf.withColumn("_prices", F.lit(None))
    tariffs = _price_rows(catalog).groupBy(F.col("product_id").alias("entity_id")).agg(
        F.collect_list(F.struct("group_id", *TARIFF)).alias("_prices")
    )
    return shelf.join(tariffs, "entity_id", "full" if products is None else "left")


def pick_stock(listing: DataFrame) -> DataFrame:
    """Adds ``in_stock`` of the listing's website; a product without a stock row counts as in stock."""
    own = F.try_element_at(F.filter("_stock", lambda s: s["website_id"] == F.col("website_id")), F.lit(1))
    return listing.withColumn("in_stock", F.coalesce(own["stock_status"] == 1, F.lit(True))).drop("_stock")


def pick_tariff(catalog: Catalog, listing: DataFrame) -> DataFrame:
    """Adds the ``TARIFF`` columns of the listing's customer group, NULL where there is none."""
    if catalog.prices is None:
        nothing = dict(zip(TARIFF, ("double", "double", "timestamp", "timestamp")))
        return listing.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()}).drop("_prices")
    own = F.try_element_at(F.filter("_prices", lambda p: p["group_id"] == F.col("customer_group_id")), F.lit(1))
    picked = listing.withColumn("_own", own)
    return picked.withColumns({c: F.col(f"_own.{c}") for c in TARIFF}).drop("_prices", "_own")


def apply_tariff(catalog: Catalog, listing: DataFrame) -> DataFrame:
    """Replaces base ``price`` by the final price under the ``TARIFF`` columns."""
    price = final_price(F.col("price"), *[F.col(c) for c in TARIFF], catalog.as_of)
    return listing.withColumn("price", price).drop(*TARIFF)


def category_counts(catalog: Catalog) -> DataFrame:
    """Distinct products assigned to each category."""
    return catalog.category_products.groupBy("category_id").agg(F.count_distinct("product_id").alias("product_count"))


def breadcrumbs(catalog: Catalog) -> DataFrame:
    """(entity_id, breadcrumb): names from below the root down, ' > ' between; an unloaded ancestor shows its id."""
    loaded = catalog.scan_categories("name")
    names = loaded.select(
        F.col("root"), F.col("entity_id").alias("ancestor"), trim_text(F.coalesce("name", F.lit(""))).alias("label")
    )
    steps = loaded.select("entity_id", "root", F.posexplode(F.split("path", "/")).alias("pos", "step")).select(
        "entity_id", "root", "pos", F.coalesce(F.col("step").try_cast("long"), F.lit(0)).alias("ancestor")
    )
    shown = steps.where((F.col("ancestor") > 1) & (F.col("ancestor") != F.col("root").try_cast("long")))
    label = F.coalesce("label", F.col("ancestor").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", label.alias("label"))))
    return (
        shown.join(names, ["root", "ancestor"], "left")
        .groupBy("entity_id")
        .agg(F.array_join(F.transform(ordered, lambda s: s["label"]), " > ").alias("breadcrumb"))
    )


def store_breadcrumbs(catalog: Catalog) -> DataFrame:
    """(store_id, entity_id, own_breadcrumb) where a store sets the name or the switch of a category or one above it."""
    own = own_values(catalog.category_values, ("name", "is_active")).select(
        "store_id", F.col("entity_id").alias("ancestor"), F.col("name").alias("own_name"), F.col("is_active").alias("own_is_active"))
    own = own.where(F.col("own_name").isNotNull() | F.col("own_is_active").isNotNull())
    placed = catalog.scan_placed("name", "is_active")
    names = placed.select("root", F.col("entity_id").alias("ancestor"), "name", "is_active")
    steps = placed.select("entity_id", "root", F.posexplode(F.split("path", "/")).alias("pos", "step")).select(
        "entity_id", "root", "pos", F.coalesce(F.col("step").try_cast("long"), F.lit(0)).alias("ancestor"))
    steps = steps.where((F.col("ancestor") > 1) & (F.col("ancestor") != F.col("root").try_cast("long")))
    touched = steps.join(own.select("store_id", "ancestor"), "ancestor").select("entity_id", "store_id").distinct()
    seen = touched.join(steps, "entity_id").join(names, ["root", "ancestor"], "left").join(own, ["store_id", "ancestor"], "left")
    label = F.when(own_or("is_active"), trim_text(F.coalesce(own_or("name"), F.lit(""))))
    label = F.coalesce(label, F.col("ancestor").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", label.alias("label"))))
    return seen.groupBy("store_id", "entity_id").agg(F.array_join(F.transform(ordered, lambda s: s["label"]), " > ").alias("own_breadcrumb"))


def first_per_store(listing: DataFrame, limit: Column) -> DataFrame:
    """The first ``limit`` rows of each store by ``entity_id``; a limit of 0 keeps all.

    A plain ``row_number`` per store would sort a whole store in one task. Here ids are cut into spans
    of ``2 ** RANK_BITS`` (at most that many rows each, as an entity is listed once per store); row counts
    per span give the rank at which a span starts, spans past the limit drop out, and only the span that the
    limit cuts is ranked.
    """
    limited = listing.withColumn("_limit", limit.cast("long"))
    spanned = limited.where(F.col("_limit") > 0).withColumn("_span", F.shiftright("entity_id", RANK_BITS))
    before = F.coalesce(
        F.sum("_rows").over(W.partitionBy("store_id").orderBy("_span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    open_spans = (
        spanned.groupBy("store_id", "_span", "_limit").agg(F.count("*").alias("_rows"))
        .withColumn("_before", before).where(F.col("_before") < F.col("_limit"))
        .select("store_id", "_span", (F.col("_limit") - F.col("_before")).alias("_left"), "_rows")
    )
    opened = spanned.join(open_spans, ["store_id", "_span"])
    in_span = F.row_number().over(W.partitionBy("store_id", "_span").orderBy("entity_id"))
    cut = opened.where(F.col("_rows") > F.col("_left")).withColumn("_rank", in_span).where(F.col("_rank") <= F.col("_left"))
    parts = (limited.where(F.col("_limit") <= 0), opened.where(F.col("_rows") <= F.col("_left")), cut)
    return functools.reduce(DataFrame.unionByName, [part.select(*listing.columns) for part in parts])
