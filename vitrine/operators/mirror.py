"""Per-entity markdown: requested paths to entities, entities to markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.constants import FULL
from vitrine.functions.cleaning import Cleaner
from vitrine.functions.text import text
from vitrine.functions.values import format_price
from vitrine.operators.entities import (
    STORE_COLUMNS,
    category_facts,
    category_versions,
    product_facts,
    product_versions,
    spread_clean,
    with_own_name,
)
from vitrine.operators.lookups import apply_tariff, pick_tariff, product_shelf
from vitrine.operators.overrides import CATEGORY_FACTS, PRODUCT_FACTS, own_or, pick_own
from vitrine.operators.stores import store_context
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import staged


def mirror_lookup(catalog: Catalog) -> DataFrame:
    """(store_id, path, entity_type, entity_id) for each distinct requested path that leads to an entity.

    Both spellings of a request (as it is, and with '.html') go through one join on (store, path); the
    exact one wins, and a request whose winner redirects leads nowhere.
    """
    stores = store_context(catalog).where(F.col("enabled") & ~F.col("is_excluded") & F.col("mirror_enabled"))
    asked = catalog.requests.where(F.col("path").endswith(".md")).distinct().join(stores.select("store_id"), "store_id")
    bare = F.ltrim(F.expr("left(path, length(path) - 3)"), F.lit("/"))
    spelled = asked.select("store_id", "path", F.posexplode(F.array(bare, F.concat(bare, F.lit(".html")))).alias("rank", "request_path"))
    number = F.col("url_rewrite_id")
    known = catalog.rewrites.select("store_id", "request_path", number.isNull().alias("unnumbered"), number, F.when(
        number.isNotNull(), F.struct("entity_type", "entity_id", "redirect_type")).alias("target"))
    # The lowest rewrite of the first spelling that is known, by one aggregate; without any number it leads nowhere.
    # Few rows share a path, so they are dealt by it first and sorted once.
    found = spelled.join(known, ["store_id", "request_path"]).repartition("store_id", "path").groupBy("store_id", "path").agg(
        F.min_by("target", F.struct("rank", "unnumbered", "url_rewrite_id")).alias("target")
    )
    return found.where(F.col("target.redirect_type") == 0).select("store_id", "path", "target.entity_type", "target.entity_id")


def mirror_render(catalog: Catalog, cleaner: Cleaner | None = None) -> DataFrame:
    """(store_code, path, markdown): uncut full text, whatever the entity's status."""
    stores = store_context(catalog).withColumn("formats", F.array(F.lit(FULL))).select(
        *STORE_COLUMNS, "currency", "customer_group_id"
    )
    # Read once per entity type below.
    targets = staged(mirror_lookup(catalog), "mirror-targets").join(stores, "store_id")

    def listed(kind: str) -> DataFrame:
        return targets.where(F.col("entity_type") == kind).drop("entity_type")

    def body(rows: DataFrame, title: str) -> DataFrame:
        shown = F.concat(F.lit("# "), text(F.col(title)), F.lit("\n\n"),
                         F.when(F.col("body") != "", F.concat("body", F.lit("\n"))).otherwise(""))
        return rows.select("store_code", "path", shown.alias("markdown"))

    settings = {"formats": (FULL,), "fallback_in": (), "cleaner": cleaner}
    products = catalog.products.select("entity_id", "sku", "name", "short_description", "description")
    asked = listed("product").join(product_shelf(catalog, catalog.products.select("entity_id", "price")), "entity_id").drop("_stock")
    if catalog.product_values is not None:
        asked = pick_own(asked, product_facts(catalog), PRODUCT_FACTS).withColumn("price", own_or("price"))
        asked = asked.drop("own_price", "own_status", "own_visibility")
    priced = apply_tariff(catalog, pick_tariff(catalog, asked))
    rows = spread_clean(catalog, products, priced.drop("customer_group_id"), "short_description", "description",
                        both_in=(FULL,), versions=product_versions(catalog), **settings)
    rows = with_own_name(rows)
    short, long = F.col("short"), F.col("body")
    product = rows.select("store_code", "path", F.concat(
        F.lit("# "), text(F.col("name")), F.lit("\n\n> SKU: "), text(F.col("sku")), F.lit(" · Price: "),
        format_price(F.coalesce("price", F.lit(0.0))), F.lit(" "), F.col("currency"), F.lit("\n\n"),
        F.when(short != "", F.concat(short, F.lit("\n\n"))).otherwise(""),
        F.when((long != "") & (long != short), F.concat(long, F.lit("\n"))).otherwise(""),
    ).alias("markdown"))

    shelves = catalog.categories.select("entity_id", "name", "description", F.lit(None).cast("string").alias("_none"))
    pages = catalog.pages.select(F.col("page_id").alias("entity_id"), "title", "content", F.lit(None).cast("string").alias("_none"))
    asked = listed("category")
    if catalog.category_values is not None:
        asked = pick_own(asked, category_facts(catalog), CATEGORY_FACTS).drop("own_is_active")
    rows = spread_clean(catalog, shelves, asked, "description", "_none", versions=category_versions(catalog), **settings)
    category = body(with_own_name(rows), "name")
    page = body(spread_clean(catalog, pages, listed("cms-page"), "content", "_none", **settings), "title")
    return product.unionByName(category).unionByName(page)
