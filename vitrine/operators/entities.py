"""Rows per (format, store, entity): listed, priced, linked and with cleaned text.

The text travels once. Narrow listing rows (ids, URL, price, store attributes) are filtered, ranked and
gathered per entity; the wide entity row then joins them on its id, its text is cleaned once per
cleaning rule, cut once per format, and only then spread over the stores.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import (
    CATEGORY_CAP,
    FORMATS,
    JSONL,
    PAGE_CAP,
    PRODUCT_CAP,
    PRODUCT_SHORT_CAP,
    TEXT_FORMATS,
    VERBOSITY,
)
from vitrine.functions.cleaning import Cleaner
from vitrine.functions.markup import MARKER
from vitrine.functions.text import is_blank, text, trim_text, truncate_words
from vitrine.functions.urls import absolute_url
from vitrine.operators.directives import distinct_values, found_values, tokens_of, values_in, woven
from vitrine.operators.lookups import (
    apply_tariff,
    breadcrumbs,
    canonical_paths,
    category_counts,
    first_per_store,
    pick_stock,
    pick_tariff,
    product_shelf,
    store_breadcrumbs,
)
from vitrine.operators.overrides import (
    CATEGORY_FACTS,
    CATEGORY_TEXTS,
    PRODUCT_FACTS,
    PRODUCT_TEXTS,
    own_facts,
    own_or,
    pick_own,
    text_versions,
)
from vitrine.operators.stores import store_context
from vitrine.sources.catalog import Catalog, shown_product
from vitrine.spark_tools import staged

PAGE_SLOTS = 64
STORE_COLUMNS = ("store_id", "store_code", "store_name", "formats", "rule", "resolve_directives")


def _by_format(values: dict[str, object]) -> Column:
    picked = F.lit(None)
    for fmt, value in values.items():
        picked = F.when(F.col("format") == fmt, F.lit(value)).otherwise(picked)
    return picked


def _listing_stores(catalog: Catalog, include: str, formats: Sequence[str]) -> DataFrame:
    """Stores that show a section in at least one of the formats; ``formats`` is cut to those."""
    wanted = F.array_intersect("formats", F.array(*map(F.lit, formats)))
    return (
        store_context(catalog).where(F.col(include)).withColumn("formats", wanted).where(F.size("formats") > 0)
    )


def memo(catalog: Catalog, name: str, make) -> DataFrame:
    """A narrow listing that several branches of a run read (rows of each format, headings), written once."""
    if name not in catalog.cache:
        catalog.cache[name] = staged(make(), name)
    return catalog.cache[name]


def sold_products(catalog: Catalog, products: DataFrame | None = None) -> DataFrame:
    """(store, product) rows with URL, stock and tariff, before the limit and for every format.

    ``products`` (entity_id and base price, with status and visibility where stores may set them) are those that may be shown;
    without it any linked one counts, with its price and status still to come. What a store sets itself is in ``own_…`` columns.
    """
    stores = _listing_stores(catalog, "include_products", FORMATS).select(
        *STORE_COLUMNS, "website_id", "link_url", "currency", "customer_group_id", "products_under_optional",
        "product_limit", "exclude_out_of_stock",
    )
    shelf = product_shelf(catalog, products)
    sold = catalog.product_stores.join(stores, "store_id").join(shelf, "entity_id", "left" if products is None else "inner")
    if catalog.product_values is not None:
        sold = pick_own(sold, product_facts(catalog), PRODUCT_FACTS)
        if products is not None:
            sold = sold.withColumns({c: own_or(c) for c in ("price", "status", "visibility")}).where(shown_product())
            sold = sold.drop("status", "visibility", *(f"own_{c}" for c in ("price", "status", "visibility")))
    stocked = pick_stock(sold).where(~F.col("exclude_out_of_stock") | F.col("in_stock"))
    rows = pick_tariff(catalog, stocked).drop("website_id", "customer_group_id", "exclude_out_of_stock").join(
        canonical_paths(catalog, "product"), ["store_id", "entity_id"]
    )
    url = absolute_url(F.col("link_url"), F.col("request_path"))
    return rows.withColumn("url", url).drop("request_path", "link_url")


def listed_products(catalog: Catalog) -> DataFrame:
    """(store, product) rows that may be emitted, with final price, before the limit and for every format."""
    return memo(catalog, "listed-products", lambda: apply_tariff(catalog, sold_products(catalog, _offered(catalog))))


def _offered(catalog: Catalog) -> DataFrame:
    return catalog.scan_offered("price", *(() if catalog.product_values is None else ("status", "visibility")))


def product_facts(catalog: Catalog) -> DataFrame:
    return memo(catalog, "own-products", lambda: own_facts(catalog.product_values, PRODUCT_FACTS, PRODUCT_TEXTS))


def category_facts(catalog: Catalog) -> DataFrame:
    return memo(catalog, "own-categories", lambda: own_facts(catalog.category_values, CATEGORY_FACTS, CATEGORY_TEXTS))


def product_versions(catalog: Catalog) -> DataFrame | None:
    return None if catalog.product_values is None else text_versions(catalog.product_values, PRODUCT_TEXTS)


def category_versions(catalog: Catalog) -> DataFrame | None:
    return None if catalog.category_values is None else text_versions(catalog.category_values, CATEGORY_TEXTS)


def with_own_name(rows: DataFrame) -> DataFrame:
    return rows.withColumn("name", own_or("name")).drop("own_name") if "own_name" in rows.columns else rows


def product_listing(catalog: Catalog, formats: Sequence[str] = FORMATS) -> DataFrame:
    """(store, product) rows that get emitted, without any text: the first ones of each store up to its limit."""
    wanted = F.array_intersect("formats", F.array(*map(F.lit, formats)))
    listed = listed_products(catalog).withColumn("formats", wanted).where(F.size("formats") > 0)
    return first_per_store(listed, F.col("product_limit")).drop("product_limit")


def category_listing(catalog: Catalog, formats: Sequence[str] = FORMATS) -> DataFrame:
    return memo(catalog, "listed-categories-" + "-".join(formats), lambda: _listed_categories(catalog, formats))


def _listed_categories(catalog: Catalog, formats: Sequence[str]) -> DataFrame:
    stores = _listing_stores(catalog, "include_categories", formats).select(
        *STORE_COLUMNS, "link_url", F.col("root_category_id").cast("string").alias("root")
    )
    named = trim_text(text(F.col("name"))) != ""
    if catalog.category_values is None:
        shown = catalog.scan_categories("name").where(named).select("entity_id", "root").join(stores, "root")
    else:
        placed = catalog.scan_placed("name", "is_active").drop("path", "position").join(stores, "root")
        shown = pick_own(placed, category_facts(catalog), CATEGORY_FACTS)
        shown = shown.withColumns({"name": own_or("name"), "is_active": own_or("is_active")}).where(F.col("is_active") & named)
        shown = shown.drop("name", "is_active").join(store_breadcrumbs(catalog), ["store_id", "entity_id"], "left")
    return (
        shown
        .join(canonical_paths(catalog, "category"), ["store_id", "entity_id"])
        .withColumn("url", absolute_url(F.col("link_url"), F.col("request_path")))
        .drop("request_path", "link_url", "root")
    )


def page_listing(catalog: Catalog, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Pages linked to the store (or to store 0, which means all), minus excluded identifiers."""
    return memo(catalog, "listed-pages-" + "-".join(formats), lambda: _listed_pages(catalog, formats))


def _listed_pages(catalog: Catalog, formats: Sequence[str]) -> DataFrame:
    stores = _listing_stores(catalog, "include_pages", formats).select(
        *STORE_COLUMNS, "link_url", "plain_url", "excluded_pages",
    )
    # A page of all stores needs no other link; so each (page, store) comes once and no wide row is compared.
    everywhere = F.bool_or(F.col("store_id") == 0)
    links = catalog.page_stores.groupBy("page_id").agg(F.collect_set("store_id").alias("links"), everywhere.alias("everywhere"))
    linked = catalog.scan_pages("identifier").join(links, "page_id").withColumnRenamed("page_id", "entity_id")
    some = linked.where(~F.col("everywhere")).select("entity_id", "identifier", F.explode("links").alias("store_id")).join(stores, "store_id")
    # Pages of all stores meet all stores by nature; slots keep that from being one key.
    slot = F.pmod("entity_id", F.lit(PAGE_SLOTS)).cast("int")
    slots = stores.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(PAGE_SLOTS - 1))))
    every = linked.where("everywhere").select("entity_id", "identifier", slot.alias("_slot")).join(slots, "_slot").drop("_slot")
    shown = some.unionByName(every).where(~F.array_contains("excluded_pages", F.coalesce("identifier", F.lit(""))))
    rewritten = shown.join(
        canonical_paths(catalog, "cms-page"), ["store_id", "entity_id"], "left"
    )
    plain = F.concat("plain_url", F.lit("/"), text(F.col("identifier")))
    return rewritten.withColumn(
        "url", F.coalesce(absolute_url(F.col("link_url"), F.col("request_path")), plain)
    ).drop("request_path", "link_url", "plain_url", "excluded_pages", "identifier")


def _grouped(listing: DataFrame, *keys: str) -> DataFrame:
    """The stores of each entity, grouped by what can make its text differ: cleaning rule and directive switch."""
    switches = ["rule", "resolve_directives"]
    per_rule = listing.groupBy(*keys, *switches).agg(
        F.collect_list(F.struct(*[c for c in listing.columns if c not in keys and c not in switches])).alias("stores")
    )
    return per_rule.groupBy(*keys).agg(F.collect_list(F.struct(*switches, "stores")).alias("_groups"))


def _versioned(listing: DataFrame, versions: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The same for each version of an entity's texts, and all its versions in one row, so that its default texts meet them in one join."""
    held = [F.col(t) if t in versions.columns else F.lit(None).cast("struct<value:string>").alias(t) for t in texts]
    named = versions.select("entity_id", "version", F.struct(*held).alias("_set"))
    rows = _grouped(listing, "entity_id", "version").join(named, ["entity_id", "version"], "left")
    return rows.groupBy("entity_id").agg(F.collect_list(F.struct("_set", "_groups")).alias("_versions"))


def _variants(marked: Column, has_directive: Column) -> Column:
    """The cleaned versions of a text, each with the stores that use it.

    A text without marked elements reads the same under every rule, and one without directives the same in every store; so most
    texts have one version, and it is cleaned once. A directive's value may bring marked elements, so its version keeps the rule.
    """
    def version(rule, store_id, stores):
        return F.struct(F.lit(rule).cast("string").alias("rule") if rule is None else rule.alias("rule"),
                        F.lit(None).cast("long").alias("store_id") if store_id is None else store_id.alias("store_id"), stores.alias("stores"))

    def of(group: Column) -> Column:
        own = F.transform(group["stores"], lambda s: version(group["rule"], s["store_id"], F.array(s)))
        return F.when(has_directive & group["resolve_directives"], own).otherwise(F.array(version(group["rule"], None, group["stores"])))

    one = F.array(version(None, None, F.flatten(F.transform("_groups", lambda g: g["stores"]))))
    return F.when(marked | has_directive, F.flatten(F.transform("_groups", of))).otherwise(one)


def spread_clean(
    catalog: Catalog,
    entities: DataFrame,
    listing: DataFrame,
    primary: str,
    fallback: str,
    formats: Sequence[str] = FORMATS,
    caps: dict[str, int] | None = None,
    short_cap: int | None = None,
    fallback_in: Sequence[str] = TEXT_FORMATS,
    both_in: Sequence[str] = (),
    cleaner: Cleaner | None = None,
    versions: DataFrame | None = None,
    once: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows per (format, store, entity) with ``body`` and ``short``.

    ``body`` is the cleaned ``primary``; in formats of ``fallback_in`` it is ``fallback`` where the primary
    is blank. In formats of ``both_in``, ``body`` is ``fallback`` and ``short`` the primary.
    ``versions`` are texts that stores set in place of the default ones; the listing then tells the ``version`` of each row.
    ``once`` adds columns to the cleaned texts before they spread over the stores.
    """
    cleaner = cleaner or Cleaner()
    both = [f for f in formats if f in both_in]
    per_entity = _grouped(listing, "entity_id") if versions is None else _versioned(listing, versions, (primary, fallback))
    directives = directive_values(catalog)
    if directives is not None:
        per_entity = per_entity.join(_found_values(entities, listing, directives, (primary, fallback), versions), "entity_id", "left")
    rows = entities.join(cleaner.with_skips(per_entity), "entity_id")
    if versions is not None:
        rows = rows.withColumn("_version", F.explode("_versions"))
        own = {t: F.when(F.col(f"_version._set.{t}").isNotNull(), F.col(f"_version._set.{t}.value")).otherwise(F.col(t)) for t in (primary, fallback)}
        rows = rows.withColumns({**own, "_groups": F.col("_version._groups")}).drop("_versions", "_version")
    rows = rows.withColumns({
        "_use_fallback": is_blank(F.col(primary)),
        "_primary": text(F.col(primary)),
        "_fallback": text(F.col(fallback)) if both else F.when(is_blank(F.col(primary)), text(F.col(fallback))),
    }).drop(primary, fallback)
    columns = ["_primary", "_fallback"]

    def either_contains(needle: str) -> Column:
        return F.col("_primary").contains(needle) | F.coalesce(F.col("_fallback").contains(needle), F.lit(False))

    # Without a value for any of its directives, a text reads the same in every store.
    known = F.lit(False) if directives is None else F.col("_found").isNotNull()
    rows = rows.withColumns({"_marked": either_contains(MARKER), "_has": known & either_contains("{{")})
    rows = rows.withColumn("_variant", F.explode(_variants(F.col("_marked"), F.col("_has")))).drop("_groups")
    if directives is not None:
        own = F.when(F.col("_variant.store_id").isNotNull(), values_in(F.col("_variant.store_id")))
        rows = rows.withColumn("_values", own).drop("_found")
        rows = rows.withColumns({c: woven(c, F.col("_values")) for c in columns}).drop("_values")
    rule = F.coalesce("_variant.rule", F.lit("preserve|"))
    rows = cleaner.shared(rows, columns, rule)

    offered = F.array_intersect(
        F.flatten(F.transform("_variant.stores", lambda s: s["formats"])), F.array(*map(F.lit, formats))
    )
    rows = rows.withColumn("format", F.explode(offered))
    with_both = F.col("format").isin(*both) if both else F.lit(False)
    falls_back = F.col("format").isin(*fallback_in) & F.col("_use_fallback") if fallback_in else F.lit(False)
    rows = rows.withColumns({
        "body": F.when(with_both | falls_back, F.col("_fallback")).otherwise(F.col("_primary")),
        "short": F.when(with_both, F.col("_primary")),
    }).drop(*columns)
    rows = cleaner.per_format(rows, ["body", "short"], rule, _by_format(VERBOSITY))
    if caps:
        rows = rows.withColumn("body", truncate_words(F.col("body"), _by_format(caps)))
    if short_cap:
        rows = rows.withColumn("short", truncate_words(F.col("short"), short_cap))

    if once is not None:
        rows = once(rows)
    here = F.filter("_variant.stores", lambda s: F.array_contains(s["formats"], F.col("format")))
    own = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(*own, F.inline(here)).drop("formats")


def directive_values(catalog: Catalog) -> DataFrame | None:
    if catalog.directives is None:
        return None
    return memo(catalog, "directives", lambda: distinct_values(catalog.directives))


def _found_values(
    entities: DataFrame, listing: DataFrame, values: DataFrame, texts: Sequence[str], versions: DataFrame | None
) -> DataFrame:
    """Values of the directives in each entity's texts, for the stores that list it and resolve directives."""
    asked = entities.select("entity_id", F.explode(tokens_of(*map(F.col, texts))).alias("token"))
    if versions is not None:
        own = [F.col(f"{t}.value") for t in texts if t in versions.columns]
        asked = asked.unionByName(versions.select("entity_id", F.explode(tokens_of(*own)).alias("token")))
    stores = listing.where("resolve_directives").select("entity_id", "store_id")
    return found_values(asked.distinct().join(stores, "entity_id"), values)


def product_rows(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    entities = catalog.scan_offered("sku", "name", "short_description", "description")
    return with_own_name(spread_clean(
        catalog, entities, product_listing(catalog, formats), "short_description", "description", formats,
        PRODUCT_CAP, PRODUCT_SHORT_CAP, both_in=(JSONL,), cleaner=cleaner, versions=product_versions(catalog),
    ))


def category_rows(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    scan = catalog.scan_categories if catalog.category_values is None else catalog.scan_placed
    entities = scan("name", "description", "meta_description").drop("path", "root")
    if tuple(formats) != (JSONL,):
        counts = category_counts(catalog).withColumnRenamed("category_id", "entity_id")
        entities = (
            entities.join(breadcrumbs(catalog), "entity_id", "left").join(counts, "entity_id", "left")
            .withColumn("product_count", F.coalesce("product_count", F.lit(0).cast("long")))
        )
    else:
        entities = entities.withColumns({
            "breadcrumb": F.lit(None).cast("string"), "product_count": F.lit(None).cast("long")
        })
    rows = with_own_name(spread_clean(
        catalog, entities, category_listing(catalog, formats), "description", "meta_description",
        formats, CATEGORY_CAP, cleaner=cleaner, versions=category_versions(catalog),
    ).drop("short"))
    if catalog.category_values is None:
        return rows
    return rows.withColumn("breadcrumb", F.coalesce("own_breadcrumb", "breadcrumb")).drop("own_breadcrumb")


def page_rows(
    catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None, once: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    entities = catalog.scan_pages(
        "title", "identifier", "content", "meta_description", F.col("sort_order").alias("position")
    ).withColumnRenamed("page_id", "entity_id")
    return spread_clean(
        catalog, entities, page_listing(catalog, formats), "content", "meta_description",
        formats, PAGE_CAP, cleaner=cleaner, once=once,
    ).drop("short")
