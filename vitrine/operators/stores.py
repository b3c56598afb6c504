"""Per-store context: resolved settings, eligibility per format, siblings."""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import (
    COMPACT,
    DEFAULT_ALLOWED,
    DEFAULT_EXCLUDED,
    DEFAULT_EXCLUDED_PAGES,
    DEFAULT_SETTINGS,
    FORMATS,
    FULL,
    JSONL,
    PLATFORM_SETTINGS,
)
from vitrine.functions.text import one_line, text, trim_text
from vitrine.functions.urls import output_name, plain_base_url, store_base_url
from vitrine.functions.values import bcp47, flag, leading_int, parse_list
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import staged

PATHS = (*DEFAULT_SETTINGS, *PLATFORM_SETTINGS)


def resolved_settings(catalog: Catalog, paths=PATHS) -> DataFrame:
    """(store_id, path, value): the store's own value, else its website's, else the default one.

    Each store offers its three scopes as rows, so the lookup is one equi-join, and the most specific
    row wins in a pre-aggregating ``max_by``.
    """
    def scope(name: str, scope_id: Column, rank: int) -> Column:
        return F.struct(F.lit(name).alias("scope"), scope_id.cast("long").alias("scope_id"), F.lit(rank).alias("rank"))

    scopes = catalog.stores.select("store_id", F.inline(F.array(
        scope("default", F.lit(0), 0),
        scope("websites", F.col("website_id"), 1),
        scope("stores", F.col("store_id"), 2),
    )))
    wanted = catalog.settings.where(F.col("path").isin(*paths))
    return (
        wanted.join(scopes, ["scope", "scope_id"])
        .groupBy("store_id", "path")
        .agg(F.max_by("value", "rank").alias("value"))
    )


def scoped_settings(catalog: Catalog) -> DataFrame:
    """One row per store with every setting typed, floored and defaulted."""
    wide = resolved_settings(catalog).groupBy("store_id").pivot("path", list(PATHS)).agg(F.first("value"))
    raw = catalog.stores.select("store_id").join(wide, "store_id", "left")

    def v(path: str) -> Column:
        return F.col(f"`{path}`")

    strategy = text(v("sanitizer/page_builder_strategy"))
    excluded = F.concat_ws(",", parse_list(v("sanitizer/page_builder_excluded_types")))
    allowed = F.concat_ws(",", parse_list(v("sanitizer/page_builder_allowed_types")))
    strategy = F.when(strategy == "", "preserve").otherwise(strategy)
    # The usual lists stay implicit, so a rule is a short string on every listing row.
    listed = (
        F.when((strategy == "exclude") & (excluded != ",".join(DEFAULT_EXCLUDED)), excluded)
        .when((strategy == "allow") & (allowed != ",".join(DEFAULT_ALLOWED)), allowed).otherwise("")
    )
    page_ids = v("content/cms_exclude_identifiers")
    return raw.select(
        "store_id",
        flag(v("general/enabled")).alias("enabled"),
        flag(v("general/exclude_store")).alias("is_excluded"),
        trim_text(text(v("general/store_summary"))).alias("store_summary"),
        flag(v("content/include_categories")).alias("include_categories"),
        flag(v("content/include_cms")).alias("include_pages"),
        flag(v("content/include_products")).alias("include_products"),
        flag(v("content/products_under_optional")).alias("products_under_optional"),
        F.greatest(leading_int(v("content/product_limit")), F.lit(0)).alias("product_limit"),
        flag(v("content/exclude_out_of_stock")).alias("exclude_out_of_stock"),
        F.when(text(page_ids) == "", F.array(*map(F.lit, DEFAULT_EXCLUDED_PAGES)))
        .otherwise(parse_list(page_ids)).alias("excluded_pages"),
        leading_int(v("content/customer_group_id")).alias("customer_group_id"),
        flag(v("formats/generate_llms_txt")).alias("compact_enabled"),
        flag(v("formats/generate_llms_full_txt")).alias("full_enabled"),
        flag(v("formats/generate_jsonl")).alias("jsonl_enabled"),
        flag(v("formats/generate_md_mirror")).alias("mirror_enabled"),
        flag(v("sanitizer/resolve_directives")).alias("resolve_directives"),
        F.concat_ws("|", strategy, listed).alias("rule"),
        F.when(leading_int(v("http/cache_ttl_seconds")) > 0, leading_int(v("http/cache_ttl_seconds")))
        .otherwise(3600).alias("cache_ttl_seconds"),
        flag(v("url/append_store_code")).alias("append_store_code"),
        bcp47(v("general/locale/code")).alias("locale"),
        text(v("general/country/default")).alias("country_code"),
        text(v("design/head/default_description")).alias("meta_description"),
    )


def globally_enabled(catalog: Catalog) -> DataFrame:
    """One row (enabled) holding the default-scope switch."""
    switch = (F.col("path") == "general/enabled") & (F.col("scope") == "default")
    return catalog.settings.where(switch).agg(F.coalesce(F.bool_or(flag(F.col("value"))), F.lit(False)).alias("enabled"))


def store_context(catalog: Catalog) -> DataFrame:
    """One row per store: identity, URLs, money, locale, settings and the formats it gets.

    Written once and kept for the other jobs of the same catalog, which broadcast it where its bytes allow.
    """
    if "context" in catalog.cache:
        return catalog.cache["context"]
    settings = scoped_settings(catalog)
    on = bool(globally_enabled(catalog).first()["enabled"])
    eligible = F.col("is_active") & ~F.col("is_excluded") & F.lit(on)
    formats = F.array(
        F.when(F.col("compact_enabled"), F.lit(COMPACT)),
        F.when(F.col("full_enabled"), F.lit(FULL)),
        F.when(F.col("jsonl_enabled"), F.lit(JSONL)),
    )
    currency = text(F.col("currency_code"))
    context = catalog.stores.join(settings, "store_id").withColumns({
        "globally_enabled": F.lit(on),
        "currency": F.when(currency == "", F.col("default_currency_code")).otherwise(currency),
        "formats": F.when(eligible, F.array_compact(formats)).otherwise(F.array().cast("array<string>")),
        "plain_url": plain_base_url(F.col("base_url")),
        "link_url": store_base_url(F.col("base_url"), F.col("store_code"), F.col("append_store_code"), F.col("is_default")),
    })
    catalog.cache["context"] = staged(context, "stores")
    return catalog.cache["context"]


def restricted(catalog: Catalog, *codes: str) -> Catalog:
    """The same catalog with only some stores to produce for; the others stay as siblings."""
    context = store_context(catalog)
    mine = F.when(F.col("store_code").isin(*codes), F.col("formats")).otherwise(F.array().cast("array<string>"))
    other = copy.copy(catalog)
    other.cache = {"context": context.withColumn("formats", mine)}
    return other


def eligibility_plan(catalog: Catalog, formats=FORMATS, code: str | None = None) -> DataFrame:
    """What to do per store and format: generate, or delete what an earlier run left; nothing when switched off."""
    stores = store_context(catalog).where("globally_enabled")
    if code is not None:
        stores = stores.where(F.col("store_code") == code)
    each = stores.select("store_id", "store_code", F.explode(F.array(*map(F.lit, formats))).alias("format"), "formats")
    action = F.when(F.array_contains("formats", F.col("format")), "generate").otherwise("delete")
    return each.select(
        "store_id", "store_code", "format", action.alias("action"),
        output_name(F.col("format"), F.col("store_code")).alias("file_name"),
    )


def with_country(catalog: Catalog, stores: DataFrame) -> DataFrame:
    """Adds ``country``: its name, else the code."""
    if catalog.countries is None:
        return stores.withColumn("country", F.col("country_code"))
    names = catalog.countries.select(F.col("code").alias("country_code"), F.col("name").alias("country_name"))
    shown = F.coalesce(F.when(text(F.col("country_name")).isin("", "0"), None).otherwise(F.col("country_name")),
                       F.col("country_code"))
    return stores.join(names, "country_code", "left").withColumn("country", shown).drop("country_name")


def store_summary(stores: DataFrame) -> DataFrame:
    """Adds ``summary``: the store's own, else its meta description, else a generic line."""
    generic = F.concat(F.lit("Online store — "), F.col("currency"), F.lit(", "), F.col("locale"))
    own, meta = F.col("store_summary"), F.col("meta_description")
    return stores.withColumn(
        "summary", F.when(own != "", one_line(own)).when(trim_text(meta) != "", one_line(meta)).otherwise(generic)
    )


def sibling_stores(catalog: Catalog) -> DataFrame:
    """Pairs (store, sibling): another active, not excluded store of the same website."""
    context = store_context(catalog)
    others = context.where(F.col("is_active") & ~F.col("is_excluded")).select(
        "website_id",
        F.col("store_id").alias("sibling_id"),
        F.col("store_name").alias("sibling_name"),
        F.concat("link_url", F.lit("/llms.txt")).alias("sibling_url"),
    )
    mine = context.select("website_id", "store_id", "store_code", "website_name", "formats")
    return mine.join(others, "website_id").where(F.col("store_id") != F.col("sibling_id"))
