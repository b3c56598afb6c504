"""A catalog derived from the star-schema test tables, whole tables and whole texts throughout.

Nations are store views and regions are websites; parts joined with documents are products; part types
and brands form the category trees; web pages are content pages. Stock and prices aggregate ``lineitem``.
"""

from __future__ import annotations

import copy
import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.constants import DEFAULT_SETTINGS
from vitrine.functions.urls import url_path
from vitrine.sources.catalog import Catalog
from vitrine.schemas import TABLES
from vitrine.spark_tools import local_rows, staged

AS_OF = dt.datetime(1998, 6, 1)

# fixed values: language by website
LANGUAGE = {1: "fr", 2: "es", 3: "en", 4: "de", 5: "en"}
COUNTRIES = [("US", "United States"), ("FR", "France"), ("DE", "Germany")]

# fixed values: overrides of the shipped settings (path, scope, scope_id, value)
OVERRIDES = [
    ("general/country/default", "default", 0, "US"),
    ("formats/generate_md_mirror", "websites", 1, "1"),
    ("formats/generate_md_mirror", "websites", 3, "1"),
    ("formats/generate_md_mirror", "websites", 4, "1"),
    ("general/locale/code", "websites", 1, "fr_FR"),
    ("general/locale/code", "websites", 2, "es_MX"),
    ("general/locale/code", "websites", 3, ""),
    ("general/locale/code", "websites", 4, "de_DE"),
    ("general/locale/code", "websites", 5, "en_GB"),
    ("general/country/default", "websites", 1, "FR"),
    ("general/country/default", "websites", 4, "DE"),
    ("general/country/default", "websites", 5, "ZZ"),
    ("general/exclude_store", "stores", 6, "1"),
    ("general/exclude_store", "stores", 20, "1"),
    ("general/store_summary", "websites", 1, "  Summary  of the\tshop "),
    ("general/store_summary", "stores", 4, "Summary of one store"),
    ("design/head/default_description", "websites", 5, " Fine goods \n for all "),
    ("content/product_limit", "stores", 3, "40"),
    ("content/product_limit", "stores", 4, "12abc"),
    ("content/product_limit", "stores", 7, "-3"),
    ("content/product_limit", "websites", 4, "0"),
    ("content/product_limit", "stores", 19, "75"),
    ("content/exclude_out_of_stock", "websites", 2, "1"),
    ("content/customer_group_id", "websites", 3, "1"),
    ("content/customer_group_id", "websites", 5, "2"),
    ("content/products_under_optional", "websites", 4, "0"),
    ("content/include_categories", "stores", 12, "0"),
    ("content/include_cms", "stores", 11, "0"),
    ("content/include_products", "stores", 13, "0"),
    ("content/cms_exclude_identifiers", "websites", 3, "page-3, page-7\npage-12,,0"),
    ("content/cms_exclude_identifiers", "websites", 4, ""),
    ("formats/generate_llms_full_txt", "websites", 1, "1"),
    ("formats/generate_llms_full_txt", "websites", 4, "1"),
    ("formats/generate_llms_txt", "stores", 16, "0"),
    ("formats/generate_jsonl", "stores", 15, "0"),
    ("sanitizer/page_builder_strategy", "websites", 2, ""),
    ("sanitizer/page_builder_strategy", "stores", 8, "strip"),
    ("sanitizer/page_builder_strategy", "stores", 10, "allow"),
    ("sanitizer/page_builder_allowed_types", "stores", 10, "row, text"),
    ("sanitizer/page_builder_excluded_types", "stores", 15, "text"),
    ("sanitizer/resolve_directives", "websites", 5, "0"),
    ("http/cache_ttl_seconds", "websites", 5, "-1"),
    ("url/append_store_code", "websites", 3, "0"),
]
SETTINGS = [(path, "default", 0, value) for path, value in DEFAULT_SETTINGS.items()] + OVERRIDES

# fixed values: document sources whose products carry marked elements, or directives
MARKED_SOURCES = ("src3", "src7", "src11")
DIRECTIVE_SOURCES = ("src5", "src15")


def _language(website) -> F.Column:
    lang = F.lit(None).cast("string")
    for website_id, name in LANGUAGE.items():
        lang = F.when(website == website_id, name).otherwise(lang)
    return lang


class DerivedCatalog(Catalog):
    """Tables are built when first used. Narrow ones that take a join or an aggregate to derive are
    written to the shared folder then, as several jobs read each of them; texts stay lazy."""

    WRITTEN = ("categories", "category_products", "category_values", "product_stores", "product_values", "page_stores", "rewrites", "stock", "prices", "run_log")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._tables = spark, sf_dir, {}
        self.as_of, self.cache = AS_OF, {}

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def _raw(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def _web(self) -> DataFrame:
        return self._raw("pages").withColumn("lang", F.regexp_extract("html", '<html lang="([a-z-]*)"', 1))

    def _languages(self) -> DataFrame:
        return self.stores.select("store_id", _language(F.col("website_id")).alias("lang"))

    def _items(self) -> DataFrame:
        return _items(self._raw("part"), self._raw("documents"))

    def _build(self, name: str) -> DataFrame:
        part, spark = self._raw("part"), self._spark
        match name:
            case "stores":
                return _stores(self._raw("nation"), self._raw("region"))
            case "settings":
                return local_rows(spark, SETTINGS, path=pa.string(), scope=pa.string(), scope_id=pa.int64(), value=pa.string())
            case "countries":
                return local_rows(spark, COUNTRIES, code=pa.string(), name=pa.string())
            case "products":
                return self._items().drop("p_size", "lang")
            case "product_stores":
                return self._items().select("entity_id", "lang").join(self._languages(), "lang").select("entity_id", "store_id")
            case "product_values":
                return _product_values(self._items().select("entity_id", "name", "p_size", "lang").join(self._languages(), "lang"))
            case "category_values":
                roots = self.stores.select("store_id", F.col("root_category_id").cast("string").alias("root"))
                placed = _categories(_category_ids(part)).withColumn("root", _root(F.col("p_type")))
                return _category_values(placed.select("entity_id", "name", "p_type", "root").join(roots, "root"))
            case "categories":
                return _categories(_category_ids(part)).drop("p_type", "p_brand")
            case "category_products":
                return _category_products(part, _category_ids(part))
            case "pages":
                return _pages(self._raw("pages"))
            case "page_stores":
                return _page_stores(self._web(), self._languages())
            case "rewrites":
                shelves = _categories(_category_ids(part))
                return _rewrites(self.stores, self._items(), self.product_stores, shelves, self._web(), self.page_stores)
            case "stock":
                return _stock(self._raw("lineitem"), self._raw("supplier"), self._raw("nation"))
            case "prices":
                return _prices(self._raw("lineitem"), part)
            case "directives":
                return _directives(self.stores)
            case "run_log":
                return _run_log(self._raw("events"), self._raw("customer"), self.stores)
            case "requests":
                return _requests(self.rewrites, self._web(), self._languages())

    def fresh(self) -> "DerivedCatalog":
        other = copy.copy(self)
        other.cache, other._tables = {}, dict(self._tables)
        return other

    def with_table(self, name: str, rows: DataFrame) -> "DerivedCatalog":
        other = copy.copy(self)
        other._tables = {**self._tables, name: rows}
        return other

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = self._build(name)
            self._tables[name] = staged(df, name) if name in self.WRITTEN else df
        return self._tables[name]


for _name in TABLES:
    setattr(DerivedCatalog, _name, property(lambda self, name=_name: self.table(name)))

_loaded: dict[tuple[str, str], DerivedCatalog] = {}


def load(spark: SparkSession, sf_dir: str) -> DerivedCatalog:
    """The catalog of one session and data folder; its written tables are shared by later calls."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = DerivedCatalog(spark, sf_dir)
    return _loaded[key]


def _stores(nation: DataFrame, region: DataFrame) -> DataFrame:
    key, website = F.col("n_nationkey").cast("long"), (F.col("n_regionkey") + 1).cast("long")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        (key + 1).alias("store_id"),
        F.lower("n_name").alias("store_code"),
        F.col("n_name").alias("store_name"),
        website.alias("website_id"),
        F.col("r_name").alias("website_name"),
        F.when(website == 5, 3).otherwise(2).cast("long").alias("root_category_id"),
        (~key.isin(8, 17)).alias("is_active"),
        (key == 0).alias("is_default"),
        F.concat(F.lit("https://shop"), website.cast("string"), F.lit(".example.test/")).alias("base_url"),
        F.when(website == 2, "USD").when(website == 4, "EUR").otherwise("").alias("currency_code"),
        F.lit("GBP").alias("default_currency_code"),
    )


def _items(part: DataFrame, documents: DataFrame) -> DataFrame:
    """Every part and every document: parts describe a product, the document of the same id is its text."""
    size, body, lang = F.col("p_size"), F.col("text"), F.coalesce("lang", F.lit("es"))
    marked = F.concat(
        F.lit('<div data-content-type="row" class="wide"><div data-content-type="text"><p>'), body,
        F.lit('</p></div><div data-content-type="products">See also: <b>'), F.coalesce("p_name", F.lit("more")),
        F.lit("</b></div></div>"),
    )
    with_directives = F.concat(body, F.lit(' {{store url="'), lang, F.lit('"}} {{var missing}}'))
    paragraphs = F.concat(F.lit("<p>"), F.replace(body, F.lit("\n"), F.lit("</p>\n<p>")), F.lit("</p>"))
    short = F.concat(
        F.lit("<p>"), F.col("p_name"), F.lit(" &middot; "), F.col("p_brand"), F.lit("&trade;, size "),
        size.cast("string"), F.lit("</p>"),
    )
    return part.join(documents, part["p_partkey"] == documents["doc_id"], "full").select(
        F.coalesce("p_partkey", "doc_id").alias("entity_id"),
        F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.when(size > 25, short).when(size <= 5, "0").alias("short_description"),
        F.when(F.col("source").isin(*MARKED_SOURCES), marked)
        .when(F.col("source").isin(*DIRECTIVE_SOURCES), with_directives)
        .otherwise(paragraphs).alias("description"),
        F.when(size == 13, 2).otherwise(1).alias("status"),
        F.when(size.between(40, 43), 1).when(size < 20, 4).when(size < 30, 2).otherwise(3).alias("visibility"),
        size.alias("p_size"),
        lang.alias("lang"),
    )


def _set_values(rows: DataFrame, **values: F.Column) -> DataFrame:
    """One row per attribute that a store sets; each value is a struct, or NULL where the default counts."""
    rules = [F.struct(F.lit(a).alias("attribute"), v.alias("own")) for a, v in values.items()]
    each = rows.select("entity_id", "store_id", F.inline(F.array(*rules)))
    return each.where(F.col("own").isNotNull()).select("entity_id", "store_id", "attribute", "own.value")


def _product_values(sold: DataFrame) -> DataFrame:
    entity, store, size = F.col("entity_id"), F.col("store_id"), F.col("p_size")

    def when(condition, value):
        return F.when(condition, F.struct(F.lit(value).cast("string").alias("value")) if not isinstance(value, F.Column) else F.struct(value.alias("value")))

    here = F.concat(F.lit('<p>Only here {{store url="'), "lang", F.lit('"}}</p>'))
    status = F.when((size == 13) & (store % 3 == 0), "1").when((entity % 23 == 0) & (store % 6 == 0), "2")
    visible = F.when((entity % 29 == 0) & (store % 4 == 1), "1").when(size.between(40, 43) & (store % 5 == 0), "4")
    return _set_values(
        sold,
        name=when((entity % 11 == 0) & ((entity + store) % 4 == 0), F.concat(F.lit("Local "), F.coalesce("name", F.lit("item")))),
        price=when((entity % 19 == 0) & (store % 2 == 0), (entity % 100 + 1).cast("string")),
        short_description=when((entity % 17 == 0) & (store % 5 == 2), None),
        description=when((entity % 13 == 0) & (store % 3 == 1), here),
        status=when(status.isNotNull(), status), visibility=when(visible.isNotNull(), visible),
    )


def _category_values(placed: DataFrame) -> DataFrame:
    entity, store = F.col("entity_id"), F.col("store_id")

    def when(condition, value):
        return F.when(condition, F.struct(value.cast("string").alias("value")))

    switch = F.when((F.col("p_type") == "LARGE") & (store % 5 == 0), "1").when((entity % 7 == 0) & (store % 3 == 0), "0")
    return _set_values(
        placed,
        name=when((entity % 3 == 0) & (store % 4 == 0), F.concat(F.lit(" Local "), "name")), is_active=when(switch.isNotNull(), switch),
        description=when((entity % 5 == 0) & (store % 2 == 0), F.lit("<p>Only here &amp; now</p>")),
        meta_description=when((entity % 5 == 1) & (store % 3 == 2), F.lit("Own <b>meta</b>")),
    )


def _category_ids(part: DataFrame) -> DataFrame:
    """Brand categories with the type category above them; ids come from the lowest part key in each."""
    brands = part.groupBy("p_type", "p_brand").agg(
        (F.min("p_partkey") * 2 + 11).alias("brand_id"), F.count("*").alias("n"),
        F.min("p_size").alias("low"), F.max("p_size").alias("high"),
    )
    types = part.groupBy("p_type").agg((F.min("p_partkey") * 2 + 10).alias("type_id"), F.count("*").alias("type_n"))
    return brands.join(types, "p_type")


def _root(kind) -> F.Column:
    return F.when(kind.isin("PROMO", "STANDARD"), "3").otherwise("2")


def _categories(ids: DataFrame) -> DataFrame:
    kind, brand = F.col("p_type"), F.col("p_brand")
    top = F.concat(F.lit("1/"), _root(kind), F.lit("/"), F.col("type_id").cast("string"))
    types = ids.groupBy("p_type", "type_id", "type_n").agg(F.count("*").alias("_")).select(
        F.col("type_id").alias("entity_id"), kind.alias("name"), F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("All "), F.lower(kind), F.lit(" parts &copy; shop")).alias("meta_description"),
        top.alias("path"), (kind != "LARGE").alias("is_active"), F.col("type_n").alias("position"),
        "p_type", F.lit(None).cast("string").alias("p_brand"),
    )
    facts = F.concat(
        F.lit("<p>"), brand, F.lit(" "), F.lower(kind), F.lit(": "), F.col("n").cast("string"), F.lit(" parts,<br>sizes "),
        F.col("low").cast("string"), F.lit(" to "), F.col("high").cast("string"), F.lit("</p>"),
    )
    brands = ids.select(
        F.col("brand_id").alias("entity_id"), F.when(brand == "Brand#7", "  ").otherwise(brand).alias("name"),
        F.when(brand == "Brand#20", "0").otherwise(facts).alias("description"),
        F.concat(brand, F.lit(" &amp; friends")).alias("meta_description"),
        F.concat(top, F.lit("/"), F.col("brand_id").cast("string")).alias("path"),
        (brand != "Brand#13").alias("is_active"), F.col("n").alias("position"), "p_type", "p_brand",
    )
    return types.unionByName(brands)


def _category_products(part: DataFrame, ids: DataFrame) -> DataFrame:
    placed = part.select("p_partkey", "p_size", "p_type", "p_brand").join(ids, ["p_type", "p_brand"])
    both = F.array("brand_id", F.when(F.col("p_size") > 45, F.col("type_id")))
    return placed.select(
        F.explode(F.array_compact(both)).alias("category_id"), F.col("p_partkey").alias("product_id")
    )


def _pages(web: DataFrame) -> DataFrame:
    url = F.col("url")
    return web.select(
        "page_id",
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("identifier"),
        F.when(url.contains("spam-farm"), "").otherwise(F.col("html")).alias("content"),
        F.concat(F.lit("Page at "), url, F.lit(" &copy; archive")).alias("meta_description"),
        (~url.endswith("#top")).alias("is_active"),
        F.length(url).cast("long").alias("sort_order"),
    )


def _page_stores(web: DataFrame, languages: DataFrame) -> DataFrame:
    """Spanish pages show in every store (store 0), the others in the stores of their language."""
    everywhere = web.where(F.col("lang") == "es").select("page_id", F.lit(0).cast("long").alias("store_id"))
    own = web.where(F.col("lang") != "es").select("page_id", "lang").join(languages, "lang")
    return everywhere.unionByName(own.select("page_id", "store_id"))


def _rewrites(stores, items, product_stores, categories, web, page_stores) -> DataFrame:
    columns = ("url_rewrite_id", "store_id", "entity_type", "entity_id", "request_path", "redirect_type")

    def rows(df, shift, kind, path, redirect=0):
        return df.select(
            (F.col("entity_id") * 10 + shift).alias("url_rewrite_id"), "store_id", F.lit(kind).alias("entity_type"),
            "entity_id", path.alias("request_path"), F.lit(redirect).alias("redirect_type"),
        ).select(*columns)

    size, key = F.col("p_size"), F.col("entity_id").cast("string")
    sold = product_stores.join(items.select("entity_id", "name", "p_size"), "entity_id")
    name = F.translate(F.coalesce("name", F.lit("item")), " ", "-")
    lead = F.when(size == 5, "/").otherwise("")
    main = rows(sold.where(F.coalesce(size != 49, F.lit(True))), 5, "product",
                F.concat(lead, name, F.lit("-"), key, F.lit(".html")))
    alias = rows(sold.where(size.isin(10, 20, 30)), 6, "product", F.concat(F.lit("alias/"), key))
    moved = rows(sold.where(size.isin(7, 8)), 4, "product", F.concat(F.lit("old-"), key, F.lit(".html")), 301)
    custom = rows(sold.where(size == 11), 7, "custom", F.concat(F.lit("custom-"), key))

    roots = stores.select("store_id", F.col("root_category_id").cast("string").alias("root"))
    placed = categories.withColumn("root", _root(F.col("p_type"))).join(roots, "root")
    slug = F.concat_ws("/", F.lit("c"), F.lower("p_type"), F.lower(F.translate("p_brand", "#", "-")))
    shelves = rows(placed.where(F.coalesce(F.col("p_brand") != "Brand#19", F.lit(True))), 1, "category",
                   F.concat(slug, F.lit(".html")))

    every = stores.select("store_id", F.explode(F.array("store_id", F.lit(0).cast("long"))).alias("link_store"))
    linked = page_stores.withColumnRenamed("store_id", "link_store").join(every, "link_store")
    named = linked.join(web.where(~F.col("url").contains("?")).select("page_id"), "page_id")
    content = rows(named.withColumnRenamed("page_id", "entity_id"), 2, "cms-page", F.concat(F.lit("page/"), key))
    union = main
    for other in (alias, moved, custom, shelves, content):
        union = union.unionByName(other)
    return union


def _stock(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    regions = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select("s_suppkey", "n_regionkey")
    return (
        lineitem.join(regions, lineitem["l_suppkey"] == regions["s_suppkey"])
        .groupBy(F.col("l_partkey").alias("product_id"), (F.col("n_regionkey") + 1).cast("long").alias("website_id"))
        .agg(F.when(F.sum("l_quantity") >= 100, 1).otherwise(0).alias("stock_status"))
    )


def _prices(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    flags = F.col("l_returnflag")
    group = F.when(flags == "N", 0).when(flags == "A", 1).otherwise(2).cast("long")
    sales = lineitem.groupBy("l_partkey", group.alias("group_id")).agg(
        F.max("l_discount").alias("discount"), F.min("l_shipdate").alias("special_from"), F.max("l_shipdate").alias("special_to")
    )
    price = F.col("p_retailprice")
    return sales.join(part.select("p_partkey", "p_retailprice"), sales["l_partkey"] == part["p_partkey"]).select(
        F.col("l_partkey").alias("product_id"), "group_id",
        (F.floor(price * (1 - F.col("discount")) * 100) / 100).alias("group_price"),
        (price * 0.9).alias("special_price"), "special_from", "special_to",
    )


def _directives(stores: DataFrame) -> DataFrame:
    lang = _language(F.col("website_id"))
    return stores.select(
        "store_id", F.concat(F.lit('{{store url="'), lang, F.lit('"}}')).alias("token"),
        F.concat(F.lit('<a href="/">'), F.col("store_name"), F.lit(" home</a>")).alias("value"),
    )


def _run_log(events: DataFrame, customer: DataFrame, stores: DataFrame) -> DataFrame:
    hour, failed = F.hour("ts"), F.col("event_type") == "error"
    codes = customer.select("c_custkey", (F.col("c_nationkey") + 1).cast("long").alias("store_id")).join(
        stores.select("store_id", "store_code"), "store_id"
    )
    return events.join(codes, events["user_id"] == codes["c_custkey"]).select(
        F.col("event_id").alias("run_id"), "store_code",
        F.when(hour < 8, "llms_txt").when(hour < 16, "llms_full_txt").otherwise("jsonl").alias("format"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("attempted_at"),
        F.when(~failed, F.floor(F.col("value") * 1000).cast("long")).alias("byte_size"),
        F.when(~failed, F.regexp_extract("props", r"\d+", 0).cast("long")).alias("item_count"),
        F.when(~failed, F.col("value") / 8).alias("duration_seconds"),
        F.when(failed, F.concat(F.lit("failed: "), F.col("props"))).alias("error_message"),
    )


def _requests(rewrites: DataFrame, web: DataFrame, languages: DataFrame) -> DataFrame:
    """Mirror requests for every rewrite, without and with its suffix, and the path of every web page."""
    bare = F.regexp_replace("request_path", r"\.html$", "")
    paths = rewrites.select("store_id", F.explode(F.array(
        F.concat(bare, F.lit(".md")), F.concat(F.lit("/"), F.col("request_path"), F.lit(".md"))
    )).alias("path"))
    pages = web.select("lang", url_path(F.col("url")).alias("path")).join(languages, "lang").select("store_id", "path")
    return paths.unionByName(pages)
