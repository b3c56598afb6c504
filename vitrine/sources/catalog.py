"""The catalog: one DataFrame per table, plus the scans that the jobs share."""

from __future__ import annotations

import copy
import datetime as dt
from dataclasses import dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.constants import REWRITE_TYPES, STATUS_ENABLED, VISIBLE
from vitrine.functions.text import trim_text
from vitrine.operators.overrides import CATEGORY_FACTS, CATEGORY_TEXTS, PRODUCT_FACTS, PRODUCT_TEXTS, resolve
from vitrine.schemas import TABLES

OPTIONAL_TABLES = ("product_values", "category_values", "prices", "countries", "directives", "run_log", "requests")


def shown_product() -> Column:
    return (F.col("status") == STATUS_ENABLED) & F.col("visibility").isin(*VISIBLE)


@dataclass
class Catalog:
    stores: DataFrame
    settings: DataFrame
    products: DataFrame
    product_stores: DataFrame
    categories: DataFrame
    category_products: DataFrame
    pages: DataFrame
    page_stores: DataFrame
    rewrites: DataFrame
    stock: DataFrame
    product_values: DataFrame | None = None
    category_values: DataFrame | None = None
    prices: DataFrame | None = None
    countries: DataFrame | None = None
    directives: DataFrame | None = None
    run_log: DataFrame | None = None
    requests: DataFrame | None = None
    as_of: dt.datetime = field(default_factory=dt.datetime.now)
    # Memo of small derived tables (store context), so one run resolves the settings once.
    cache: dict = field(default_factory=dict, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.stores.sparkSession

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str, as_of: dt.datetime | None = None) -> "Catalog":
        """Tables under ``{path}/{name}``; optional ones may be absent."""
        tables = {}
        for name, ddl in TABLES.items():
            reader = spark.read.schema(ddl)
            try:
                tables[name] = reader.parquet(f"{path.rstrip('/')}/{name}")
            except AnalysisException:
                if name not in OPTIONAL_TABLES:
                    raise
                tables[name] = None
        if as_of is not None:
            tables["as_of"] = as_of
        return cls(**tables)

    def tables(self) -> dict[str, DataFrame]:
        named = ((f.name, getattr(self, f.name)) for f in fields(self) if f.name in TABLES)
        return {name: df for name, df in named if df is not None}

    def fresh(self) -> "Catalog":
        """The same tables without listings made before."""
        other = copy.copy(self)
        other.cache = {}
        return other

    def with_table(self, name: str, rows: DataFrame) -> "Catalog":
        """The same catalog with other rows of one table; listings made already are shared."""
        other = copy.copy(self)
        setattr(other, name, rows)
        return other

    # scans: filters and columns reach the Parquet reader

    def scan_stores(self, code: str | None = None) -> DataFrame:
        return self.stores if code is None else self.stores.where(F.col("store_code") == code)

    def scan_products(self, *columns: str) -> DataFrame:
        """Products enabled and visible by default; only the columns asked for."""
        return self.products.where(shown_product()).select("entity_id", *columns)

    def scan_offered(self, *columns: str) -> DataFrame:
        """Products that may be shown in some store: by default, or where a store sets their status or visibility."""
        if self.product_values is None:
            return self.scan_products(*columns)
        set_here = self.product_values.where(F.col("attribute").isin("status", "visibility")).select("entity_id").distinct()
        hidden = self.products.where(~F.coalesce(shown_product(), F.lit(False))).select("entity_id", *columns)
        return self.scan_products(*columns).unionByName(hidden.join(set_here, "entity_id", "left_semi"))

    def scan_store_products(self, *columns: str) -> DataFrame:
        """(``store_id``, ``entity_id``, columns) of the products enabled and visible in a store they are linked to, as the store sees them."""
        asked = dict.fromkeys((*columns, "status", "visibility"))
        rows = self.product_stores.join(self.scan_offered(*asked), "entity_id")
        if self.product_values is not None:
            own = [c for c in asked if c in (*PRODUCT_FACTS, *PRODUCT_TEXTS)]
            rows = resolve(rows, self.product_values, own)
        return rows.where(shown_product()).select("store_id", "entity_id", *columns)

    def scan_categories(self, *columns: str) -> DataFrame:
        """Categories below a root, active by default: path ``1/{root}/…``."""
        return self.scan_placed("is_active", *(c for c in columns if c != "is_active")).where("is_active").select(
            "entity_id", "path", "position", "root", *columns)

    def scan_placed(self, *columns: str) -> DataFrame:
        """Categories below a root, active or not."""
        steps = F.split("path", "/")
        return (
            self.categories.where(F.col("path").startswith("1/") & (F.size(steps) > 2))
            .select("entity_id", "path", "position", F.try_element_at(steps, F.lit(2)).alias("root"), *columns)
        )

    def scan_store_categories(self, *columns: str) -> DataFrame:
        """(``store_id``, ``entity_id``, ``path``, columns) of the categories below a store's root that are active in it, as the store sees them."""
        roots = self.stores.select("store_id", F.col("root_category_id").cast("string").alias("root"))
        asked = dict.fromkeys((*columns, "is_active"))
        rows = self.scan_placed(*asked).join(roots, "root")
        if self.category_values is not None:
            own = [c for c in asked if c in (*CATEGORY_FACTS, *CATEGORY_TEXTS)]
            rows = resolve(rows, self.category_values, own)
        return rows.where("is_active").select("store_id", "entity_id", "path", *columns)

    def scan_pages(self, *columns: str) -> DataFrame:
        """Active pages that have a title."""
        return self.pages.where(F.col("is_active") & (trim_text(F.col("title")) != "")).select("page_id", *columns)

    def scan_rewrites(self) -> DataFrame:
        """Current (not redirecting) rewrites of products, categories and pages."""
        return self.rewrites.where(F.col("entity_type").isin(*REWRITE_TYPES) & (F.col("redirect_type") == 0))

    def scan_stock(self) -> DataFrame:
        return self.stock.select("product_id", "website_id", "stock_status")
