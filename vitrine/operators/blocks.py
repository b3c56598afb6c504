"""Rendering: entity rows to document blocks (see ``schemas.BLOCK``) and to records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import (
    CATEGORIES_ORD,
    CLOSING_POS,
    COMPACT,
    EMBEDDING_CAP,
    FORMATS,
    HEADING_POS,
    JSONL,
    PAGES_ORD,
    PRODUCTS_ORD,
    SIBLINGS_ORD,
    STORE_ORD,
    TEXT_FORMATS,
)
from vitrine.functions.cleaning import Cleaner
from vitrine.functions.text import embedding_text, text, trim_text
from vitrine.functions.values import format_price
from vitrine.operators.entities import (
    category_listing,
    category_rows,
    listed_products,
    page_listing,
    page_rows,
    product_rows,
)
from vitrine.operators.stores import sibling_stores, store_context, store_summary, with_country
from vitrine.schemas import RECORD, RECORD_FIELDS, RECORD_TEXTS
from vitrine.sources.catalog import Catalog


def _line(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else text(p) for p in parts], F.lit("\n"))


def _line_if(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, _line(*parts)).otherwise("")


def _blocks(rows: DataFrame, section: int, position, entity_id, items, content: Column) -> DataFrame:
    return rows.select(
        "format", "store_code", F.lit(section).alias("section_ord"),
        position.cast("long").alias("position"), entity_id.cast("long").alias("entity_id"),
        items.cast("int").alias("items"), content.alias("text"),
    )


def _framed(entities: DataFrame, listing: DataFrame, section: int, heading: Column, heading_items: Column) -> DataFrame:
    """Entity blocks between a heading and an empty closing line, where a store lists any entity.

    The stores come from the narrow listing, so this branch reads no text.
    """
    marks = ["store_code", "formats", *(c for c in listing.columns if c == "products_under_optional")]
    some = listing.select(*marks).distinct().withColumn("format", F.explode("formats")).where(F.col("format") != JSONL)
    top = F.struct(F.lit(HEADING_POS).alias("position"), heading_items.cast("int").alias("items"), heading.alias("text"))
    end = F.struct(F.lit(CLOSING_POS).alias("position"), F.lit(1).alias("items"), F.lit("\n").alias("text"))
    marked = some.select("format", "store_code", F.inline(F.array(top, end)))
    return entities.unionByName(_blocks(marked, section, F.col("position"), F.lit(0), F.col("items"), F.col("text")))


def _formatted_stores(catalog: Catalog, formats: Sequence[str]) -> DataFrame:
    offered = F.array_intersect("formats", F.array(*map(F.lit, formats)))
    return store_context(catalog).withColumn("format", F.explode(offered))


# one block per row: text, or one JSON line in the record format


def _record(kind: str, **columns: Column) -> list[Column]:
    """The superset record as columns; fields a kind does not have are NULL."""
    fields = []
    for part in RECORD.split(", "):
        name, type_name = part.split()
        value = F.lit(kind) if name == "entity_type" else columns.get(name, F.lit(None))
        fields.append(value.cast(type_name).alias(name))
    return fields


def product_record() -> list[Column]:
    name, short, body = trim_text(text(F.col("name"))), F.col("short"), F.col("body")
    return _record(
        "product", entity_id=F.col("entity_id"), store_code=F.col("store_code"), store_name=text(F.col("store_name")),
        sku=text(F.col("sku")), name=name, url=F.col("url"), price=F.coalesce("price", F.lit(0.0)),
        currency=F.col("currency"), short_description=short, description=body,
        embedding_text=embedding_text(name, short, body, limit=EMBEDDING_CAP),
    )


def category_record() -> list[Column]:
    name, body = trim_text(F.col("name")), F.col("body")
    return _record(
        "category", entity_id=F.col("entity_id"), store_code=F.col("store_code"), store_name=text(F.col("store_name")),
        name=name, url=F.col("url"), description=body, embedding_text=embedding_text(name, body, limit=EMBEDDING_CAP),
    )


def _page_texts() -> dict[str, Column]:
    body = F.col("body")
    return {"content": body, "embedding_text": embedding_text(trim_text(F.col("title")), body, limit=EMBEDDING_CAP)}


def page_record() -> list[Column]:
    return _record(
        "cms_page", entity_id=F.col("entity_id"), store_code=F.col("store_code"), store_name=text(F.col("store_name")),
        title=trim_text(F.col("title")), identifier=text(F.col("identifier")), url=F.col("url"), **_page_texts(),
    )


def store_record() -> list[Column]:
    name = text(F.col("store_name"))
    return _record(
        "store", entity_id=F.col("store_id"), store_code=F.col("store_code"), store_name=name, url=F.col("plain_url"),
        currency=F.col("currency"), locale=F.col("locale"), embedding_text=trim_text(F.concat_ws(" ", name, F.col("plain_url"))),
    )


def json_line(record: Sequence[Column]) -> Column:
    """One JSON object; NULL fields are left out, invalid UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(F.to_json(F.struct(*record), {"ignoreNullFields": "true"}))


def _wide_json(texts: dict[str, Column]) -> Callable[[DataFrame], DataFrame]:
    """Adds ``wide_json``, the end of a record's line from its texts on. Every store of an entity repeats them, so they are written as JSON once."""
    def add(rows: DataFrame) -> DataFrame:
        whole = json_line([c.cast("string").alias(name) for name, c in texts.items()])
        rows = rows.withColumn("wide_json", F.when(F.col("format") == JSONL, whole))
        wide = F.col("wide_json")
        tail = F.concat(F.lit(","), F.substring(wide, F.lit(2), F.octet_length(wide)))
        return rows.withColumn("wide_json", F.when(wide == "{}", "}").otherwise(tail))

    return add


def _either(rows: DataFrame, record: list[Column], content: Column) -> Column:
    """A record's line in the record format, else the content. The texts are a record's last fields."""
    if "wide_json" in rows.columns:
        start = json_line(record[:RECORD_FIELDS.index(RECORD_TEXTS[0])])
        line = F.concat(F.left(start, F.length(start) - 1), F.col("wide_json"))
    else:
        line = json_line(record)
    return F.when(F.col("format") == JSONL, F.concat(line, F.lit("\n"))).otherwise(content)


def _items(with_body: int, without: int) -> Column:
    """Chunks that a block stands for."""
    return F.when(F.col("format") == JSONL, 1).when(F.col("body") != "", with_body).otherwise(without)


def product_blocks(rows: DataFrame) -> DataFrame:
    sku, body = trim_text(text(F.col("sku"))), F.col("body")
    content = F.concat(
        _line("### ", trim_text(text(F.col("name")))),
        _line_if(sku != "", "SKU: ", sku),
        _line("URL: ", F.col("url")),
        _line_if(F.coalesce(F.col("price") > 0, F.lit(False)), "Price: ", format_price(F.col("price")), " ", F.col("currency")),
        _line("In Stock: ", F.when(F.col("in_stock"), "Yes").otherwise("No")),
        _line_if(body != "", "Description: ", body),
        F.lit("\n"),
    )
    return _blocks(rows, PRODUCTS_ORD, F.lit(0), F.col("entity_id"), F.lit(1), _either(rows, product_record(), content))


def category_blocks(rows: DataFrame) -> DataFrame:
    body = F.col("body")
    content = F.concat(
        _line("### ", trim_text(F.col("name"))),
        _line("Path: ", F.col("breadcrumb")),
        _line("URL: ", F.col("url")),
        _line("Product Count: ", F.col("product_count").cast("string")),
        _line_if(body != "", "Description: ", body),
        F.lit("\n"),
    )
    content = _either(rows, category_record(), content)
    return _blocks(rows, CATEGORIES_ORD, F.col("position"), F.col("entity_id"), _items(6, 5), content)


def page_blocks(rows: DataFrame) -> DataFrame:
    body = F.col("body")
    content = F.concat(
        _line("### ", trim_text(F.col("title"))),
        _line("URL: ", F.col("url")),
        _line_if(body != "", "Content: ", body),
        F.lit("\n"),
    )
    content = _either(rows, page_record(), content)
    return _blocks(rows, PAGES_ORD, F.col("position"), F.col("entity_id"), _items(4, 3), content)


# sections of a document


def store_section(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    stores = store_summary(with_country(catalog, _formatted_stores(catalog, formats)))
    both = ("website_name", " - ", "store_name")
    title = [F.lit(p) if p == " - " else text(F.col(p)) for p in both]
    content = F.concat(
        _line("# LLMs.txt - ", *title, " "), F.lit("\n"),
        _line("> Store: ", *title),
        _line("> Country: ", F.col("country")),
        _line("> Currency: ", F.col("currency")), F.lit("\n"),
        _line("> ", F.col("summary")), F.lit("\n"),
    )
    items = F.when(F.col("format") == JSONL, 1).otherwise(5)
    return _blocks(stores, STORE_ORD, F.lit(0), F.lit(0), items, _either(stores, store_record(), content))


def sibling_section(catalog: Catalog, formats: Sequence[str] = TEXT_FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    offered = F.array_intersect("formats", F.array(*[F.lit(f) for f in formats if f != JSONL]))
    pairs = sibling_stores(catalog).withColumn("formats", offered)
    each = pairs.withColumn("format", F.explode("formats"))
    content = _line("- [", F.col("website_name"), " - ", F.col("sibling_name"), "](", F.col("sibling_url"), ")")
    entries = _blocks(each, SIBLINGS_ORD, F.lit(0), F.col("sibling_id"), F.lit(1), content)
    heading = F.lit("## Other Available Stores\n\n")
    return _framed(entries, pairs, SIBLINGS_ORD, heading, F.lit(1))


def category_section(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    entries = category_blocks(category_rows(catalog, formats, cleaner))
    return _framed(entries, category_listing(catalog, formats), CATEGORIES_ORD, F.lit("## Categories\n\n"), F.lit(1))


def page_section(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    entries = page_blocks(page_rows(catalog, formats, cleaner, _wide_json(_page_texts())))
    return _framed(entries, page_listing(catalog, formats), PAGES_ORD, F.lit("## Pages\n\n"), F.lit(1))


def product_heading(optional: Column) -> tuple[Column, Column]:
    """Heading text and its number of chunks; only compact documents may put products under Optional."""
    under = optional & (F.col("format") == COMPACT)
    heading = F.when(under, "## Optional\n\n### Products\n\n").otherwise("## Products\n\n")
    return heading, F.when(under, 2).otherwise(1)


def product_section(catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
    entries = product_blocks(product_rows(catalog, formats, cleaner))
    heading = product_heading(F.col("products_under_optional"))
    # A limit keeps at least one product, so the rows before it tell which stores list any.
    offered = F.array_intersect("formats", F.array(*map(F.lit, formats)))
    return _framed(entries, listed_products(catalog).withColumn("formats", offered), PRODUCTS_ORD, *heading)


# records as columns


def store_records(catalog: Catalog) -> DataFrame:
    return _formatted_stores(catalog, (JSONL,)).select(*store_record())


def product_records(catalog: Catalog, cleaner: Cleaner | None = None) -> DataFrame:
    return product_rows(catalog, (JSONL,), cleaner).select(*product_record())


def category_records(catalog: Catalog, cleaner: Cleaner | None = None) -> DataFrame:
    return category_rows(catalog, (JSONL,), cleaner).select(*category_record())


def page_records(catalog: Catalog, cleaner: Cleaner | None = None) -> DataFrame:
    return page_rows(catalog, (JSONL,), cleaner).select(*page_record())
