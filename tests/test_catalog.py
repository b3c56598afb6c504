import dataclasses
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.shop import small_documents, small_shop
from vitrine.constants import COMPACT, FULL, JSONL
from vitrine.operators import blocks, entities, lookups, mirror, stores
from vitrine.operators.directives import substitute_directives
from vitrine.plans.document import document_sizes, section_counts
from vitrine.plans.sections import Sections
from vitrine.schemas import RECORD_FIELDS


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def made(shop):
    """Blocks of every format, written once."""
    return Sections().staged_blocks(shop)


@pytest.fixture(scope="module")
def documents(made):
    return {(r["store_code"], r["format"]): r["document"] for r in small_documents(made).collect()}


COMPACT_DOCUMENT = """# LLMs.txt - Shop - Main 

> Store: Shop - Main
> Country: United States
> Currency: USD

> Fine shoes

## Other Available Stores

- [Shop - Deutsch](https://shop.test/de/llms.txt)

## Categories

### Kids
Path: Shoes > Kids
URL: https://shop.test/footwear/kids.html
Product Count: 1
Description: For kids

### Lost
Path: 7 > Lost
URL: https://shop.test/lost.html
Product Count: 0
Description: x

### Shoes
Path: Shoes
URL: https://shop.test/footwear.html
Product Count: 2
Description: All shoes


## Pages

### Meta only
URL: https://shop.test/meta
Content: From meta

### About
URL: https://shop.test/about
Content: About Us


## Optional

### Products

### Red shoe
SKU: A-1
URL: https://shop.test/red-one.html
Price: 9.00 USD
In Stock: Yes
Description: Long & bold

### Blue shoe
SKU: A-2
URL: https://shop.test/blue.html
Price: 15.25 USD
In Stock: No
Description: Short

### No price
URL: https://shop.test/free.html
In Stock: Yes

### 
SKU: A-7
URL: https://shop.test/nameless.html
Price: 5.00 USD
In Stock: Yes
Description: See here and end


"""


def test_compact_document(documents):
    assert documents["default", COMPACT] == COMPACT_DOCUMENT


def test_full_document_only_where_switched_on(documents):
    assert [k for k in documents if k[1] == FULL] == [("default", FULL)]
    assert documents["default", FULL] == COMPACT_DOCUMENT.replace("## Optional\n\n### Products\n", "## Products\n")


def test_second_store(documents):
    text = documents["de", COMPACT]
    assert "> Country: DE\n> Currency: EUR\n\n> Online store — EUR, de-DE\n" in text
    assert "- [Shop - Main](https://shop.test/llms.txt)" in text
    # A page without a rewrite falls back to the base URL without the store code.
    assert "### About\nURL: https://shop.test/about\n" in text
    assert "URL: https://shop.test/de/rot.html\n" in text
    assert "## Categories" not in text


def test_lone_store_has_no_sibling_section(documents):
    assert "Other Available" not in documents["solo", COMPACT]


def test_records(shop):
    products = {r["entity_id"]: r for r in blocks.product_records(shop).where("store_code = 'default'").collect()}
    assert sorted(products) == [10, 11, 14, 16]
    assert products[14]["price"] == 0.0 and products[14]["short_description"] == "0"
    assert products[10]["embedding_text"] == "Red shoe\n\nLong & bold"
    assert rows(blocks.page_records(shop).where("store_code = 'default'"), "entity_id", "content") == [(1, "About Us"), (2, "")]
    assert rows(blocks.category_records(shop), "entity_id", "description") == [
        (5, "All shoes"), (6, ""), (8, "x"), (30, "x")]
    assert rows(blocks.store_records(shop).where("store_code = 'de'"), "url", "locale", "embedding_text") == [
        ("https://shop.test", "de-DE", "Deutsch https://shop.test")]


def test_record_lines_leave_out_absent_fields(made):
    line = made.where("format = 'jsonl' and store_code = 'default' and section_ord = 40 and entity_id = 1").first()["text"]
    assert line == (
        '{"entity_type":"cms_page","entity_id":1,"store_code":"default","store_name":"Main","title":"About",'
        '"identifier":"about","url":"https://shop.test/about","content":"About Us","embedding_text":"About\\nAbout Us"}\n'
    )


def test_sizes_and_counts(made):
    size = document_sizes(made).where("store_code = 'default' and format = 'llms_txt'").first()
    # store 5, siblings 1+1+1, categories 1+6+6+6+1, pages 1+4+4+1, products 2+4+1
    assert size["item_count"] == 5 + 3 + 20 + 10 + 7
    assert size["byte_size"] == len(COMPACT_DOCUMENT.encode())
    counts = section_counts(made).where("store_code = 'default' and format = 'llms_txt'")
    assert rows(counts, "section_ord", "entities") == [(10, 1), (20, 1), (30, 3), (40, 2), (50, 4)]


def test_settings_scopes(spark):
    shop = small_shop(spark, [
        ("content/product_limit", "websites", 1, "2"), ("content/product_limit", "stores", 2, "-5"),
        ("general/exclude_store", "stores", 4, "1"), ("content/cms_exclude_identifiers", "stores", 1, "about, meta\n"),
        ("sanitizer/page_builder_strategy", "stores", 2, ""),
    ])
    context = {r["store_code"]: r for r in stores.store_context(shop).collect()}
    assert [context[c]["product_limit"] for c in ("default", "de", "solo")] == [2, 0, 5000]
    assert context["default"]["excluded_pages"] == ["about", "meta"]
    assert context["default"]["rule"] == "exclude|" and context["de"]["rule"] == "preserve|"
    plan = dict(((s, f), a) for s, f, a in rows(stores.eligibility_plan(shop), "store_code", "format", "action"))
    assert plan["default", FULL] == "generate" and plan["de", FULL] == "delete"
    assert plan["solo", JSONL] == "delete" and plan["off", COMPACT] == "delete"
    assert [r[1] for r in rows(entities.product_listing(shop).where("store_id = 1"), "store_id", "entity_id")] == [10, 11]


def test_nothing_is_planned_when_switched_off(spark):
    shop = small_shop(spark, [("general/enabled", "stores", 1, "1")])
    off = shop.settings.withColumn(
        "value", F.when((F.col("path") == "general/enabled") & (F.col("scope") == "default"), "0").otherwise(F.col("value")))
    shop.settings = off
    assert stores.eligibility_plan(shop).count() == 0


def test_out_of_stock_can_be_left_out(spark):
    shop = small_shop(spark, [("content/exclude_out_of_stock", "default", 0, "1")])
    shop.settings = shop.settings.where(~((F.col("path") == "content/exclude_out_of_stock") & (F.col("value") == "0")))
    assert [r[0] for r in rows(entities.product_listing(shop).where("store_id = 1"), "entity_id")] == [10, 14, 16]


def test_one_url_per_entity(shop):
    urls = lookups.canonical_urls(shop)
    found = {(k, i): u for s, k, i, u in rows(urls, "store_id", "entity_type", "entity_id", "url") if s == 1}
    assert found["product", 10] == "https://shop.test/red-one.html"
    assert ("product", 15) not in found and ("custom", 10) not in found
    assert urls.count() == urls.select("store_id", "entity_type", "entity_id").distinct().count()


def test_final_price(shop):
    base = shop.products.select("entity_id", "price").withColumn("customer_group_id", F.lit(0).cast("long"))
    prices = dict(rows(lookups.apply_tariff(shop, lookups.pick_tariff(shop, lookups.product_shelf(shop, base))), "entity_id", "price"))
    assert prices[10] == 9.0  # the special price is over
    assert prices[11] == 15.25  # open-ended special price, no group price
    assert prices[15] == 5.0


def test_mirror(shop):
    found = rows(mirror.mirror_lookup(shop), "store_id", "path", "entity_type", "entity_id")
    # 'moved' redirects, so its '.html' spelling is not tried; store 4 has no mirror
    assert found == [
        (1, "/about.md", "cms-page", 1), (1, "custom.md", "custom", 10), (1, "footwear.md", "category", 5),
        (1, "red-one.html.md", "product", 10), (1, "red-one.md", "product", 10)]
    pages = dict(rows(mirror.mirror_render(shop), "path", "markdown"))
    assert pages == {
        "/about.md": "# About \n\nAbout Us\n", "footwear.md": "# Shoes\n\nAll shoes\n",
        "red-one.md": "#  Red shoe \n\n> SKU: A-1 · Price: 9.00 USD\n\nLong & bold\n",
        "red-one.html.md": "#  Red shoe \n\n> SKU: A-1 · Price: 9.00 USD\n\nLong & bold\n"}


@pytest.mark.parametrize("limits", [{1: 7, 2: 0, 3: 100_000}, {1: 1, 2: 250, 3: 3}])
def test_ranks_match_a_plain_sort(spark, monkeypatch, limits):
    monkeypatch.setattr(lookups, "RANK_BITS", 4)
    rng = random.Random(5)
    # store 1 holds most of the rows
    listed = [(1, i) for i in rng.sample(range(5000), 900)] + [(s, i) for s in (2, 3) for i in rng.sample(range(900), 300)]
    df = spark.createDataFrame(listed, "store_id long, entity_id long")
    limit = F.element_at(F.create_map(*[F.lit(v).cast("long") for kv in limits.items() for v in kv]), F.col("store_id"))
    kept = rows(lookups.first_per_store(df, limit), "store_id", "entity_id")
    expected = []
    for store, n in limits.items():
        ids = sorted(i for s, i in listed if s == store)
        expected += [(store, i) for i in (ids[:n] if n else ids)]
    assert kept == sorted(expected)


def test_directives(spark):
    texts = [
        (1, 1, "a {{x}} b {{y}} c {{x}}", "{{x}}"), (1, 2, "a {{x}}", "plain"), (2, None, "{{x}}", "{{y}}"), (3, 1, "none", None),
    ]
    values = [(1, "{{x}}", "{{y}}!"), (1, "{{x}}", "{{a}}"), (1, "{{y}}", "Y"), (2, "{{x}}", "2")]
    df = spark.createDataFrame(texts, "entity_id long, store_id long, a string, b string")
    table = spark.createDataFrame(values, "store_id long, token string, value string")
    done = substitute_directives(df, ["a", "b"], table).collect()
    assert {(r[0], r[1], r[2], r[3]) for r in map(lambda r: (r["entity_id"], r["store_id"], r["a"], r["b"]), done)} == {
        (1, 1, "a {{y}}! b Y c {{y}}!", "{{y}}!"), (1, 2, "a 2", "plain"), (2, None, "{{x}}", "{{y}}"), (3, 1, "none", None)}


def test_texts_without_directives_take_no_join(spark, tmp_path):
    texts = [(1, 1, "a {{x}}"), (1, 2, "b"), (2, None, "{{x}}"), (None, 1, "{{x}}"), (3, 1, None), (3, 1, None)]
    spark.createDataFrame(texts, "entity_id long, store_id long, a string").write.parquet(str(tmp_path / "texts"))
    df = spark.read.parquet(str(tmp_path / "texts"))
    done = substitute_directives(df, ["a"], spark.createDataFrame([(1, "{{x}}", "X")], "store_id long, token string, value string"))
    assert sorted(map(str, map(tuple, done.collect()))) == sorted(map(str, [(1, 1, "a X"), (1, 2, "b"), (2, None, "{{x}}"), (None, 1, "{{x}}"), (3, 1, None), (3, 1, None)]))
    # Texts without a token are a branch of their own, beside the join.
    assert done._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_a_store_may_have_very_many_directives(spark, shop):
    values = spark.range(1_000_000).select(F.lit(1).cast("long").alias("store_id"), F.format_string("{{v %d}}", "id").alias("token"),
                                           F.format_string("<%d> value %d", "id", "id").alias("value"))
    texts = F.concat(F.lit("a {{v "), (F.col("entity_id") * 7).cast("string"), F.lit("}} b {{v 999999}} {{v none}}"))
    many = dataclasses.replace(shop, cache={}, directives=values, products=shop.products.withColumns({"description": texts, "short_description": F.lit(None).cast("string")}))
    bodies = {r["entity_id"]: r["body"] for r in entities.product_rows(many, (COMPACT,)).where("store_id = 1").collect()}
    assert bodies and bodies == {i: f"a value {i * 7} b value 999999" for i in bodies}


def test_markup_that_a_directive_brings_is_pruned(spark, shop):
    value = '<div data-content-type="products">CAROUSEL</div> KEEP'
    shop = dataclasses.replace(
        shop, cache={}, products=shop.products.withColumn("description", F.lit("See {{block}}")).withColumn("short_description", F.lit("")),
        directives=spark.createDataFrame([(1, "{{block}}", value)], "store_id long, token string, value string"),
        settings=shop.settings.where("path not like 'sanitizer/%'").union(spark.createDataFrame(
            [("sanitizer/resolve_directives", "default", 0, "1"), ("sanitizer/page_builder_strategy", "default", 0, "exclude")], shop.settings.schema)),
    )
    bodies = {r["body"] for r in entities.product_rows(shop, (COMPACT,)).where("store_id = 1").collect()}
    assert bodies == {"See KEEP"}


def test_registered_and_failing_sections(shop):
    def broken(catalog, formats, cleaner):
        raise RuntimeError("no")

    def news(catalog, formats, cleaner):
        at = stores.store_context(catalog).select("store_code", F.explode(F.array(*map(F.lit, formats))).alias("format"))
        return at.select("format", "store_code", F.lit(0).alias("section_ord"), F.lit(0).cast("long").alias("position"),
                         F.lit(0).cast("long").alias("entity_id"), F.lit(1).alias("items"), F.lit("## News\n").alias("text"))

    few = Sections([s for s in Sections().sections if s.name in ("store", "siblings")])
    sections = few.register_section("news", 15, (COMPACT,), news).register_section("broken", 16, (COMPACT,), broken)
    rendered, failures = sections.isolated_blocks(shop, (COMPACT,))
    assert {(f.store_code, f.format) for f in failures} == {("de", COMPACT), ("default", COMPACT)} | {
        (f.store_code, f.format) for f in failures} and all("section broken" in f.error_message for f in failures)
    found = {r["store_code"]: r["document"] for r in small_documents(rendered).collect()}
    assert "> Fine shoes\n\n## News\n## Other Available Stores" in found["default"]
    assert "off" not in found


def test_blocks_are_unique_in_order(made):
    keys = Counter((b["format"], b["store_code"], b["section_ord"], b["position"], b["entity_id"]) for b in made.collect())
    assert max(keys.values()) == 1


# values that a store sets itself


PRODUCT_VALUES = [
    (10, 1, "name", "Own shoe"), (10, 1, "price", "7.5"), (10, 2, "short_description", "<b>Kurz</b>"), (10, 1, "short_description", "<b>Kurz</b>"),
    (11, 1, "short_description", None), (11, 1, "description", "Own long"), (12, 1, "visibility", "4"), (13, 1, "status", "1"),
    (14, 1, "status", "2"), (14, 1, "status", "1"), (16, 1, "status", "2"), (10, 7, "name", "Nowhere"), (99, 1, "name", "Nothing"),
    (10, 1, "unknown", "x"), (16, 1, "name", "Off"),
]
REWRITES = [(20, 1, "product", 12, "hidden.html", 0), (21, 1, "product", 13, "disabled.html", 0), (22, 1, "category", 7, "old.html", 0)]
CATEGORY_VALUES = [
    (5, 1, "name", " Boots "), (6, 1, "description", "For <i>kids</i>"), (7, 1, "is_active", "1"), (8, 2, "name", "Other store"), (6, 1, "name", None),
]


@pytest.fixture
def own_shop(spark, shop):
    def table(values):
        return spark.createDataFrame(values, "entity_id long, store_id long, attribute string, value string")

    more = spark.createDataFrame(REWRITES, shop.rewrites.schema)
    return dataclasses.replace(shop, cache={}, product_values=table(PRODUCT_VALUES), category_values=table(CATEGORY_VALUES),
                               rewrites=shop.rewrites.unionByName(more))


def test_products_as_a_store_sees_them(own_shop):
    found = {(r["store_id"], r["entity_id"]): (r["name"], r["price"], r["body"]) for r in entities.product_rows(own_shop, (COMPACT,)).collect()}
    assert found == {
        (1, 10): ("Own shoe", 7.5, "Kurz"), (1, 11): ("Blue shoe", 15.25, "Own long"), (1, 12): ("Hidden", 1.0, "x"), (1, 13): ("Disabled", 1.0, "x"),
        (2, 10): (" Red shoe ", 9.0, "Kurz"),
    }
    seen = {(r["store_id"], r["entity_id"]): r["name"] for r in own_shop.scan_store_products("name").collect()}
    assert seen[1, 10] == "Own shoe" and seen[2, 10] == " Red shoe " and (1, 16) not in seen and (2, 16) in seen and (1, 12) in seen and (2, 12) not in seen


def test_equal_own_texts_are_cleaned_once(own_shop):
    from vitrine.operators.overrides import PRODUCT_TEXTS, text_versions
    versions = text_versions(own_shop.product_values, PRODUCT_TEXTS)
    assert {(r["entity_id"], r["n"]) for r in versions.groupBy("entity_id").agg(F.count("*").alias("n")).collect()} == {(10, 1), (11, 1)}


def test_categories_as_a_store_sees_them(own_shop):
    found = {r["entity_id"]: (r["name"], r["breadcrumb"], r["body"]) for r in entities.category_rows(own_shop, (COMPACT,)).where("store_id = 1").collect()}
    assert found[5] == (" Boots ", "Boots", "All shoes") and found[7] == ("Old", "Old", "x") and found[8] == ("Lost", "Old > Lost", "x")
    assert 6 not in found


def test_own_values_reach_the_mirror_and_the_feed(own_shop):
    from vitrine.streaming.incremental import records_of
    pages = {r["path"]: r["markdown"] for r in mirror.mirror_render(own_shop).collect()}
    assert pages["red-one.md"] == "# Own shoe\n\n> SKU: A-1 · Price: 7.50 USD\n\nKurz\n\nLong & bold\n"
    assert pages["footwear.md"] == "#  Boots \n\nAll shoes\n"
    records = [json.loads(r["value"]) for r in records_of(own_shop, "product", own_shop.products).where("store_code = 'default'").collect()]
    assert {(r["entity_id"], r["name"], r["price"]) for r in records} >= {(10, "Own shoe", 7.5), (13, "Disabled", 1.0)} and 16 not in {r["entity_id"] for r in records}


def test_texts_of_page_records_become_json_once_per_page(own_shop):
    made = blocks.page_section(own_shop, (JSONL,)).where(F.col("format") == JSONL)
    # Below the step that spreads a page over its stores.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "AS wide_json" in plan[plan.index("inline(filter("):]
    lines = {(r["store_code"], r["entity_id"]): r["text"] for r in made.collect()}
    line = blocks.json_line(blocks.page_record())
    whole = entities.page_rows(own_shop, (JSONL,)).select("store_code", "entity_id", line.alias("line")).collect()
    assert lines == {(r["store_code"], r["entity_id"]): r["line"] + "\n" for r in whole} and lines


def test_json_without_texts(spark):
    rows = spark.createDataFrame([(1, None), (2, 'a"é')], "entity_id long, body string").withColumn("format", F.lit(JSONL))
    rows = blocks._wide_json({"content": F.col("body")})(rows).withColumn("wide_json", F.when(F.col("entity_id") > 0, F.col("wide_json")))
    record = [F.lit("x").alias("entity_type"), F.col("entity_id"), *(F.lit(None).cast("string").alias(n) for n in RECORD_FIELDS[2:-4])]
    lines = {r["entity_id"]: r["line"] for r in rows.select("entity_id", blocks._either(rows, record, F.lit("")).alias("line")).collect()}
    assert lines == {1: '{"entity_type":"x","entity_id":1}\n', 2: '{"entity_type":"x","entity_id":2,"content":"a\\"é"}\n'}


def test_mirror_lookup_aggregates_rewrites_once(spark, shop):
    paths = [(1, "two.md"), (1, "both.md"), (1, "none.md"), (1, "none-first.md")]
    requests = spark.createDataFrame([*paths, *paths], "store_id long, path string")
    rewrites = spark.createDataFrame([
        (9, 1, "product", 1, "two", 0), (8, 1, "product", 2, "two", 0), (None, 1, "product", 3, "two", 0), (1, 1, "product", 4, "two.html", 0),
        (5, 1, "category", 5, "both.html", 0), (6, 1, "product", 6, "both", 0), (6, 1, "product", 6, "both", 0),
        (None, 1, "product", 7, "none", 0), (None, 1, "product", 8, "none-first", 0), (3, 1, "product", 9, "none-first.html", 0),
    ], "url_rewrite_id long, store_id long, entity_type string, entity_id long, request_path string, redirect_type int")
    found = mirror.mirror_lookup(dataclasses.replace(shop, cache={}, requests=requests, rewrites=rewrites))
    assert rows(found, "path", "entity_type", "entity_id") == [("both.md", "product", 6), ("two.md", "product", 2)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("min_by(") == 1
