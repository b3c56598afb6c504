"""A small hand-written catalog."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vitrine.constants import DEFAULT_SETTINGS
from vitrine.schemas import TABLES
from vitrine.sources.catalog import Catalog

AS_OF = dt.datetime(2024, 5, 1)

ROWS = {
    "stores": [
        (1, "default", "Main", 1, "Shop", 2, True, True, "https://shop.test/", "USD", "USD"),
        (2, "de", "Deutsch", 1, "Shop", 2, True, False, "https://shop.test/", "", "EUR"),
        (3, "off", "Closed", 1, "Shop", 2, False, False, "https://shop.test/", "USD", "USD"),
        (4, "solo", "Alone", 2, "Other", 9, True, False, "https://other.test//", "GBP", "GBP"),
    ],
    "products": [
        (10, "A-1", " Red shoe ", 10.0, "", "<p>Long &amp; <b>bold</b></p>", 1, 4),
        (11, "A-2", "Blue shoe", 20.5, "<p>Short</p>", "Long text", 1, 2),
        (12, "A-3", "Hidden", 1.0, "x", "y", 1, 1),
        (13, "A-4", "Disabled", 1.0, "x", "y", 2, 4),
        (14, "", "No price", 0.0, "0", None, 1, 3),
        (15, "A-6", "No link", 5.0, "x", "y", 1, 4),
        (16, "A-7", None, 5.0, None, "See {{store url=\"x\"}} and {{var y}} [note] end", 1, 4),
    ],
    "product_stores": [(p, s) for p in range(10, 17) for s in (1, 2, 3)],
    "product_values": [],
    "category_values": [],
    "categories": [
        (2, "Root", None, None, "1/2", True, 0),
        (5, "Shoes", "<p>All shoes</p>", "meta", "1/2/5", True, 2),
        (6, "Kids", "", "For kids", "1/2/5/6", True, 1),
        (7, "Old", "x", "x", "1/2/7", False, 1),
        (8, "Lost", "x", None, "1/2/7/8", True, 1),
        (20, "  ", "x", None, "1/2/20", True, 1),
        (30, "Elsewhere", "x", None, "1/9/30", True, 1),
        (31, "Near miss", "x", None, "1/22/31", True, 1),
    ],
    "category_products": [(5, 10), (5, 11), (5, 10), (6, 10)],
    "pages": [
        (1, "About ", "about", "<h1>About</h1><p>Us</p>", "m", True, 5),
        (2, "Meta only", "meta", "", "From meta", True, 1),
        (3, "Nowhere", "no-route", "x", "m", True, 1),
        (4, " ", "blank", "x", "m", True, 1),
        (5, "Off", "off", "x", "m", False, 1),
    ],
    "page_stores": [(1, 0), (1, 1), (2, 1), (3, 0), (4, 0), (5, 0)],
    "rewrites": [
        (1, 1, "product", 10, "red-one.html", 0),
        (2, 1, "product", 10, "red-two.html", 0),
        (3, 1, "product", 11, "/blue.html", 0),
        (4, 1, "product", 14, "free.html", 0),
        (5, 1, "product", 16, "nameless.html", 0),
        (6, 1, "product", 15, "gone.html", 301),
        (7, 2, "product", 10, "rot.html", 0),
        (8, 1, "category", 5, "footwear.html", 0),
        (9, 1, "category", 6, "footwear/kids.html", 0),
        (10, 1, "category", 8, "lost.html", 0),
        (11, 1, "category", 20, "blank.html", 0),
        (12, 1, "cms-page", 1, "about", 0),
        (13, 4, "category", 30, "else.html", 0),
        (14, 1, "custom", 10, "custom.html", 0),
        (15, 1, "product", 10, "moved", 302),
        (16, 1, "product", 11, "moved.html", 0),
    ],
    "stock": [(10, 1, 1), (11, 1, 0), (14, 1, 1)],
    "prices": [
        (10, 0, 9.0, 8.0, dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1)),
        (11, 0, None, 15.25, dt.datetime(2024, 1, 1), None),
    ],
    "countries": [("US", "United States")],
    "directives": [(1, '{{store url="x"}}', "<b>here</b>")],
    "run_log": [],
    "requests": [
        (1, "red-one.md"), (1, "/about.md"), (1, "red-one.html.md"), (1, "moved.md"), (1, "custom.md"), (1, "none.md"),
        (1, "red-one"), (1, "footwear.md"), (1, "red-one.md"), (4, "else.md"),
    ],
}

OVERRIDES = [
    ("general/country/default", "default", 0, "US"),
    ("general/country/default", "stores", 2, "DE"),
    ("general/locale/code", "stores", 2, "de_DE"),
    ("general/store_summary", "stores", 1, " Fine \n shoes "),
    ("formats/generate_llms_full_txt", "stores", 1, "1"),
    ("formats/generate_md_mirror", "stores", 1, "1"),
]


def local_frame(spark, rows, ddl):
    """Rows held in the plan, so the many small jobs of a test start no Python tasks."""
    schema = StructType.fromDDL(ddl)
    fields = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [[] for _ in fields]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, schema=fields), schema)


def small_shop(spark, overrides=(), **tables) -> Catalog:
    rows = {**ROWS, **tables}
    settings = [(path, "default", 0, value) for path, value in DEFAULT_SETTINGS.items()]
    rows["settings"] = settings + OVERRIDES + list(overrides)
    frames = {name: local_frame(spark, rows[name], ddl) for name, ddl in TABLES.items()}
    return Catalog(**frames, as_of=AS_OF)


def small_documents(blocks):
    """Whole documents as single strings."""
    joined = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("section_ord", "position", "entity_id", "text"))), lambda s: s["text"]
    ), "")
    return blocks.groupBy("store_code", "format").agg(joined.alias("document"))
