"""Formats, length caps, section order, setting paths and their defaults."""

# fixed values: output formats and the verbosity each one uses
COMPACT, FULL, JSONL = "llms_txt", "llms_full_txt", "jsonl"
FORMATS = (COMPACT, FULL, JSONL)
TEXT_FORMATS = (COMPACT, FULL)
VERBOSITY = {COMPACT: "compact", FULL: "full", JSONL: "dataset"}

# fixed values: output file name by format
FILE_STEM = {COMPACT: "llms", FULL: "llms-full", JSONL: "llms"}
FILE_EXTENSION = {COMPACT: "txt", FULL: "txt", JSONL: "jsonl"}

# fixed values: length caps in code points, by entity and format
CATEGORY_CAP = {COMPACT: 200, FULL: 4000, JSONL: 4000}
PAGE_CAP = {COMPACT: 500, FULL: 16000, JSONL: 16000}
PRODUCT_CAP = {COMPACT: 500, FULL: 5000, JSONL: 5000}
PRODUCT_SHORT_CAP = 2000
EMBEDDING_CAP = 8000

# fixed values: platform codes
STATUS_ENABLED = 1
VISIBLE = (2, 3, 4)
STOCK_IN = 1
REWRITE_TYPES = ("product", "category", "cms-page")

# fixed values: element types dropped / kept when a store lists none of its own
DEFAULT_EXCLUDED = (
    "products", "banner", "slider", "slide", "video", "map", "buttons", "button-item",
    "block", "dynamic-block", "divider", "spacer",
)
DEFAULT_ALLOWED = (
    "text", "heading", "html", "tabs", "tab-item", "row", "column", "column-group",
)

# fixed values: page identifiers left out when the setting is blank
DEFAULT_EXCLUDED_PAGES = ("no-route", "enable-cookies", "privacy-policy-cookie-restriction-mode")

# Order of the sections in a document; gaps leave room for registered sections.
STORE_ORD, SIBLINGS_ORD, CATEGORIES_ORD, PAGES_ORD, PRODUCTS_ORD = 10, 20, 30, 40, 50
# Sort positions of a section's heading and closing line around its entities.
HEADING_POS, CLOSING_POS = -(2**62), 2**62

# fixed values: setting paths and shipped defaults
DEFAULT_SETTINGS = {
    "general/enabled": "1",
    "general/exclude_store": "0",
    "general/store_summary": "",
    "content/include_categories": "1",
    "content/include_cms": "1",
    "content/include_products": "1",
    "content/products_under_optional": "1",
    "content/product_limit": "5000",
    "content/exclude_out_of_stock": "0",
    "content/cms_exclude_identifiers": "no-route,enable-cookies,privacy-policy-cookie-restriction-mode",
    "content/customer_group_id": "0",
    "formats/generate_llms_txt": "1",
    "formats/generate_llms_full_txt": "0",
    "formats/generate_jsonl": "1",
    "formats/generate_md_mirror": "0",
    "sanitizer/resolve_directives": "1",
    "sanitizer/page_builder_strategy": "exclude",
    "sanitizer/page_builder_excluded_types":
        "products,banner,slider,slide,video,map,buttons,button-item,block,dynamic-block,divider,spacer",
    "sanitizer/page_builder_allowed_types": "text,heading,html,tabs,tab-item,row,column,column-group",
    "http/cache_ttl_seconds": "3600",
    "url/append_store_code": "1",
}
# Read per store too, but with no shipped default.
PLATFORM_SETTINGS = ("general/locale/code", "general/country/default", "design/head/default_description")
