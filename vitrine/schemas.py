"""Schemas of the catalog tables, as DDL strings read by ``spark.read.schema``."""

TABLES = {
    "stores": "store_id long, store_code string, store_name string, website_id long, website_name string, "
              "root_category_id long, is_active boolean, is_default boolean, base_url string, "
              "currency_code string, default_currency_code string",
    "settings": "path string, scope string, scope_id long, value string",
    "products": "entity_id long, sku string, name string, price double, short_description string, "
                "description string, status int, visibility int",
    "product_stores": "entity_id long, store_id long",
    "product_values": "entity_id long, store_id long, attribute string, value string",
    "categories": "entity_id long, name string, description string, meta_description string, path string, "
                  "is_active boolean, position long",
    "category_values": "entity_id long, store_id long, attribute string, value string",
    "category_products": "category_id long, product_id long",
    "pages": "page_id long, title string, identifier string, content string, meta_description string, "
             "is_active boolean, sort_order long",
    "page_stores": "page_id long, store_id long",
    "rewrites": "url_rewrite_id long, store_id long, entity_type string, entity_id long, "
                "request_path string, redirect_type int",
    "stock": "product_id long, website_id long, stock_status int",
    "prices": "product_id long, group_id long, group_price double, special_price double, "
              "special_from timestamp, special_to timestamp",
    "countries": "code string, name string",
    "directives": "store_id long, token string, value string",
    "run_log": "run_id long, store_code string, format string, status string, attempted_at timestamp, "
               "byte_size long, item_count long, duration_seconds double, error_message string",
    "requests": "store_id long, path string",
}

# fixed values: the record contract. One nullable superset of the four record kinds, in output order; NULL fields are left out of the JSON.
RECORD = (
    "entity_type string, entity_id long, store_code string, store_name string, sku string, name string, "
    "title string, identifier string, url string, price double, currency string, locale string, "
    "short_description string, description string, content string, embedding_text string"
)
RECORD_FIELDS = tuple(part.split()[0] for part in RECORD.split(", "))
# Its last fields, those that hold texts.
RECORD_TEXTS = RECORD_FIELDS[-4:]
# fixed values: the record contract
RECORD_REQUIRED = ("entity_type", "entity_id", "store_code", "url", "embedding_text")
RECORD_TYPES = ("store", "category", "product", "cms_page")

# One piece of a document. Rows sort by (section_ord, position, entity_id); items counts its chunks.
BLOCK = ("format", "store_code", "section_ord", "position", "entity_id", "items", "text")
# The same as written by ``Sections.staged_blocks``, with the size of the text and a hash of the block and its place.
STAGED_BLOCK = (
    "format string, store_code string, section_ord int, position long, entity_id long, items int, text string, "
    "text_bytes int, text_print long"
)
# One planned document of a run. Runs of older versions lack the last columns.
MANIFEST = (
    "store_code string, format string, file_name string, outcome string, byte_size long, item_count long, error_message string, "
    "parts array<string>, part_sizes array<bigint>, fingerprint string"
)
