"""Reference SQL for the registered queries, for DuckDB over the base tables.

Each query is built from shared common table expressions, written apart from the Spark jobs: lookups are
plain joins, ranks are plain windows, and the cleaning chain is spelled in RE2.
"""

from __future__ import annotations

import re

from vitrine.sources.derived import COUNTRIES, SETTINGS

HEADING, CLOSING = -(2**62), 2**62


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _q(v) for v in row) + ")" for row in rows)


# fixed values: entities in the test texts, tags that read as a space, leftovers of the page editor
def decode(e: str) -> str:
    pairs = [("&trade;", "™"), ("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
    for entity, char in pairs:
        e = f"replace({e}, {_q(entity)}, {_q(char)})"
    return e


def sub(e: str, pattern: str, by: str) -> str:
    return f"regexp_replace({e}, {_q(pattern)}, {_q(by)}, 'g')"


def html(e: str) -> str:
    e = sub(decode(e), r"(?is)<style[^>]*>.*?</style>", " ")
    e = sub(e, r"(?i)</?(?:p|div|span|br|li|ul|ol|h[1-6]|blockquote|section|article|header|footer|tr|td|th)[^>]*>", " ")
    e = sub(sub(e, r"(?s)<!--.*?-->", ""), r"<[A-Za-z/!?][^>]*>", "")
    e = sub(sub(e, r"(?s)\{\{.*?\}\}", " "), r"(?s)\[.*?\]", " ")
    e = f"replace(replace({e}, '#html-body', ''), '&nbsp;', ' ')"
    return f"trim({sub(e, r'[ \t\n\v\f\r]+', ' ')}, ' ')"


def compact(e: str) -> str:
    return f"trim({sub(e, r'[\p{Z}\t\n\v\f\r\x{85}\x{180E}]+', ' ')}, ' ')"


def full(e: str) -> str:
    return f"trim({sub(sub(e, r'[ \t]+', ' '), r'\n{3,}', chr(10) * 2)}, concat(' ', chr(9), chr(10), chr(13)))"


def cut(e: str, n) -> str:
    prefix = f"regexp_extract(left({e}, {n}), '(?s)^(.*) [^ ]*$', 1)"
    kept = f"CASE WHEN length({prefix}) > {n} * 0.7 THEN {prefix} ELSE left({e}, {n}) END"
    return f"CASE WHEN length({e}) > {n} THEN rtrim({kept}, concat(' ', chr(9), chr(10), chr(13))) || '…' ELSE {e} END"


def trimmed(e: str) -> str:
    return f"trim({e}, concat(' ', chr(9), chr(10), chr(11), chr(13)))"


def blank(e: str) -> str:
    return f"({e} IS NULL OR {e} IN ('', '0'))"


def setting(path: str) -> str:
    return f"max(CASE WHEN path = '{path}' THEN value END)"


def on(path: str) -> str:
    return f"coalesce({setting(path)} NOT IN ('', '0'), false)"


def whole(path: str) -> str:
    return f"coalesce(try_cast(regexp_extract({setting(path)}, '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0)"


def listed(path: str) -> str:
    parts = f"list_transform(regexp_split_to_array(coalesce({setting(path)}, ''), '[,\\n]'), lambda x: {trimmed('x')})"
    return f"list_filter({parts}, lambda x: x NOT IN ('', '0'))"


LANG = "CASE {0} WHEN 1 THEN 'fr' WHEN 2 THEN 'es' WHEN 4 THEN 'de' ELSE 'en' END"

CTES: dict[str, str] = {
    "store": f"""
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS store_id, lower(n_name) AS store_code, n_name AS store_name,
               CAST(n_regionkey + 1 AS BIGINT) AS website_id, r_name AS website_name,
               CASE WHEN n_regionkey = 4 THEN '3' ELSE '2' END AS root, n_nationkey NOT IN (8, 17) AS is_active,
               'https://shop' || (n_regionkey + 1) || '.example.test' AS plain_url,
               CASE n_regionkey WHEN 1 THEN 'USD' WHEN 3 THEN 'EUR' ELSE 'GBP' END AS currency,
               {LANG.format("n_regionkey + 1")} AS lang
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "setting": f"SELECT * FROM (VALUES {_values(SETTINGS)}) t(path, scope, scope_id, value)",
    "country": f"SELECT * FROM (VALUES {_values(COUNTRIES)}) t(code, name)",
    "resolved": """
        SELECT store_id, p.path, coalesce(st.value, we.value, de.value) AS value
        FROM store CROSS JOIN (SELECT DISTINCT path FROM setting) p
        LEFT JOIN setting st ON st.path = p.path AND st.scope = 'stores' AND st.scope_id = store_id
        LEFT JOIN setting we ON we.path = p.path AND we.scope = 'websites' AND we.scope_id = website_id
        LEFT JOIN setting de ON de.path = p.path AND de.scope = 'default'""",
    # fixed values: setting paths, page identifiers left out by default, fallbacks
    "scoped": f"""
        SELECT store_id, {on('general/enabled')} AS enabled, {on('general/exclude_store')} AS is_excluded,
               {trimmed(f"coalesce({setting('general/store_summary')}, '')")} AS store_summary,
               {on('content/include_categories')} AS include_categories, {on('content/include_cms')} AS include_pages,
               {on('content/include_products')} AS include_products,
               {on('content/products_under_optional')} AS products_under_optional,
               greatest({whole('content/product_limit')}, 0) AS product_limit,
               {on('content/exclude_out_of_stock')} AS exclude_out_of_stock,
               CASE WHEN coalesce({setting('content/cms_exclude_identifiers')}, '') = ''
                    THEN ['no-route', 'enable-cookies', 'privacy-policy-cookie-restriction-mode']
                    ELSE {listed('content/cms_exclude_identifiers')} END AS excluded_pages,
               {whole('content/customer_group_id')} AS customer_group_id,
               {on('formats/generate_llms_txt')} AS compact_enabled, {on('formats/generate_llms_full_txt')} AS full_enabled,
               {on('formats/generate_jsonl')} AS jsonl_enabled, {on('formats/generate_md_mirror')} AS mirror_enabled,
               {on('sanitizer/resolve_directives')} AS resolve_directives,
               CASE WHEN coalesce({setting('sanitizer/page_builder_strategy')}, '') = '' THEN 'preserve'
                    ELSE {setting('sanitizer/page_builder_strategy')} END AS strategy,
               array_to_string({listed('sanitizer/page_builder_excluded_types')}, ',') AS excluded_types,
               array_to_string({listed('sanitizer/page_builder_allowed_types')}, ',') AS allowed_types,
               CASE WHEN {whole('http/cache_ttl_seconds')} > 0 THEN {whole('http/cache_ttl_seconds')} ELSE 3600 END AS cache_ttl_seconds,
               {on('url/append_store_code')} AS append_store_code,
               CASE WHEN coalesce({setting('general/locale/code')}, '') = '' THEN 'en-US'
                    ELSE replace({setting('general/locale/code')}, '_', '-') END AS locale,
               coalesce({setting('general/country/default')}, '') AS country_code,
               coalesce({setting('design/head/default_description')}, '') AS meta_description
        FROM resolved GROUP BY store_id""",
    "ctx": """
        SELECT *, plain_url || CASE WHEN append_store_code AND store_id <> 1 THEN '/' || store_code ELSE '' END AS link_url,
               is_active AND NOT is_excluded AS eligible
        FROM store JOIN scoped USING (store_id)""",
    "doc": """
        SELECT ctx.*, format FROM ctx
        JOIN (VALUES ('llms_txt'), ('llms_full_txt'), ('jsonl')) f(format)
          ON eligible AND CASE format WHEN 'llms_txt' THEN compact_enabled WHEN 'llms_full_txt' THEN full_enabled ELSE jsonl_enabled END""",
    "item": """
        SELECT coalesce(p_partkey, doc_id) AS entity_id, concat_ws('-', p_brand, p_partkey) AS sku, p_name AS name,
               p_retailprice AS price, p_size,
               CASE WHEN p_size > 25 THEN '<p>' || p_name || ' &middot; ' || p_brand || '&trade;, size ' || p_size || '</p>'
                    WHEN p_size <= 5 THEN '0' END AS short_description,
               CASE WHEN source IN ('src3', 'src7', 'src11')
                    THEN '<div data-content-type="row" class="wide"><div data-content-type="text"><p>' || text
                         || '</p></div><div data-content-type="products">See also: <b>' || coalesce(p_name, 'more') || '</b></div></div>'
                    WHEN source IN ('src5', 'src15') THEN text || ' {{store url="' || coalesce(lang, 'es') || '"}} {{var missing}}'
                    ELSE '<p>' || replace(text, chr(10), '</p>' || chr(10) || '<p>') || '</p>' END AS description,
               coalesce(p_size <> 13, true) AND coalesce(p_size NOT BETWEEN 40 AND 43, true) AS shown,
               coalesce(lang, 'es') AS lang
        FROM part FULL JOIN documents ON p_partkey = doc_id""",
    "item_store": "SELECT entity_id, store_id FROM item JOIN store USING (lang)",
    # items and shelves as a store sees them
    "item_seen": """
        SELECT entity_id, store_id, sku, p_size,
               CASE WHEN entity_id % 11 = 0 AND (entity_id + store_id) % 4 = 0 THEN 'Local ' || coalesce(name, 'item') ELSE name END AS name,
               CASE WHEN entity_id % 19 = 0 AND store_id % 2 = 0 THEN CAST(entity_id % 100 + 1 AS DOUBLE) ELSE price END AS price,
               CASE WHEN entity_id % 17 = 0 AND store_id % 5 = 2 THEN NULL ELSE short_description END AS short_description,
               CASE WHEN entity_id % 13 = 0 AND store_id % 3 = 1 THEN '<p>Only here {{store url="' || lang || '"}}</p>'
                    ELSE description END AS description,
               CASE WHEN coalesce(p_size = 13, false) THEN store_id % 3 = 0 ELSE NOT (entity_id % 23 = 0 AND store_id % 6 = 0) END
               AND CASE WHEN entity_id % 29 = 0 AND store_id % 4 = 1 THEN false
                        WHEN coalesce(p_size BETWEEN 40 AND 43, false) THEN store_id % 5 = 0 ELSE true END AS shown
        FROM item JOIN item_store USING (entity_id)""",
    "shelf_seen": """
        SELECT entity_id, store_id, root, parent, position,
               CASE WHEN entity_id % 3 = 0 AND store_id % 4 = 0 THEN ' Local ' || name ELSE name END AS name,
               CASE WHEN entity_id % 5 = 0 AND store_id % 2 = 0 THEN '<p>Only here &amp; now</p>' ELSE description END AS description,
               CASE WHEN entity_id % 5 = 1 AND store_id % 3 = 2 THEN 'Own <b>meta</b>' ELSE shelf.meta_description END AS meta_description,
               CASE WHEN large AND store_id % 5 = 0 THEN true WHEN entity_id % 7 = 0 AND store_id % 3 = 0 THEN false ELSE shelf.is_active END AS is_active
        FROM shelf JOIN store USING (root)""",
    "crumb_seen": """
        SELECT s.store_id, s.entity_id, coalesce(CASE WHEN p.is_active THEN trim(p.name) ELSE CAST(s.parent AS VARCHAR) END || ' > ', '')
               || trim(s.name) AS breadcrumb
        FROM shelf_seen s LEFT JOIN shelf_seen p ON p.store_id = s.store_id AND p.entity_id = s.parent""",
    "shelf_id": """
        SELECT p_type, p_brand, b.id AS brand_id, t.id AS type_id, b.n, low, high, t.n AS type_n
        FROM (SELECT p_type, p_brand, min(p_partkey) * 2 + 11 AS id, count(*) AS n, min(p_size) AS low, max(p_size) AS high
              FROM part GROUP BY ALL) b
        JOIN (SELECT p_type, min(p_partkey) * 2 + 10 AS id, count(*) AS n FROM part GROUP BY ALL) t USING (p_type)""",
    "shelf": """
        SELECT DISTINCT type_id AS entity_id, p_type AS name, CAST(NULL AS VARCHAR) AS description,
               'All ' || lower(p_type) || ' parts &copy; shop' AS meta_description,
               CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN '3' ELSE '2' END AS root, CAST(NULL AS BIGINT) AS parent,
               p_type <> 'LARGE' AS is_active, p_type = 'LARGE' AS large, type_n AS position, 'c/' || lower(p_type) || '.html' AS slug
        FROM shelf_id
        UNION ALL
        SELECT brand_id, CASE WHEN p_brand = 'Brand#7' THEN '  ' ELSE p_brand END,
               CASE WHEN p_brand = 'Brand#20' THEN '0' ELSE '<p>' || p_brand || ' ' || lower(p_type) || ': ' || n
                    || ' parts,<br>sizes ' || low || ' to ' || high || '</p>' END,
               p_brand || ' &amp; friends', CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN '3' ELSE '2' END, type_id,
               p_brand <> 'Brand#13', p_type = 'LARGE', n,
               CASE WHEN p_brand <> 'Brand#19' THEN 'c/' || lower(p_type) || '/' || lower(replace(p_brand, '#', '-')) || '.html' END
        FROM shelf_id""",
    "shelf_count": """
        SELECT category_id, count(DISTINCT product_id) AS product_count FROM (
            SELECT brand_id AS category_id, p_partkey AS product_id FROM part JOIN shelf_id USING (p_type, p_brand)
            UNION ALL
            SELECT type_id, p_partkey FROM part JOIN shelf_id USING (p_type, p_brand) WHERE p_size > 45)
        GROUP BY category_id""",
    "crumb": """
        SELECT s.entity_id, coalesce(CASE WHEN p.is_active THEN trim(p.name) ELSE CAST(s.parent AS VARCHAR) END || ' > ', '')
               || trim(s.name) AS breadcrumb
        FROM shelf s LEFT JOIN shelf p ON s.parent = p.entity_id WHERE s.is_active""",
    "web": """
        SELECT page_id AS entity_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, 'page-' || page_id AS identifier,
               CASE WHEN contains(url, 'spam-farm') THEN '' ELSE html END AS content,
               'Page at ' || url || ' &copy; archive' AS meta_description, url NOT LIKE '%#top' AS is_active,
               length(url) AS position, url, regexp_extract(html, '<html lang="([a-z-]*)"', 1) AS lang
        FROM pages""",
    "web_store": "SELECT entity_id, store_id FROM web JOIN store ON web.lang = 'es' OR web.lang = store.lang",
    "rewrite": """
        SELECT i.entity_id * 10 + k AS url_rewrite_id, store_id, kind AS entity_type, i.entity_id, request_path, redirect_type
        FROM (
            SELECT entity_id, 5 AS k, 'product' AS kind, 0 AS redirect_type, CASE WHEN p_size = 5 THEN '/' ELSE '' END
                   || replace(coalesce(name, 'item'), ' ', '-') || '-' || entity_id || '.html' AS request_path
            FROM item WHERE coalesce(p_size, 0) <> 49
            UNION ALL SELECT entity_id, 6, 'product', 0, 'alias/' || entity_id FROM item WHERE p_size IN (10, 20, 30)
            UNION ALL SELECT entity_id, 4, 'product', 301, 'old-' || entity_id || '.html' FROM item WHERE p_size IN (7, 8)
            UNION ALL SELECT entity_id, 7, 'custom', 0, 'custom-' || entity_id FROM item WHERE p_size = 11) i
        JOIN item_store USING (entity_id)
        UNION ALL
        SELECT entity_id * 10 + 1, store_id, 'category', entity_id, slug, 0 FROM shelf JOIN store USING (root) WHERE slug IS NOT NULL
        UNION ALL
        SELECT entity_id * 10 + 2, store_id, 'cms-page', entity_id, 'page/' || entity_id, 0
        FROM web_store JOIN web USING (entity_id) WHERE NOT contains(url, '?')""",
    "canonical": """
        SELECT store_id, entity_type, entity_id, request_path FROM (
            SELECT *, row_number() OVER (PARTITION BY store_id, entity_type, entity_id ORDER BY url_rewrite_id) AS rn
            FROM rewrite WHERE entity_type IN ('product', 'category', 'cms-page') AND redirect_type = 0)
        WHERE rn = 1""",
    "link": """
        SELECT store_id, entity_type, entity_id, link_url || '/' || ltrim(request_path, '/') AS url
        FROM canonical JOIN ctx USING (store_id)""",
    "stock": """
        SELECT l_partkey AS entity_id, CAST(n_regionkey + 1 AS BIGINT) AS website_id, sum(l_quantity) >= 100 AS stocked
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
    "tariff": """
        SELECT l_partkey AS entity_id, CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS customer_group_id,
               floor(any_value(p_retailprice) * (1 - max(l_discount)) * 100) / 100 AS group_price,
               CASE WHEN TIMESTAMP '1998-06-01' BETWEEN min(l_shipdate) AND max(l_shipdate) THEN any_value(p_retailprice) * 0.9::DOUBLE END AS special
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "stocked": """
        SELECT ctx.*, item.entity_id, sku, name, price, short_description, description, url, coalesce(stocked, true) AS in_stock
        FROM item_seen item JOIN ctx USING (store_id)
        JOIN link ON link.store_id = ctx.store_id AND link.entity_id = item.entity_id AND entity_type = 'product'
        LEFT JOIN stock ON stock.entity_id = item.entity_id AND stock.website_id = ctx.website_id
        WHERE shown AND eligible AND include_products AND (compact_enabled OR full_enabled OR jsonl_enabled)
          AND (NOT exclude_out_of_stock OR coalesce(stocked, true))""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY entity_id) AS rn FROM stocked",
    "sale": """
        SELECT r.* EXCLUDE (price), least(price, group_price, special) AS price
        FROM ranked r LEFT JOIN tariff t ON t.entity_id = r.entity_id AND t.customer_group_id = r.customer_group_id
        WHERE product_limit = 0 OR rn <= product_limit""",
    # texts as a store sees them: directives resolved and marked elements dropped, then the HTML stage
    "sale_text": f"""
        SELECT *, {html("coalesce(short_description, '')")} AS short_h, {html("coalesce(seen, '')")} AS long_h
        FROM (SELECT *, CASE
                WHEN contains(description, 'data-content-type=') THEN
                     CASE WHEN strategy = 'preserve' THEN description
                          WHEN strategy = 'strip' THEN ''
                          WHEN strategy = 'exclude' AND excluded_types = 'text'
                          THEN regexp_replace(description, '(?s)<div data-content-type="text">.*?</p></div>', '')
                          ELSE regexp_replace(description, '<div data-content-type="products">.*?</b></div>', '') END
                WHEN resolve_directives
                THEN replace(description, '{{{{store url="' || lang || '"}}}}', '<a href="/">' || store_name || ' home</a>')
                ELSE description END AS seen FROM sale)""",
    "sale_body": f"""
        SELECT *, CASE WHEN {blank("short_description")} THEN long_h ELSE short_h END AS body_h FROM sale_text""",
    "shelf_list": """
        SELECT ctx.* EXCLUDE (meta_description), s.* EXCLUDE (root, is_active, store_id), url, breadcrumb, coalesce(product_count, 0) AS product_count
        FROM shelf_seen s JOIN ctx ON ctx.store_id = s.store_id
        JOIN link ON link.store_id = ctx.store_id AND link.entity_id = s.entity_id AND entity_type = 'category'
        LEFT JOIN crumb_seen crumb ON crumb.entity_id = s.entity_id AND crumb.store_id = s.store_id
        LEFT JOIN shelf_count ON category_id = s.entity_id
        WHERE s.is_active AND trim(s.name) <> '' AND eligible AND include_categories
          AND (compact_enabled OR full_enabled OR jsonl_enabled)""",
    "page_list": """
        SELECT ctx.* EXCLUDE (meta_description), w.* EXCLUDE (is_active, lang, url), coalesce(link.url, plain_url || '/' || identifier) AS url
        FROM web w JOIN web_store USING (entity_id) JOIN ctx ON ctx.store_id = web_store.store_id
        LEFT JOIN link ON link.store_id = ctx.store_id AND link.entity_id = w.entity_id AND entity_type = 'cms-page'
        WHERE w.is_active AND trim(title) <> '' AND NOT list_contains(excluded_pages, identifier)
          AND eligible AND include_pages AND (compact_enabled OR full_enabled OR jsonl_enabled)""",
    "page_text": f"SELECT entity_id, {html('content')} AS content_h, {html('meta_description')} AS meta_h FROM web",
    "sibling": """
        SELECT a.store_code, a.store_id, a.website_name, b.store_id AS sibling_id, b.store_name AS sibling_name,
               b.link_url || '/llms.txt' AS sibling_url
        FROM ctx a JOIN ctx b ON a.website_id = b.website_id AND a.store_id <> b.store_id AND b.eligible""",
    "heading": """SELECT * FROM (VALUES (%d, false), (%d, true)) h(position, closing)""" % (HEADING, CLOSING),
    "store_block": """
        SELECT format, store_code, 10 AS section_ord, 0 AS position, 0 AS entity_id, 5 AS items,
               '# LLMs.txt - ' || website_name || ' - ' || store_name || ' ' || chr(10) || chr(10)
               || '> Store: ' || website_name || ' - ' || store_name || chr(10)
               || '> Country: ' || coalesce(name, country_code) || chr(10)
               || '> Currency: ' || currency || chr(10) || chr(10) || '> '
               || CASE WHEN store_summary <> '' THEN trim(regexp_replace(store_summary, '\\s+', ' ', 'g'))
                       WHEN trim(meta_description) <> '' THEN trim(regexp_replace(meta_description, '\\s+', ' ', 'g'))
                       ELSE 'Online store — ' || currency || ', ' || locale END || chr(10) || chr(10) AS text
        FROM doc LEFT JOIN country ON code = country_code WHERE format <> 'jsonl'""",
    "sibling_block": """
        SELECT format, store_code, 20 AS section_ord, 0 AS position, sibling_id AS entity_id, 1 AS items,
               '- [' || sibling.website_name || ' - ' || sibling_name || '](' || sibling_url || ')' || chr(10) AS text
        FROM sibling JOIN doc USING (store_code) WHERE format <> 'jsonl'
        UNION ALL
        SELECT DISTINCT format, store_code, 20, position, 0, 1,
               CASE WHEN closing THEN chr(10) ELSE '## Other Available Stores' || chr(10) || chr(10) END
        FROM sibling JOIN doc USING (store_code) CROSS JOIN heading WHERE format <> 'jsonl'""",
    "shelf_body": f"""
        SELECT format, l.*, {cut("body", "cap")} AS short_body FROM (
            SELECT format, s.*, CASE format WHEN 'llms_txt' THEN 200 ELSE 4000 END AS cap,
                   CASE format WHEN 'llms_txt' THEN {compact("h")} ELSE {full("h")} END AS body
            FROM (SELECT doc.format, shelf_list.*,
                         {html(f"CASE WHEN {blank('description')} THEN shelf_list.meta_description ELSE description END")} AS h
                  FROM shelf_list JOIN doc USING (store_id) WHERE format <> 'jsonl') s) l""",
    "shelf_block": """
        SELECT format, store_code, 30 AS section_ord, position, entity_id, CASE WHEN short_body <> '' THEN 6 ELSE 5 END AS items,
               '### ' || trim(name) || chr(10) || 'Path: ' || breadcrumb || chr(10) || 'URL: ' || url || chr(10)
               || 'Product Count: ' || product_count || chr(10)
               || CASE WHEN short_body <> '' THEN 'Description: ' || short_body || chr(10) ELSE '' END || chr(10) AS text
        FROM shelf_body
        UNION ALL
        SELECT DISTINCT format, store_code, 30, heading.position, 0, 1,
               CASE WHEN closing THEN chr(10) ELSE '## Categories' || chr(10) || chr(10) END
        FROM shelf_body CROSS JOIN heading""",
    "page_body": f"""
        SELECT *, {cut("body", "cap")} AS short_body FROM (
            SELECT format, p.*, CASE format WHEN 'llms_txt' THEN 500 ELSE 16000 END AS cap,
                   CASE format WHEN 'llms_txt' THEN {compact("h")} ELSE {full("h")} END AS body
            FROM (SELECT doc.format, page_list.*, CASE WHEN content = '' THEN meta_h ELSE content_h END AS h
                  FROM page_list JOIN page_text USING (entity_id) JOIN doc USING (store_id) WHERE format <> 'jsonl') p)""",
    "page_block": """
        SELECT format, store_code, 40 AS section_ord, position, entity_id, CASE WHEN short_body <> '' THEN 4 ELSE 3 END AS items,
               '### ' || trim(title) || chr(10) || 'URL: ' || url || chr(10)
               || CASE WHEN short_body <> '' THEN 'Content: ' || short_body || chr(10) ELSE '' END || chr(10) AS text
        FROM page_body
        UNION ALL
        SELECT DISTINCT format, store_code, 40, heading.position, 0, 1,
               CASE WHEN closing THEN chr(10) ELSE '## Pages' || chr(10) || chr(10) END
        FROM page_body CROSS JOIN heading""",
    "sale_out": f"""
        SELECT *, {cut("body", "cap")} AS short_body FROM (
            SELECT doc.format, sale_body.*, CASE doc.format WHEN 'llms_txt' THEN 500 ELSE 5000 END AS cap,
                   CASE doc.format WHEN 'llms_txt' THEN {compact("body_h")} ELSE {full("body_h")} END AS body
            FROM sale_body JOIN doc USING (store_id) WHERE doc.format <> 'jsonl')""",
    "sale_block": """
        SELECT format, store_code, 50 AS section_ord, 0 AS position, entity_id, 1 AS items,
               '### ' || coalesce(name, '') || chr(10) || CASE WHEN sku <> '' THEN 'SKU: ' || sku || chr(10) ELSE '' END
               || 'URL: ' || url || chr(10)
               || CASE WHEN price > 0 THEN 'Price: ' || printf('%.2f', price) || ' ' || currency || chr(10) ELSE '' END
               || 'In Stock: ' || CASE WHEN in_stock THEN 'Yes' ELSE 'No' END || chr(10)
               || CASE WHEN short_body <> '' THEN 'Description: ' || short_body || chr(10) ELSE '' END || chr(10) AS text
        FROM sale_out
        UNION ALL
        SELECT DISTINCT format, store_code, 50, heading.position, 0,
               CASE WHEN NOT closing AND format = 'llms_txt' AND products_under_optional THEN 2 ELSE 1 END,
               CASE WHEN closing THEN chr(10)
                    WHEN format = 'llms_txt' AND products_under_optional THEN '## Optional' || chr(10) || chr(10) || '### Products' || chr(10) || chr(10)
                    ELSE '## Products' || chr(10) || chr(10) END
        FROM sale_out CROSS JOIN heading""",
    "block": """
        SELECT * FROM store_block UNION ALL SELECT * FROM sibling_block UNION ALL SELECT * FROM shelf_block
        UNION ALL SELECT * FROM page_block UNION ALL SELECT * FROM sale_block""",
    "run": """
        SELECT event_id AS run_id, 'nation_' || c_nationkey AS store_code,
               CASE WHEN hour(ts) < 8 THEN 'llms_txt' WHEN hour(ts) < 16 THEN 'llms_full_txt' ELSE 'jsonl' END AS format,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ts AS attempted_at,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value * 1000) AS BIGINT) END AS byte_size,
               CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '\\d+') AS BIGINT) END AS item_count,
               CASE WHEN event_type <> 'error' THEN value / 8 END AS duration_seconds,
               CASE WHEN event_type = 'error' THEN 'failed: ' || props END AS error_message
        FROM events JOIN customer ON user_id = c_custkey""",
    "run_state": """
        SELECT *, last_value(CASE WHEN status = 'success' THEN run_id END IGNORE NULLS) OVER w AS good_run,
               row_number() OVER (PARTITION BY store_code, format ORDER BY attempted_at DESC, run_id DESC) AS back
        FROM run WINDOW w AS (PARTITION BY store_code, format ORDER BY attempted_at, run_id ROWS UNBOUNDED PRECEDING)""",
    "history": """
        SELECT s.run_id, s.store_code, s.format, s.status, s.attempted_at, g.attempted_at AS last_success_at,
               coalesce(g.byte_size, 0) AS byte_size, coalesce(g.item_count, 0) AS item_count,
               coalesce(g.duration_seconds, 0.0) AS duration_seconds, s.error_message, back
        FROM run_state s LEFT JOIN run g ON g.run_id = s.good_run""",
    "request": """
        SELECT store_id, regexp_replace(request_path, '\\.html$', '') || '.md' AS path FROM rewrite
        UNION SELECT store_id, '/' || request_path || '.md' FROM rewrite""",
    "target": """
        SELECT r.store_id, r.path, coalesce(a.entity_type, b.entity_type) AS entity_type, coalesce(a.entity_id, b.entity_id) AS entity_id
        FROM (SELECT *, ltrim(left(path, length(path) - 3), '/') AS bare FROM request) r
        JOIN ctx ON ctx.store_id = r.store_id AND enabled AND NOT is_excluded AND mirror_enabled
        LEFT JOIN rewrite a ON a.store_id = r.store_id AND a.request_path = bare
        LEFT JOIN rewrite b ON b.store_id = r.store_id AND b.request_path = bare || '.html'
        WHERE coalesce(a.redirect_type, b.redirect_type) = 0""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the expressions it needs, in dependency order."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.I):
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in order) + "\n" + body


SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(13))"
JSON_DOC = "JOIN doc ON doc.store_id = {0}.store_id AND doc.format = 'jsonl'"


def _product_records(source: str) -> str:
    return f"""
        SELECT *, left(trim(name || chr(10) || short_description || chr(10) || description, {SPACES}), 8000) AS embedding_text
        FROM (SELECT 'product' AS entity_type, entity_id, s.store_code, s.store_name, sku, coalesce(name, '') AS name, url,
                     coalesce(price, 0.0) AS price, s.currency, {cut("short_f", 2000)} AS short_description, {cut("long_f", 5000)} AS description
              FROM (SELECT t.*, {full("short_h")} AS short_f, {full("long_h")} AS long_f FROM {source} t) s {JSON_DOC.format("s")})"""


def _pruned(rule: str) -> str:
    dropped = {
        "exclude|": ('<div data-content-type="products">.*?</b></div>', ""),
        "strip|": ("(?s)<div data-content-type=\"row\".*</div></div>", ""),
        "allow|row,text": ('<div data-content-type="products">.*?</b></div>', ""),
        "exclude|text": ('(?s)<div data-content-type="text">.*?</p></div>', ""),
    }
    if rule not in dropped:
        return "description"
    pattern, by = dropped[rule]
    return f"regexp_replace(description, {_q(pattern)}, {_q(by)})"


def _bytes(n: str) -> str:
    return (f"CASE WHEN {n} >= 1048576 THEN printf('%.1f', {n} / 1048576.0) || ' MB' "
            f"WHEN {n} >= 1024 THEN printf('%.1f', {n} / 1024.0) || ' KB' ELSE {n} || ' B' END")


STRING_FIELDS = (
    "entity_type", "store_code", "store_name", "sku", "name", "title", "identifier", "url", "currency", "locale",
    "short_description", "description", "content", "embedding_text",
)
REQUIRED = ("entity_type", "entity_id", "store_code", "url", "embedding_text")


def _contract() -> str:
    """Rules over all test lines. Produced records are valid, so their number is counted from the tables."""
    def kind(f):
        return f"json_type(line, '$.{f}')"

    def string(f):
        return f"json_extract_string(line, '$.{f}')"

    known = ", ".join(_q(f) for f in (*STRING_FIELDS, "entity_id", "price"))
    number = f"({kind('price')} IN ('UBIGINT', 'BIGINT', 'DOUBLE'))"
    rules = [(f"missing {f}", f"NOT list_contains(json_keys(line), '{f}')") for f in REQUIRED]
    rules += [(f"{f} not a string", f"{kind(f)} <> 'VARCHAR'") for f in STRING_FIELDS]
    rules += [
        ("unknown key", f"len(list_filter(json_keys(line), lambda k: k NOT IN ({known}))) > 0"),
        ("entity_type not known", f"{string('entity_type')} NOT IN ('store', 'category', 'product', 'cms_page')"),
        ("entity_id not a whole number", f"{kind('entity_id')} NOT IN ('UBIGINT', 'BIGINT')"),
        ("entity_id below 0", f"CAST({string('entity_id')} AS BIGINT) < 0"),
        ("store_code empty", f"{string('store_code')} = ''"),
        ("currency not three letters", f"NOT regexp_full_match({string('currency')}, '[A-Z]{{3}}')"),
        ("price not a number", f"NOT {number}"),
        ("price below 0", f"{number} AND CAST({string('price')} AS DOUBLE) < 0"),
    ]
    cases = ", ".join(f"CASE WHEN {test} THEN {_q(name)} END" for name, test in rules)
    return f"""
        SELECT rule, CAST(sum(n) AS BIGINT) AS records FROM (
            SELECT unnest(CASE WHEN len(found) = 0 THEN ['valid'] ELSE found END) AS rule, 1 AS n FROM (
                SELECT list_filter([{cases}], lambda x: x IS NOT NULL) AS found FROM (
                    SELECT props AS line FROM events
                    UNION ALL
                    SELECT to_json(struct_pack(entity_type := event_type, entity_id := event_id - user_id * 50, store_code := '', url := user_id,
                           currency := upper(left(event_type, 4)), price := value - 10, embedding_text := props)) FROM events WHERE event_type <> 'view'
                    UNION ALL
                    SELECT to_json(struct_pack(entity_type := event_type, entity_id := event_id - user_id * 50, store_code := '', url := user_id,
                           currency := upper(left(event_type, 4)), price := value - 10)) FROM events WHERE event_type = 'view'))
            UNION ALL SELECT 'valid', count(*) FROM made
            UNION ALL SELECT 'not an object', count(*) FROM (SELECT unnest(string_split(text, chr(10))) FROM documents))
        GROUP BY rule HAVING sum(n) > 0"""


MADE = {
    "made": """
        SELECT doc.store_code, 'product' AS entity_type, entity_id FROM sale JOIN doc USING (store_id) WHERE doc.format = 'jsonl'
        UNION ALL SELECT doc.store_code, 'category', entity_id FROM shelf_list JOIN doc USING (store_id) WHERE doc.format = 'jsonl'
        UNION ALL SELECT doc.store_code, 'cms_page', entity_id FROM page_list JOIN doc USING (store_id) WHERE doc.format = 'jsonl'
        UNION ALL SELECT store_code, 'store', store_id FROM doc WHERE format = 'jsonl'""",
    "sized": """
        SELECT store_code, format, CAST(sum(n) AS BIGINT) AS byte_size, CAST(sum(items) AS BIGINT) AS item_count FROM (
            SELECT store_code, format, strlen(text) AS n, items FROM block
            UNION ALL SELECT store_code, 'jsonl', strlen(to_json(r)) + 1, 1 FROM product_record r
            UNION ALL SELECT store_code, 'jsonl', strlen(to_json(r)) + 1, 1 FROM shelf_record r
            UNION ALL SELECT store_code, 'jsonl', strlen(to_json(r)) + 1, 1 FROM page_record r
            UNION ALL SELECT store_code, 'jsonl', strlen(to_json(r)) + 1, 1 FROM store_record r)
        GROUP BY ALL""",
    "outcome": """
        SELECT store_code, format, CASE format WHEN 'llms_full_txt' THEN 'llms-full_' ELSE 'llms_' END || store_code
               || CASE format WHEN 'jsonl' THEN '.jsonl' ELSE '.txt' END AS file_name,
               CASE WHEN doc.store_id IS NULL THEN 'skipped' WHEN lost THEN 'failed' ELSE 'generated' END AS outcome,
               CASE WHEN doc.store_id IS NOT NULL AND NOT lost THEN coalesce(byte_size, 0) END AS byte_size,
               CASE WHEN doc.store_id IS NOT NULL AND NOT lost THEN coalesce(item_count, 0) END AS item_count,
               CASE WHEN doc.store_id IS NOT NULL AND lost THEN 'broken' END AS error_message
        FROM (SELECT store_code, format, store_id % 4 = 1 AND format = 'jsonl' AS lost
              FROM store CROSS JOIN (VALUES ('llms_txt'), ('llms_full_txt'), ('jsonl')) f(format)) s
        LEFT JOIN (SELECT store_id, store_code, format FROM doc) doc USING (store_code, format) LEFT JOIN sized USING (store_code, format)""",
    "unlimited": """
        SELECT r.* EXCLUDE (price), least(price, group_price, special) AS price
        FROM ranked r LEFT JOIN tariff t ON t.entity_id = r.entity_id AND t.customer_group_id = r.customer_group_id""",
    # every line of the compact documents and of the text table, numbered in order
    "lint_line": r"""
        SELECT store_code, row_number() OVER (PARTITION BY store_code ORDER BY section_ord, position, entity_id, n) AS pos, line FROM (
            SELECT store_code, section_ord, position, entity_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
            FROM (SELECT *, string_split(regexp_replace(text, '\n$', ''), chr(10)) AS parts FROM block WHERE format = 'llms_txt'))
        UNION ALL
        SELECT 'doc-' || doc_id, generate_subscripts(parts, 1), unnest(parts)
        FROM (SELECT doc_id, string_split('> ' || source || chr(10) || text, chr(10)) AS parts FROM documents)""",
}
# Products after all changes: entities with a new name, a new status, back again; removed ones are gone.
MADE["changed_seen"] = """
    SELECT s.* EXCLUDE (name, shown),
           CASE WHEN entity_id % 11 = 0 AND (entity_id + store_id) % 4 = 0 THEN s.name WHEN entity_id % 10 = 0 THEN i.name
                WHEN entity_id % 7 = 0 THEN 'Second ' || coalesce(i.name, 'item') WHEN entity_id % 5 = 0 THEN 'First' ELSE i.name END AS name,
           CASE WHEN coalesce(s.p_size = 13, false) AND store_id % 3 = 0 THEN true
                WHEN coalesce(s.p_size <> 13, true) AND entity_id % 23 = 0 AND store_id % 6 = 0 THEN false
                WHEN s.p_size = 13 AND entity_id % 23 = 0 AND store_id % 6 = 0 THEN false
                WHEN entity_id % 10 = 0 THEN true WHEN entity_id % 5 = 0 THEN false ELSE coalesce(s.p_size <> 13, true) END
           AND CASE WHEN entity_id % 29 = 0 AND store_id % 4 = 1 THEN false
                    WHEN coalesce(s.p_size BETWEEN 40 AND 43, false) THEN store_id % 5 = 0 ELSE true END AS shown
    FROM item_seen s JOIN item i USING (entity_id) WHERE entity_id % 9 <> 0"""
MADE["changed_stocked"] = CTES["stocked"].replace("FROM item_seen item", "FROM changed_seen item")
MADE["changed_ranked"] = CTES["ranked"].replace("FROM stocked", "FROM changed_stocked")
MADE["changed_sale"] = MADE["unlimited"].replace("FROM ranked", "FROM changed_ranked")
MADE["changed_text"] = CTES["sale_text"].replace("FROM sale)", "FROM changed_sale)")
MADE["product_record"] = _product_records("sale_text")
MADE["shelf_record"] = f"""
    SELECT *, left(trim(name || chr(10) || description, {SPACES}), 8000) AS embedding_text
    FROM (SELECT 'category' AS entity_type, entity_id, store_code, store_name, name, url, {cut("f", 4000)} AS description
          FROM (SELECT entity_id, s.store_code, s.store_name, trim(name) AS name, url, {full(html("coalesce(description, '')"))} AS f
                FROM shelf_list s {JSON_DOC.format("s")}))"""
MADE["page_record"] = f"""
    SELECT *, left(trim(title || chr(10) || content, {SPACES}), 8000) AS embedding_text
    FROM (SELECT 'cms_page' AS entity_type, entity_id, store_code, store_name, title, identifier, url, {cut("f", 16000)} AS content
          FROM (SELECT s.entity_id, s.store_code, s.store_name, trim(title) AS title, identifier, url, {full("content_h")} AS f
                FROM page_list s JOIN page_text USING (entity_id) {JSON_DOC.format("s")}))"""
MADE["store_record"] = """
    SELECT 'store' AS entity_type, store_id AS entity_id, store_code, store_name, plain_url AS url, currency, locale,
           store_name || ' ' || plain_url AS embedding_text FROM doc WHERE format = 'jsonl'"""
MADE["unreadable"] = """
    SELECT DISTINCT s.entity_id FROM sale_text s JOIN doc ON doc.store_id = s.store_id AND doc.format = 'jsonl'
    WHERE regexp_matches(short_h, 'Brand#10™, size (31|50)$') OR regexp_matches(long_h, 'Brand#10™, size (31|50)$')"""
MADE["hashed_text"] = """
    SELECT s.* REPLACE (CASE WHEN u.entity_id IS NULL THEN regexp_replace(short_h, '[0-9]', '#', 'g') ELSE short_h END AS short_h,
                        CASE WHEN u.entity_id IS NULL THEN regexp_replace(long_h, '[0-9]', '#', 'g') ELSE long_h END AS long_h)
    FROM sale_text s LEFT JOIN unreadable u ON u.entity_id = s.entity_id"""
MADE["unlimited_text"] = CTES["sale_text"].replace("FROM sale)", "FROM unlimited)")


FILE_NAME = "CASE format WHEN 'llms_full_txt' THEN 'llms-full_' ELSE 'llms_' END || store_code || CASE format WHEN 'jsonl' THEN '.jsonl' ELSE '.txt' END"


def statements() -> dict[str, str]:
    block = "format, store_code, section_ord, position, entity_id, items, text"
    pages_clean = f"SELECT page_id, {html('html')} AS h FROM pages"
    lint = """
        SELECT store_code, starts_with(first_line, '# ') AS h1_present, n AS blockquotes,
           CASE n WHEN 0 THEN 'none' WHEN 1 THEN 'single' ELSE 'multiple' END AS summary_check,
           CASE WHEN starts_with(first_line, '# ') THEN 0 ELSE 1 END AS errors
        FROM (SELECT store_code, min_by(line, pos) FILTER (trim(line) <> '') AS first_line,
                 count(*) FILTER (starts_with(line, '> ') AND NOT coalesce(after_h2, false)) AS n
              FROM (SELECT *, bool_or(starts_with(line, '## ')) OVER (PARTITION BY store_code ORDER BY pos) AS after_h2 FROM lint_line)
              GROUP BY store_code)"""
    bodies: dict[str, str] = {
        "product_records": _product_records("sale_text"),
        "stream_product_records": _product_records("unlimited_text"),
        "stream_with_removals": _product_records("changed_text"),
        "quarantined_rows": _product_records("hashed_text"),
        "category_records": "SELECT * FROM shelf_record",
        "page_records": "SELECT * FROM page_record",
        "store_records": "SELECT * FROM store_record",
        "status_read_back": """
            SELECT run_id, store_code, CASE WHEN run_id % 3 = 0 THEN '' ELSE format END AS format,
                   CASE WHEN run_id % 3 = 0 THEN 'pending' ELSE status END AS status, byte_size FROM run""",
        "status_from_snapshot": """
            SELECT store_code, format, status, attempted_at AS last_attempt_at, last_success_at, byte_size, item_count,
                   duration_seconds, error_message FROM history WHERE back = 1""",
        "published_after_crashes": """
            SELECT step, state, store_code, format, run_id FROM doc CROSS JOIN (VALUES
                ('documents', 'stopped', 1), ('documents', 'again', 2), ('manifest', 'stopped', 2), ('manifest', 'again', 3),
                ('log', 'stopped', 4), ('log', 'again', 4), ('compacted', '', 4)) s(step, state, run_id)""",
        "named_files": f"""
            SELECT {FILE_NAME} AS file_name, byte_size, sha256 FROM sized LEFT JOIN (
                SELECT store_code, format, sha256(string_agg(text, '' ORDER BY section_ord, position, entity_id)) AS sha256
                FROM block GROUP BY store_code, format) USING (store_code, format)""",
        "changed_documents": f"""
            SELECT {FILE_NAME} AS file_name, CASE WHEN store_id % 7 = 0 THEN 'removed' WHEN store_id % 3 = 0 THEN 'written' ELSE 'kept' END AS action,
                   CASE WHEN store_id % 7 <> 0 THEN 2 END AS run_id,
                   CASE WHEN store_id % 7 = 0 THEN NULL WHEN store_id % 3 = 0 THEN 2 ELSE 1 END AS written_by FROM doc""",
        "lines_of_many_files": f"{lint} WHERE NOT starts_with(store_code, 'doc-')",
        "one_store": "SELECT store_id, store_code, store_name, website_name FROM store WHERE store_code = 'nation_7'",
        "store_header": f"SELECT {block} FROM store_block",
        "sibling_stores": f"SELECT {block} FROM sibling_block",
        "category_section": f"SELECT {block} FROM shelf_block",
        "page_section": f"SELECT {block} FROM page_block",
        "product_section": f"SELECT {block} FROM sale_block",
        "document_blocks": f"SELECT {block} FROM block",
        "written_documents": """
            SELECT store_code, count(*) AS lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS byte_size, min_by(line, pos) AS first_line,
                   max_by(line, pos) FILTER (line <> '') AS last_line
            FROM lint_line WHERE NOT starts_with(store_code, 'doc-') GROUP BY store_code""",
        "written_records": """
            SELECT store_code, entity_type, count(*) AS records, CAST(sum(entity_id) AS BIGINT) AS id_sum FROM made GROUP BY ALL""",
        "document_sizes": "SELECT * FROM sized",
        "section_counts": f"""
            SELECT store_code, format, section_ord, count(*) AS entities FROM (
                SELECT store_code, format, section_ord FROM block WHERE position NOT IN ({HEADING}, {CLOSING})
                UNION ALL
                SELECT store_code, 'jsonl', CASE entity_type WHEN 'store' THEN 10 WHEN 'category' THEN 30 WHEN 'cms_page' THEN 40 ELSE 50 END FROM made)
            GROUP BY ALL""",
        "visible_products": "SELECT entity_id, sku, name, price FROM item WHERE shown",
        "store_products": "SELECT store_id, entity_id, sku, name, price, short_description, description FROM item_seen WHERE shown",
        "store_categories": "SELECT store_id, entity_id, name, description, meta_description FROM shelf_seen WHERE is_active",
        "subtree_categories": "SELECT store_id, entity_id, url FROM shelf_list",
        "listed_pages": "SELECT store_id, entity_id, url FROM page_list",
        "current_rewrites": """
            SELECT url_rewrite_id, store_id, entity_type, request_path FROM rewrite
            WHERE entity_type <> 'custom' AND redirect_type = 0""",
        "canonical_urls": "SELECT store_id, store_code, entity_type, entity_id, url FROM link JOIN store USING (store_id)",
        "breadcrumbs": "SELECT entity_id, breadcrumb FROM crumb",
        "category_counts": "SELECT category_id, product_count FROM shelf_count",
        "stock_status": """
            SELECT store_id, entity_id, coalesce(stocked, true) AS in_stock
            FROM item_store JOIN store USING (store_id) LEFT JOIN stock USING (entity_id, website_id)""",
        "group_prices": """
            SELECT entity_id, CAST(customer_group_id AS BIGINT) AS customer_group_id, least(p_retailprice, group_price, special) AS price
            FROM tariff JOIN part ON p_partkey = entity_id""",
        "top_products": "SELECT store_id, entity_id, price, in_stock, url FROM sale",
        "eligibility_plan": """
            SELECT store_id, store_code, format, CASE WHEN doc.store_id IS NULL THEN 'delete' ELSE 'generate' END AS action,
                   CASE format WHEN 'llms_full_txt' THEN 'llms-full_' ELSE 'llms_' END || store_code
                   || CASE format WHEN 'jsonl' THEN '.jsonl' ELSE '.txt' END AS file_name
            FROM (SELECT store.store_id, store.store_code, format FROM store CROSS JOIN (VALUES ('llms_txt'), ('llms_full_txt'), ('jsonl')) f(format)) s
            LEFT JOIN (SELECT store_id, format FROM doc) doc USING (store_id, format)""",
        "output_names": """
            SELECT store_code, format, CASE format WHEN 'llms_full_txt' THEN 'llms-full_' ELSE 'llms_' END || store_code
                   || CASE format WHEN 'jsonl' THEN '.jsonl' ELSE '.txt' END AS file_name
            FROM store CROSS JOIN (VALUES ('llms_txt'), ('llms_full_txt'), ('jsonl')) f(format)""",
        # fixed values: element types that count as no list of a store's own
        "scoped_settings": """
            SELECT * EXCLUDE (excluded_pages, strategy, excluded_types, allowed_types), array_to_string(excluded_pages, ',') AS excluded_pages,
                   strategy || '|' || CASE
                       WHEN strategy = 'exclude' AND excluded_types <> 'products,banner,slider,slide,video,map,buttons,button-item,block,dynamic-block,divider,spacer' THEN excluded_types
                       WHEN strategy = 'allow' AND allowed_types <> 'text,heading,html,tabs,tab-item,row,column,column-group' THEN allowed_types
                       ELSE '' END AS rule FROM scoped""",
        "clean_pages": f"""
            SELECT page_id, {full("h")} AS full_text, {cut("c", 500)} AS compact_text
            FROM (SELECT page_id, h, {compact("h")} AS c FROM ({pages_clean}))""",
        "clean_documents": f"""
            SELECT doc_id, {cut("c", 2000)} AS text FROM (SELECT doc_id, {compact(html("text"))} AS c FROM documents)""",
        "registered_stage": f"SELECT page_id, {full(sub('h', '[*#$%]{3}', ''))} AS text FROM ({pages_clean})",
        "registered_section": """
            SELECT format, store_code, 15 AS section_ord, 0 AS position, 0 AS entity_id, 1 AS items,
                   '## Language' || chr(10) || chr(10) || locale || chr(10) || chr(10) AS text FROM doc WHERE format = 'llms_txt'""",
        "normalize_whitespace": f"SELECT doc_id, {compact('text')} AS compact, {full('text')} AS \"full\" FROM documents",
        "truncate_words": "SELECT doc_id, " + ", ".join(f"{cut('text', n)} AS cut_{n}" for n in (20, 500, 5000)) + " FROM documents",
        "escape_markdown": r"""
            SELECT doc_id, regexp_replace('[' || text || '](x|y) `' || source || '`', '([\[\]()|`])', '\\\1', 'g') AS escaped FROM documents""",
        "embedding_text": f"""
            SELECT doc_id, left(trim(source || chr(10) || CASE WHEN toxic = 1 THEN 'toxic' ELSE '' END || chr(10) || text, {SPACES}), 8000) AS embedding_text
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "prune_elements": " UNION ALL ".join(
            f"SELECT entity_id, {_q(rule)} AS rule, {_pruned(rule)} AS pruned FROM item WHERE description IS NOT NULL"
            for rule in ("exclude|", "strip|", "allow|row,text", "exclude|text", "preserve|")
        ),
        "substitute_directives": """
            SELECT entity_id, store_id, replace(description, '{{store url="' || store.lang || '"}}', '<a href="/">' || store_name || ' home</a>') AS description
            FROM item JOIN item_store USING (entity_id) JOIN store USING (store_id)""",
        "route_class": r"""
            SELECT path, CASE WHEN regexp_matches(path, '(^|/)llms(-full)?\.(txt|jsonl)/*$') THEN 'document'
                              WHEN regexp_matches(path, '\.md/*$') THEN 'mirror' END AS route
            FROM (SELECT path FROM request
                  UNION SELECT regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) FROM pages
                  UNION SELECT regexp_extract(link_url || '/' || f, '^https?://[^/?#]*([^?#]*)', 1)
                  FROM ctx CROSS JOIN (VALUES ('llms.txt'), ('llms-full.txt'), ('llms.jsonl'), ('llms-full.jsonl')) n(f))""",
        "mirror_lookup": "SELECT store_id, path, entity_type, entity_id FROM target",
        "mirror_render": f"""
            SELECT store_code, path, '# ' || coalesce(name, '') || chr(10) || chr(10) || '> SKU: ' || sku || ' · Price: '
                   || printf('%.2f', coalesce(price, 0)) || ' ' || currency || chr(10) || chr(10)
                   || CASE WHEN s <> '' THEN s || chr(10) || chr(10) ELSE '' END
                   || CASE WHEN l <> '' AND l <> s THEN l || chr(10) ELSE '' END AS markdown
            FROM (SELECT *, {full("short_h")} AS s, {full("long_h")} AS l FROM mirror_text)
            UNION ALL
            SELECT store_code, path, '# ' || name || chr(10) || chr(10) || CASE WHEN b <> '' THEN b || chr(10) ELSE '' END
            FROM (SELECT store_code, path, name, {full(html("coalesce(description, '')"))} AS b
                  FROM target JOIN store USING (store_id) JOIN shelf_seen USING (entity_id, store_id) WHERE entity_type = 'category')
            UNION ALL
            SELECT store_code, path, '# ' || title || chr(10) || chr(10) || CASE WHEN b <> '' THEN b || chr(10) ELSE '' END
            FROM (SELECT store_code, path, title, {full("content_h")} AS b
                  FROM target JOIN store USING (store_id) JOIN web USING (entity_id) JOIN page_text USING (entity_id)
                  WHERE entity_type = 'cms-page')""",
        "latest_status": """
            SELECT store_code, format, status, attempted_at AS last_attempt_at, last_success_at, byte_size, item_count,
                   duration_seconds, error_message FROM history WHERE back = 1""",
        "status_history": "SELECT * EXCLUDE (back) FROM history",
        "status_report": f"""
            SELECT store_code, format, status, coalesce(strftime(last_success_at, '%Y-%m-%d %H:%M:%S'), '—') AS last_success,
                   strftime(attempted_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS last_attempt_iso,
                   strftime(last_success_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS last_success_iso,
                   {_bytes("byte_size")} AS size, item_count,
                   CAST(CAST(round(duration_seconds, 2) AS DECIMAL(18, 2)) AS VARCHAR) || 's' AS time, error_message
            FROM history WHERE back = 1""",
        "run_report": "SELECT * FROM outcome",
        "run_totals": """
            SELECT format, CAST(sum(byte_size) AS BIGINT) AS total_bytes, CAST(sum(item_count) AS BIGINT) AS total_items,
                   count(*) FILTER (outcome = 'generated') AS generated, count(*) FILTER (outcome = 'failed') AS failed,
                   count(*) FILTER (outcome = 'skipped') AS skipped, bool_or(outcome = 'failed') AS has_failures
            FROM outcome GROUP BY format""",
        "lint_markdown": lint,
        "lint_jsonl": """
            SELECT store_code, count(*) AS total, count(*) FILTER (NOT ok) AS invalid, CASE WHEN bool_or(NOT ok) THEN 1 ELSE 0 END AS errors
            FROM (SELECT store_code, true AS ok FROM made
                  UNION ALL SELECT event_type, json_valid(props) FROM events
                  UNION ALL SELECT lang, json_valid(line) FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '')
            GROUP BY store_code""",
        "lint_report": """
            SELECT store_code, bool_or(coalesce(format = 'llms_txt', false)) AS has_text, bool_or(coalesce(format = 'jsonl', false)) AS has_records,
                   0 AS errors, false AS failed
            FROM store LEFT JOIN (SELECT store_id, format FROM doc) d USING (store_id) WHERE is_active GROUP BY store_code""",
        "contract_check": _contract(),
    }
    extra = {**MADE, "mirror_sale": """
        SELECT i.* EXCLUDE (store_id), ctx.*, path, least(price, group_price, special) AS final
        FROM target t JOIN item_seen i USING (entity_id, store_id) JOIN ctx ON ctx.store_id = t.store_id
        LEFT JOIN tariff r ON r.entity_id = i.entity_id AND r.customer_group_id = ctx.customer_group_id
        WHERE t.entity_type = 'product'"""}
    extra["mirror_text"] = CTES["sale_text"].replace(
        "FROM sale)", "FROM (SELECT * EXCLUDE (price, final), final AS price FROM mirror_sale))"
    )
    return {name: with_ctes(body, extra) for name, body in bodies.items()}
