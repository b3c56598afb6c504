
from __future__ import annotations

import functools
import importlib
import importlib.util
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from vitrine.constants import COMPACT, FORMATS, JSONL, TEXT_FORMATS
from vitrine.functions import text as tx
from vitrine.functions import urls, values
from vitrine.functions.cleaning import Cleaner, clean_text, prune_step
from vitrine.operators import blocks, entities, lookups, mirror, stores
from vitrine.operators.directives import substitute_directives
from vitrine.plans import document, report
from vitrine.plans.export import compact_log, published, published_documents, run_export
from vitrine.plans.files import file_digests, publish_files
from vitrine.plans.sections import DEFAULT_SECTIONS, Sections
from vitrine.schemas import RECORD
from vitrine.sources import derived, outputs
from vitrine.spark_tools import freed_shuffles, staged, staging_path
from vitrine.streaming.changelog import compact, current_changes, write_changes
from vitrine.streaming.incremental import current_records, write_stream

SF = "/root/testdata/sf0.001"
PRODUCT_FIELDS = (
    "entity_type", "entity_id", "store_code", "store_name", "sku", "name", "url", "price", "currency",
    "short_description", "description", "embedding_text",
)
CATEGORY_FIELDS = ("entity_type", "entity_id", "store_code", "store_name", "name", "url", "description", "embedding_text")
PAGE_FIELDS = (
    "entity_type", "entity_id", "store_code", "store_name", "title", "identifier", "url", "content", "embedding_text",
)
STORE_FIELDS = ("entity_type", "entity_id", "store_code", "store_name", "url", "currency", "locale", "embedding_text")
RULES = ("exclude|", "strip|", "allow|row,text", "exclude|text", "preserve|")


def entry(spark: SparkSession) -> DataFrame:
    """Product records of every store."""
    return queries()["product_records"](spark, SF)


def _raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _staged_blocks(spark: SparkSession, sf: str, formats: Sequence[str]) -> DataFrame:
    """Blocks of documents in the formats, rendered once per catalog as several queries read them. More formats together are cleaned once."""
    catalog = derived.load(spark, sf)
    made = catalog.cache.setdefault("blocks", {})
    missing = tuple(f for f in formats if f not in made)
    if missing:
        made |= dict.fromkeys(missing, Sections().staged_blocks(catalog, missing))
    parts = {id(made[f]): made[f] for f in formats}.values()
    return functools.reduce(DataFrame.unionByName, parts).where(F.col("format").isin(*formats))


def _text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_blocks(spark, sf, TEXT_FORMATS)


def _record_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_blocks(spark, sf, (JSONL,))


def _compact_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _text_blocks(spark, sf).where(F.col("format") == COMPACT)


def _scoped_settings(spark: SparkSession, sf: str) -> DataFrame:
    settings = stores.scoped_settings(derived.load(spark, sf))
    return settings.withColumn("excluded_pages", F.concat_ws(",", "excluded_pages"))


def _top_products(spark: SparkSession, sf: str) -> DataFrame:
    return entities.product_listing(derived.load(spark, sf)).select("store_id", "entity_id", "price", "in_stock", "url")


def _group_prices(spark: SparkSession, sf: str) -> DataFrame:
    catalog = derived.load(spark, sf)
    pairs = catalog.prices.select(F.col("product_id").alias("entity_id"), F.col("group_id").alias("customer_group_id"))
    shelf = lookups.product_shelf(catalog, catalog.products.select("entity_id", "price"))
    priced = lookups.apply_tariff(catalog, lookups.pick_tariff(catalog, pairs.join(shelf, "entity_id")))
    return priced.drop("_stock")


def _stock(spark: SparkSession, sf: str) -> DataFrame:
    catalog = derived.load(spark, sf)
    listed = catalog.product_stores.join(catalog.stores.select("store_id", "website_id"), "store_id")
    shelf = lookups.product_shelf(catalog, catalog.product_stores.select("entity_id").distinct())
    return lookups.pick_stock(listed.join(shelf, "entity_id")).select("store_id", "entity_id", "in_stock")


def _clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = _raw(spark, sf, "pages").select("page_id", F.col("html").alias("full_text"), F.col("html").alias("compact_text"))
    return clean_text(clean_text(pages, "full_text"), "compact_text", "compact", 500)


def _clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return clean_text(_raw(spark, sf, "documents").select("doc_id", "text"), "text", "compact", 2000)


def _registered_stage(spark: SparkSession, sf: str) -> DataFrame:
    cleaner = Cleaner().register_stage("quiet", lambda c: F.regexp_replace(c, r"[*#$%]{3}", ""), order=35)
    return clean_text(_raw(spark, sf, "pages").select("page_id", F.col("html").alias("text")), "text", cleaner=cleaner)


def _registered_section(spark: SparkSession, sf: str) -> DataFrame:
    def languages(catalog, formats, cleaner):
        rows = stores.store_context(catalog).withColumn("format", F.explode("formats"))
        line = F.concat(F.lit("## Language\n\n"), F.col("locale"), F.lit("\n\n"))
        return rows.select("format", "store_code", F.lit(0).alias("section_ord"), F.lit(0).cast("long").alias("position"),
                           F.lit(0).cast("long").alias("entity_id"), F.lit(1).alias("items"), line.alias("text"))

    own = Sections([]).register_section("language", 15, (COMPACT,), languages)
    return own.blocks(derived.load(spark, sf))


def _hashed_digits(text: F.Column) -> F.Column:
    """A stage that cannot read the texts of a few products."""
    bad = text.rlike("Brand#10™, size (31|50)$")
    return F.when(bad, F.raise_error(F.lit("unreadable")).cast("string")).otherwise(F.regexp_replace(text, "[0-9]", "#"))


def _quarantined_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Product records where a registered stage fails on some products: these keep their text as it was before that stage."""
    cleaner = Cleaner().register_stage("hashed", _hashed_digits, order=35)
    products = Sections([s for s in DEFAULT_SECTIONS if s.name == "products"])
    rendered, failures = products.isolated_blocks(derived.load(spark, sf), (JSONL,), cleaner)
    if failures:
        raise RuntimeError(failures[0].error_message)
    records = rendered.select(F.from_json("text", RECORD).alias("r"))
    return records.select(*[f"r.{c}" for c in PRODUCT_FIELDS])


def _truncate(spark: SparkSession, sf: str) -> DataFrame:
    texts = _raw(spark, sf, "documents").select("doc_id", "text")
    return texts.select("doc_id", *[tx.truncate_words(F.col("text"), n).alias(f"cut_{n}") for n in (20, 500, 5000)])


def _normalize(spark: SparkSession, sf: str) -> DataFrame:
    texts = _raw(spark, sf, "documents")
    return texts.select("doc_id", tx.normalize_ws(F.col("text"), "compact").alias("compact"),
                        tx.normalize_ws(F.col("text"), "full").alias("full"))


def _escape(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf, "documents")
    marked = F.concat(F.lit("["), "text", F.lit("](x|y) `"), "source", F.lit("`"))
    return rows.select("doc_id", tx.escape_markdown(marked).alias("escaped"))


def _embedding(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf, "documents").join(_raw(spark, sf, "labels"), "doc_id", "left")
    label = F.when(F.col("toxic") == 1, "toxic")
    return rows.select("doc_id", tx.embedding_text(F.col("source"), label, F.col("text")).alias("embedding_text"))


def _prune(spark: SparkSession, sf: str) -> DataFrame:
    texts = derived.load(spark, sf).products.where(F.col("description").isNotNull()).select(
        "entity_id", "description", F.explode(F.array(*map(F.lit, RULES))).alias("rule")
    )
    return texts.select("entity_id", "rule", prune_step(F.col("rule"))(F.col("description")).alias("pruned"))


def _directives(spark: SparkSession, sf: str) -> DataFrame:
    catalog = derived.load(spark, sf)
    texts = catalog.products.select("entity_id", "description")
    rows = texts.join(catalog.product_stores, "entity_id")
    return substitute_directives(rows, ["description"], catalog.directives)


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    asked = derived.load(spark, sf).requests.select("path").distinct()
    fixed = stores.store_context(derived.load(spark, sf)).select(
        F.explode(F.transform(F.array(*map(F.lit, urls.DOCUMENT_NAMES)), lambda n: F.concat("link_url", F.lit("/"), n))).alias("url")
    )
    paths = asked.union(_raw(spark, sf, "pages").select(urls.url_path(F.col("url")))).union(
        fixed.select(urls.url_path(F.col("url")))
    )
    return paths.distinct().select("path", urls.route_class(F.col("path")).alias("route"))


def _output_names(spark: SparkSession, sf: str) -> DataFrame:
    return stores.eligibility_plan(derived.load(spark, sf)).select("store_code", "format", "file_name")


def _all_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_blocks(spark, sf, FORMATS)


def _section_counts(spark: SparkSession, sf: str) -> DataFrame:
    return document.section_counts(_all_blocks(spark, sf))


def _run_report(spark: SparkSession, sf: str) -> DataFrame:
    """All formats; the record documents of some stores count as failed."""
    catalog = derived.load(spark, sf)
    failed = catalog.stores.where(F.col("store_id") % 4 == 1).select("store_code", F.lit(JSONL).alias("format"), F.lit("broken").alias("error_message"))
    return report.run_report(stores.eligibility_plan(catalog), document.document_sizes(_all_blocks(spark, sf)), failed)


def _status_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """A run log whose older files lack some fields."""
    runs, out = derived.load(spark, sf).run_log, staging_path(spark, "old-log")
    runs.where("run_id % 3 = 0").drop("status", "format").write.parquet(f"{out}/run=0")
    runs.where("run_id % 3 > 0").write.parquet(f"{out}/run=1")
    return outputs.read_status(spark, out).select("run_id", "store_code", "format", "status", "byte_size")


def _status_from_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The state from snapshots of two parts of the log and the rows of a third."""
    parts = [derived.load(spark, sf).run_log.where(F.col("run_id") % 3 == n) for n in range(3)]
    return report.latest_status(report.log_snapshot(parts[0]).unionByName(report.log_snapshot(parts[1])).unionByName(parts[2]))


def _published_after_crashes(spark: SparkSession, sf: str) -> DataFrame:
    """What is published when a run stops after each of its steps, and after it was started again."""
    catalog, out = derived.load(spark, sf), staging_path(spark, "crashes")
    stores_only = Sections([s for s in DEFAULT_SECTIONS if s.name == "store"])
    seen = []

    def run(number: int, stop: str | None = None) -> None:
        def after(step: str) -> None:
            if step == stop:
                raise InterruptedError(step)

        try:
            run_export(catalog, out, sections=stores_only, run_id=number, after=after)
        except InterruptedError:
            pass

    run(1)
    for number, step in enumerate(("documents", "manifest", "log"), 2):
        for state, stop in (("stopped", step), ("again", None)):
            run(number, stop)
            seen.append(staged(published(spark, out).select(F.lit(step).alias("step"), F.lit(state).alias("state"), "store_code", "format", "run_id"), "seen"))
    compact_log(spark, out)
    seen.append(published(spark, out).select(F.lit("compacted").alias("step"), F.lit("").alias("state"), "store_code", "format", "run_id"))
    return functools.reduce(DataFrame.unionByName, seen)


def _named_files(spark: SparkSession, sf: str) -> DataFrame:
    """All published documents as files under their own names, read back byte by byte. The digest of records depends on key order and is left out."""
    out = staging_path(spark, "named")
    run_export(derived.load(spark, sf), out, run_id=1)
    publish_files(spark, out)
    digest = F.when(F.col("file_name").endswith(".txt"), F.col("sha256"))
    return file_digests(spark, out).select("file_name", "byte_size", digest.alias("sha256"))


def _changed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """What a second run writes, and what becomes of the named files, when some stores have other names and some are switched off."""
    catalog, out = derived.load(spark, sf), staging_path(spark, "changed")
    stores_only = Sections([s for s in DEFAULT_SECTIONS if s.name == "store"])
    key = F.col("store_id")
    renamed = F.when(key % 3 == 0, F.concat(F.lit("New "), "store_name")).otherwise(F.col("store_name"))
    later = catalog.stores.withColumns({"store_name": renamed, "is_active": F.col("is_active") & (key % 7 != 0)})
    run_export(catalog, out, sections=stores_only, run_id=1)
    publish_files(spark, out)
    run_export(catalog.with_table("stores", later), out, sections=stores_only, run_id=2, only_changed=True)
    files = publish_files(spark, out).select("file_name", "action")
    held = F.regexp_extract(F.get("parts", F.lit(0)), "/run=([0-9]+)/", 1).cast("int")
    return files.join(published_documents(spark, out).select("file_name", "run_id", held.alias("written_by")), "file_name", "left")


def _lines_of_many_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lint of compact documents whose parts hold few lines each, with the order of lines taken from the files."""
    out = staging_path(spark, "small-files")
    document.write_documents(_compact_blocks(spark, sf), out, file_rows=7)
    return report.lint_markdown(outputs.read_lines(spark, out))


def _status_report(spark: SparkSession, sf: str) -> DataFrame:
    # The event times have no zone: read them as UTC.
    at = F.from_utc_timestamp(F.col("attempted_at").cast("timestamp"), F.current_timezone())
    return report.status_report(derived.load(spark, sf).run_log.withColumn("attempted_at", at))


def _json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines to lint: produced records per store, event properties per type, documents per language."""
    made = _record_blocks(spark, sf).select("store_code", F.rtrim("text", F.lit("\n")).alias("line"))
    props = _raw(spark, sf, "events").select(F.col("event_type").alias("store_code"), F.col("props").alias("line"))
    prose = _raw(spark, sf, "documents").select(F.col("lang").alias("store_code"), F.explode(F.split("text", "\n")).alias("line"))
    return made.unionByName(props).unionByName(prose)


def _lint_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines to lint: compact documents of the stores, and each document of the text table."""
    prose = _raw(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("store_code"),
        F.posexplode(F.split(F.concat(F.lit("> "), "source", F.lit("\n"), "text"), "\n")).alias("n", "line"),
    )
    pos = F.struct(F.lit(0).alias("section_ord"), F.lit(0).cast("long").alias("position"), F.lit(0).cast("long").alias("entity_id"), "n")
    return outputs.block_lines(_compact_blocks(spark, sf)).unionByName(prose.select("store_code", pos.alias("pos"), "line"))


def _lint_report(spark: SparkSession, sf: str) -> DataFrame:
    catalog, blocks = derived.load(spark, sf), _all_blocks(spark, sf)
    records = blocks.where(F.col("format") == JSONL).select("store_code", F.rtrim("text", F.lit("\n")).alias("line"))
    active = catalog.scan_stores().where("is_active")
    markdown = report.lint_markdown(outputs.block_lines(blocks.where(F.col("format") == COMPACT)))
    return report.lint_report(active, markdown, report.lint_jsonl(records))


def _contract(spark: SparkSession, sf: str) -> DataFrame:
    lines = _json_lines(spark, sf)
    records = _raw(spark, sf, "events").select(F.to_json(F.struct(
        F.col("event_type").alias("entity_type"), (F.col("event_id") - F.col("user_id") * 50).alias("entity_id"), F.lit("").alias("store_code"),
        F.col("user_id").alias("url"), F.upper(F.substring("event_type", 1, 4)).alias("currency"), (F.col("value") - 10).alias("price"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("embedding_text"),
    )).alias("line"))
    return report.contract_check(lines.select("line").unionByName(records))


def _written_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Compact documents written, read back as ordered lines, and measured."""
    out = staging_path(spark, "written")
    document.write_documents(_compact_blocks(spark, sf), out)
    lines = outputs.read_lines(spark, out)
    return lines.groupBy("store_code").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("line") + 1).alias("byte_size"),
        F.min_by("line", "pos").alias("first_line"), F.max_by("line", F.when(F.col("line") != "", F.col("pos"))).alias("last_line"),
    )


def _written_records(spark: SparkSession, sf: str) -> DataFrame:
    out = staging_path(spark, "written")
    document.write_documents(_record_blocks(spark, sf), out, compression="gzip")
    lines = outputs.read_jsonl(spark, out).withColumn("entity_type", F.get_json_object("line", "$.entity_type"))
    return lines.groupBy("store_code", "entity_type").agg(
        F.count("*").alias("records"), F.sum(F.get_json_object("line", "$.entity_id").cast("long")).alias("id_sum")
    )


def _product_files(spark: SparkSession, catalog) -> str:
    """The products as files, joined and written once per catalog."""
    if "product_files" not in catalog.cache:
        path = staging_path(spark, "product-files")
        with freed_shuffles(spark):
            catalog.products.write.parquet(path, compression="zstd")
        catalog.cache["product_files"] = path
    return catalog.cache["product_files"]


def _stream_products(spark: SparkSession, sf: str) -> DataFrame:
    """Records made by the incremental job from product files, read back as columns."""
    catalog = derived.load(spark, sf)
    source = spark.readStream.schema(catalog.products.schema).parquet(_product_files(spark, catalog))
    out = staging_path(spark, "stream")
    write_stream(catalog, "product", source, out, staging_path(spark, "stream-state")).awaitTermination()
    return current_records(spark, out).select(F.from_json("value", RECORD).alias("r")).select(*[f"r.{c}" for c in PRODUCT_FIELDS])


def _changed_products(products: DataFrame) -> list[DataFrame]:
    """Three deliveries of product changes: all as they are; disabled ones and two new names at once; back again, stale and removed ones."""
    rows, key = products.withColumns({"version": F.lit(1).cast("long"), "deleted": F.lit(False)}), F.col("entity_id")
    off = F.when(key % 5 == 0, 2).otherwise(F.col("status"))

    def version(n: int, rows: DataFrame, **changed) -> DataFrame:
        return rows.withColumns({"version": F.lit(n).cast("long"), **changed})

    first = version(2, rows.where((key % 5 == 0) | (key % 7 == 0)), name=F.lit("First"), status=off)
    second = version(3, rows.where(key % 7 == 0), name=F.concat(F.lit("Second "), F.coalesce("name", F.lit("item"))), status=off)
    back = version(4, rows.where(key % 10 == 0), status=F.lit(1))
    gone = version(5, rows.where(key % 9 == 0), deleted=F.lit(True))
    stale = version(0, rows.where(key % 6 == 0), name=F.lit("Stale"))
    return [rows, second.unionByName(first), stale.unionByName(gone).unionByName(back)]


def _stream_with_removals(spark: SparkSession, sf: str) -> DataFrame:
    """Product changes logged as they arrive, compacted on the way, and what is current then."""
    catalog = derived.load(spark, sf)
    feed, out, state = (staging_path(spark, name) for name in ("changes", "changelog", "changelog-state"))
    products = spark.read.schema(catalog.products.schema).parquet(_product_files(spark, catalog))
    for number, delivery in enumerate(_changed_products(products)):
        delivery.write.mode("append").parquet(feed)
        source = spark.readStream.schema(delivery.schema).parquet(feed)
        write_changes(catalog, "product", source, out, state).awaitTermination()
        if number == 1:
            compact(spark, out)
    records = current_changes(spark, out).select(F.from_json("value", RECORD).alias("r"))
    return records.select(*[f"r.{c}" for c in PRODUCT_FIELDS])


def _dealt(part: str) -> dict:
    """Queries or SQL of the training-data operators and their pipeline, where these are there."""
    if importlib.util.find_spec("vitrine.llm") is None:
        return {}
    found = dict(getattr(importlib.import_module(f"vitrine.llm.{part}"), part.upper()))
    if importlib.util.find_spec("corpus_pipeline") is not None:
        pipeline = importlib.import_module("corpus_pipeline")
        found |= {"pipeline": pipeline.run} if part == "queries" else {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each runs over the whole tables under ``sf_dir``."""
    def on_catalog(fn):
        return lambda spark, sf: fn(derived.load(spark, sf))

    return _dealt("queries") | {
        "product_records": on_catalog(lambda c: blocks.product_records(c).select(*PRODUCT_FIELDS)),
        "category_records": on_catalog(lambda c: blocks.category_records(c).select(*CATEGORY_FIELDS)),
        "page_records": on_catalog(lambda c: blocks.page_records(c).select(*PAGE_FIELDS)),
        "store_records": on_catalog(lambda c: blocks.store_records(c).select(*STORE_FIELDS)),
        "store_header": on_catalog(lambda c: blocks.store_section(c, TEXT_FORMATS)),
        "sibling_stores": on_catalog(lambda c: blocks.sibling_section(c, TEXT_FORMATS)),
        "category_section": on_catalog(lambda c: blocks.category_section(c, TEXT_FORMATS)),
        "page_section": on_catalog(lambda c: blocks.page_section(c, TEXT_FORMATS)),
        "product_section": on_catalog(lambda c: blocks.product_section(c, TEXT_FORMATS)),
        "document_blocks": lambda spark, sf: _text_blocks(spark, sf).drop("text_bytes", "text_print"),
        "written_documents": _written_documents,
        "written_records": _written_records,
        "document_sizes": lambda spark, sf: document.document_sizes(_all_blocks(spark, sf)),
        "section_counts": _section_counts,
        "visible_products": on_catalog(lambda c: c.scan_products("sku", "name", "price")),
        "store_products": on_catalog(lambda c: c.scan_store_products("sku", "name", "price", "short_description", "description")),
        "store_categories": on_catalog(lambda c: c.scan_store_categories("name", "description", "meta_description").drop("path")),
        "subtree_categories": on_catalog(lambda c: entities.category_listing(c).select("store_id", "entity_id", "url")),
        "listed_pages": on_catalog(lambda c: entities.page_listing(c).select("store_id", "entity_id", "url")),
        "current_rewrites": on_catalog(lambda c: c.scan_rewrites().select("url_rewrite_id", "store_id", "entity_type", "request_path")),
        "canonical_urls": on_catalog(lookups.canonical_urls),
        "breadcrumbs": on_catalog(lookups.breadcrumbs),
        "category_counts": on_catalog(lookups.category_counts),
        "stock_status": _stock,
        "group_prices": _group_prices,
        "top_products": _top_products,
        "eligibility_plan": on_catalog(stores.eligibility_plan),
        "scoped_settings": _scoped_settings,
        "output_names": _output_names,
        "clean_pages": _clean_pages,
        "clean_documents": _clean_documents,
        "registered_stage": _registered_stage,
        "registered_section": _registered_section,
        "quarantined_rows": _quarantined_rows,
        "normalize_whitespace": _normalize,
        "truncate_words": _truncate,
        "escape_markdown": _escape,
        "embedding_text": _embedding,
        "prune_elements": _prune,
        "substitute_directives": _directives,
        "route_class": _routes,
        "mirror_lookup": on_catalog(mirror.mirror_lookup),
        "mirror_render": on_catalog(mirror.mirror_render),
        "latest_status": on_catalog(lambda c: report.latest_status(c.run_log)),
        "status_read_back": _status_read_back,
        "status_from_snapshot": _status_from_snapshot,
        "published_after_crashes": _published_after_crashes,
        "named_files": _named_files,
        "changed_documents": _changed_documents,
        "lines_of_many_files": _lines_of_many_files,
        "one_store": on_catalog(lambda c: c.scan_stores("nation_7").select("store_id", "store_code", "store_name", "website_name")),
        "status_history": on_catalog(lambda c: report.status_history(c.run_log)),
        "status_report": _status_report,
        "run_report": _run_report,
        "run_totals": lambda spark, sf: report.run_totals(_run_report(spark, sf)),
        "lint_markdown": lambda spark, sf: report.lint_markdown(_lint_lines(spark, sf)),
        "lint_jsonl": lambda spark, sf: report.lint_jsonl(_json_lines(spark, sf)),
        "lint_report": _lint_report,
        "contract_check": _contract,
        "stream_product_records": _stream_products,
        "stream_with_removals": _stream_with_removals,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.statements() | _dealt("oracles")
