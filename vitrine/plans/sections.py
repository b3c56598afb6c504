"""The ordered list of sections a document is made of, open to registered ones."""

from __future__ import annotations

import functools
import itertools
import logging
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.constants import (
    CATEGORIES_ORD,
    FORMATS,
    PAGES_ORD,
    PRODUCTS_ORD,
    SIBLINGS_ORD,
    STORE_ORD,
    TEXT_FORMATS,
)
from vitrine.functions.cleaning import Cleaner, Skip
from vitrine.operators import blocks as b
from vitrine.operators.stores import restricted, store_context
from vitrine.plans.document import block_print
from vitrine.plans.quarantine import Passed, PassedRows, cleaned_texts, failing_entities, quarantine
from vitrine.schemas import BLOCK, STAGED_BLOCK
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import freed_shuffles, staging_path, unsorted_writes

log = logging.getLogger(__name__)

SectionFn = Callable[[Catalog, Sequence[str], Cleaner | None], DataFrame]


@dataclass(frozen=True)
class Section:
    name: str
    order: int
    formats: tuple[str, ...]
    build: SectionFn
    # The table whose rows it cleans, its id and its texts.
    table: tuple[str, str, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Failure:
    """A document that lacks a section, or could not be written."""

    store_code: str
    format: str
    error_message: str


DEFAULT_SECTIONS = (
    Section("store", STORE_ORD, FORMATS, b.store_section),
    Section("siblings", SIBLINGS_ORD, TEXT_FORMATS, b.sibling_section),
    Section("categories", CATEGORIES_ORD, FORMATS, b.category_section, ("categories", "entity_id", ("description", "meta_description"))),
    Section("pages", PAGES_ORD, FORMATS, b.page_section, ("pages", "page_id", ("content", "meta_description"))),
    Section("products", PRODUCTS_ORD, FORMATS, b.product_section, ("products", "entity_id", ("short_description", "description"))),
)


class Sections:
    """Sections in order. ``register_section`` gives a new list with one more."""

    def __init__(self, sections: Sequence[Section] = DEFAULT_SECTIONS):
        self.sections = sorted(sections, key=lambda s: s.order)

    def register_section(self, name: str, order: int, formats: Sequence[str], fn: SectionFn) -> "Sections":
        """``fn(catalog, formats, cleaner)`` returns blocks; chunks without text are dropped."""

        def build(catalog: Catalog, wanted: Sequence[str], cleaner: Cleaner | None) -> DataFrame:
            # Only for documents that get generated at all.
            planned = store_context(catalog).select("store_code", F.explode("formats").alias("format"))
            own = fn(catalog, wanted, cleaner).withColumn("section_ord", F.lit(order)).where(F.col("text") != "")
            return own.join(planned, ["store_code", "format"], "left_semi").select(*BLOCK)

        return Sections([*self.sections, Section(name, order, tuple(formats), build)])

    def parts(
        self, catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None
    ) -> Iterator[tuple[Section, DataFrame]]:
        """(section, blocks) of each section in order."""
        for section in self.sections:
            wanted = tuple(f for f in formats if f in section.formats)
            if wanted:
                yield section, section.build(catalog, wanted, cleaner).where(F.col("format").isin(*wanted)).select(*BLOCK)

    def blocks(self, catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None) -> DataFrame:
        """All blocks of the given formats; a section that cannot be built raises."""
        return functools.reduce(DataFrame.unionByName, (part for _, part in self.parts(catalog, formats, cleaner)))

    def staged_blocks(
        self, catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None
    ) -> DataFrame:
        """All blocks with their sizes, each section written by a job of its own and read back; a failing section raises."""
        staged, failures = self.isolated_blocks(catalog, formats, cleaner)
        if failures:
            raise RuntimeError(failures[0].error_message)
        return staged

    def isolated_blocks(
        self, catalog: Catalog, formats: Sequence[str] = FORMATS, cleaner: Cleaner | None = None, passed: list[Passed | PassedRows] | None = None
    ) -> tuple[DataFrame, list[Failure]]:
        """The same, with what failed. Where a cleaning stage fails on some entities, these texts skip it, as told in ``passed``.

        A section that fails for another reason is tried again for ever fewer stores, until the failing ones are known. Their blocks
        of that section are missing; everything else is there. Separate jobs also keep each plan small, where one
        union of all sections is planned again after every stage.
        """
        spark = catalog.spark
        folder = staging_path(spark, "blocks")
        written: list[str] = []
        numbers = itertools.count()
        failures: list[Failure] = []

        def attempt(section: Section, wanted: tuple[str, ...], part_of: Catalog, codes: list[str] | None, own: Cleaner | None = None, tried: int = 0) -> None:
            path = f"{folder}/section={section.name}/part={next(numbers)}"

            def build(some: Catalog, by: Cleaner | None) -> DataFrame:
                return section.build(some, wanted, by).where(F.col("format").isin(*wanted)).select(*BLOCK)

            try:
                part = build(part_of, own or cleaner)
                sized = part.withColumns({"text_bytes": F.octet_length("text"), "text_print": block_print()})
                with freed_shuffles(spark), unsorted_writes(spark):
                    sized.write.partitionBy("format").parquet(path)
                written.append(path)
                return
            except Exception as error:
                message = f"section {section.name}: {str(error).splitlines()[0] if str(error) else type(error).__name__}"
                log.warning("%s", message)
            if codes is None and section.table is not None:
                own = own or cleaner or Cleaner()
                # Each pass settles one more stage.
                rows = failing_entities(section.name, part_of, *section.table, own, build) if len(own.skip_tables) <= len(own.stages) else None
                if rows is not None:
                    if passed is not None:
                        passed.append(rows)
                    attempt(section, wanted, part_of, None, own.skipping_rows(rows.rows.select("entity_id", "stage")), tried)
                    return
                for kind, probe in enumerate((cleaned_texts(*section.table), build)[tried:], tried + 1):
                    found = quarantine(section.name, probe, part_of, *section.table[:2], own)
                    if found:
                        if passed is not None:
                            passed.extend(found)
                        attempt(section, wanted, part_of, None, own.skipping(Skip(p.stage, p.low, p.high) for p in found), kind)
                        return
            if codes is None:
                codes = [r["store_code"] for r in store_context(catalog).where(F.size("formats") > 0).select("store_code").collect()]
            if len(codes) <= 1:
                failures.extend(Failure(code, fmt, message) for code in codes for fmt in wanted)
                return
            half = len(codes) // 2
            for some in (codes[:half], codes[half:]):
                attempt(section, wanted, restricted(catalog, *some), some, own)

        for section in self.sections:
            wanted = tuple(f for f in formats if f in section.formats)
            if wanted:
                attempt(section, wanted, catalog, None)
        if not written:
            return spark.createDataFrame([], STAGED_BLOCK), failures
        columns = STAGED_BLOCK.split(", ")
        reader = spark.read.option("basePath", folder).schema(f"{STAGED_BLOCK}, section string, part int")
        return reader.parquet(*written).select(*[c.split()[0] for c in columns]), failures
