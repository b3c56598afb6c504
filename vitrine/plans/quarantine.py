"""Isolation by row: which entities make a section fail, and which cleaning stages they fail in.

One pass over the texts of a section that fails tells the entities and stages whose built-in functions raise, however many they are: they
stay a table. For those entities the failing stage passes its input on, and the section is run once more.
Only what that pass cannot see (Python functions, failures outside cleaning) is looked for by running the section over ever smaller ranges of
entity ids, without keeping its output, until the failing ids are known; about log2(entities) small jobs each.
Cleaning the entities' default texts alone comes first there, as most failures show in it; only if that is not enough, the section itself is run.
"""

from __future__ import annotations

import bisect
import logging
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.constants import VERBOSITY
from vitrine.functions.cleaning import Cleaner, Probe, Skip
from vitrine.functions.text import text
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import local_rows, staged

log = logging.getLogger(__name__)

#: Slices of the ids looked up at once, and failing ranges that are split at once: beyond that many, one is split after the other.
SLICES, MOST_RANGES = 1024, 64


@dataclass(frozen=True)
class Passed:
    """Entities from ``low`` to ``high`` whose texts a stage of a section passed on as they were."""

    section: str
    stage: str
    low: int
    high: int
    error_message: str


@dataclass(frozen=True)
class PassedRows:
    """The same for single entities, as a table (entity_id, stage, error_message) that is not gathered."""

    section: str
    rows: DataFrame

    def __iter__(self) -> Iterator[Passed]:
        for r in self.rows.toLocalIterator():
            yield Passed(self.section, r["stage"], r["entity_id"], r["entity_id"], r["error_message"])


class _Ranges:
    """Runs a section over ranges of ids; ``error`` tells what a range fails with, or None."""

    def __init__(self, build: Callable[[Catalog, Cleaner], DataFrame], catalog: Catalog, table: str, key: str) -> None:
        self.build, self.catalog, self.table, self.key = build, catalog, table, key
        self.rows = getattr(catalog, table)

    def error(self, low: int, high: int, cleaner: Cleaner) -> str | None:
        some = self.catalog.with_table(self.table, self.rows.where(F.col(self.key).between(low, high)))
        try:
            self.build(some, cleaner).write.format("noop").mode("overwrite").save()
        except Exception as error:
            return str(error).splitlines()[0] if str(error) else type(error).__name__
        return None

    def cuts(self, low: int, high: int) -> list[int]:
        """Ids that cut a range into up to `SLICES` slices of about equal size; the last is its highest id."""
        ids = self.rows.where(F.col(self.key).between(low, high)).select(F.col(self.key).cast("long").alias("id"))
        found = ids.agg(F.percentile_approx("id", [i / SLICES for i in range(1, SLICES + 1)], 20 * SLICES)).first()[0]
        return sorted(set(found or []))


def failing_ids(ranges: _Ranges, cleaner: Cleaner) -> Iterator[tuple[int, int, str]]:
    """Single ids that fail, as (id, id, error): ranges that were left whole are split in turn."""
    whole = [(-(2**63), 2**63 - 1)]
    while whole:
        for low, high, error in failing_ranges(ranges, cleaner, *whole.pop()):
            if low < high:
                whole.append((low, high))
            else:
                yield low, high, error


def failing_ranges(ranges: _Ranges, cleaner: Cleaner, low: int = -(2**63), high: int = 2**63 - 1) -> list[tuple[int, int, str]]:
    """Least ranges of ids that fail, (low, high, error); single ids unless more than `MOST_RANGES` are open at once."""
    found: list[tuple[int, int, str]] = []
    every = ranges.cuts(low, high)
    # (low, high, cuts inside, known to fail)
    level = [(low, every[-1], every, "")] if every else []
    while level:
        if len(level) > MOST_RANGES:
            return found + [(low, high, error) for low, high, _, known in level if (error := known or ranges.error(low, high, cleaner))]
        below: list[tuple[int, int, list[int], str]] = []
        for low, high, cuts, known in level:
            if low == high:
                # Not by conclusion alone: a failure that does not come back is none.
                error = ranges.error(low, high, cleaner)
                found += [(low, high, error)] if error else []
                continue
            if len(cuts) < 2:
                cuts = [c for c in ranges.cuts(low, high) if low <= c <= high]
                if len(cuts) < 2:
                    below += [(c, c, [c], known) for c in cuts]
                    continue
            middle = cuts[(len(cuts) - 1) // 2]
            left = [c for c in cuts if c <= middle]
            right = cuts[bisect.bisect_right(cuts, middle):]
            error = ranges.error(low, middle, cleaner)
            if error:
                below.append((low, middle, left, error))
                if ranges.error(middle + 1, high, cleaner):
                    below.append((middle + 1, high, right, error))
            else:
                below.append((middle + 1, high, right, known))
        level = below
    return found


def cleaned_texts(table: str, key: str, texts: Sequence[str]) -> Callable[[Catalog, Cleaner], DataFrame]:
    """The cleaning of a table's default texts, for every verbosity, and nothing else."""

    def build(catalog: Catalog, cleaner: Cleaner) -> DataFrame:
        rows = getattr(catalog, table).select(F.col(key).alias("entity_id"), *(text(F.col(t)).alias(t) for t in texts))
        rows = cleaner.shared(cleaner.with_skips(rows), texts, "preserve|")
        rows = rows.withColumn("verbosity", F.explode(F.array(*map(F.lit, sorted(set(VERBOSITY.values()))))))
        return cleaner.per_format(rows, texts, "preserve|", F.col("verbosity"))

    return build


def failing_entities(
    section: str, catalog: Catalog, table: str, key: str, texts: Sequence[str], cleaner: Cleaner, build: Callable[[Catalog, Cleaner], DataFrame] | None = None
) -> PassedRows | None:
    """Entities whose texts fail in a stage, from one pass; each stage tells the error of its lowest entity. None if the pass tells of none.

    The texts are those that ``build`` cleans, by default the default texts of the whole table.
    """
    spark, name = catalog.spark, "spark.sql.subexpressionElimination.enabled"
    build, probe = build or cleaned_texts(table, key, texts), Probe(cleaner)
    held = spark.conf.get(name)
    try:
        build(catalog, probe)
        # A shared step must not be read ahead of the test that it is part of.
        spark.conf.set(name, "false")
        found = staged(probe.failing(), "failing")
    except Exception as error:
        log.warning("section %s: %s", section, str(error).splitlines()[0] if str(error) else type(error).__name__)
        return None
    finally:
        spark.conf.set(name, held)
    first = {r["stage"]: r for r in found.groupBy("stage").agg(F.min("entity_id").alias("id"), F.count("*").alias("n")).collect()}
    if not first:
        return None
    ranges, errors = _Ranges(build, catalog, table, key), []
    for row in (first[s.name] for s in cleaner.stages if s.name in first):
        errors.append((row["stage"], ranges.error(row["id"], row["id"], cleaner) or "fails"))
        log.warning("section %s: %s ids skip %s: %s", section, row["n"], *errors[-1])
    return PassedRows(section, found.join(local_rows(spark, errors, stage=pa.string(), error_message=pa.string()), "stage"))


def quarantine(
    section: str, build: Callable[[Catalog, Cleaner], DataFrame], catalog: Catalog, table: str, key: str, cleaner: Cleaner
) -> list[Passed]:
    """What has to skip which stage so that the section runs; empty if cleaning is not what fails."""
    ranges = _Ranges(build, catalog, table, key)
    passed: list[Passed] = []
    for low, high, error in failing_ids(ranges, cleaner):
        needed = [stage.name for stage in cleaner.stages]
        if ranges.error(low, high, cleaner.skipping(Skip(name, low, high) for name in needed)):
            log.warning("section %s fails for ids %s to %s outside cleaning: %s", section, low, high, error)
            return []
        for name in list(needed):
            rest = [n for n in needed if n != name]
            if not ranges.error(low, high, cleaner.skipping(Skip(n, low, high) for n in rest)):
                needed = rest
        passed += [Passed(section, name, low, high, error) for name in needed]
        log.warning("section %s: ids %s to %s skip %s: %s", section, low, high, ", ".join(needed), error)
    return passed
