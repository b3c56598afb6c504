"""Times the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vitrine.constants import COMPACT, FORMATS, JSONL, TEXT_FORMATS
from vitrine.functions.cleaning import clean_text
from vitrine.operators import blocks, entities, lookups, mirror
from vitrine.plans import report
from vitrine.plans.export import run_export
from vitrine.plans.sections import Sections
from vitrine.sources import derived
from vitrine.sources.catalog import Catalog
from vitrine.sources.outputs import read_jsonl, read_lines
from vitrine.spark_tools import staging_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Cleaning costs far more CPU than its bytes suggest: keep small inputs spread over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    # The derived tables are written once, so what is timed is the work of a real catalog's jobs.
    root = staging_path(spark, "catalog")
    for name, df in derived.load(spark, SF_DIR).tables().items():
        # Several files per text table, as a table of any size has; one file would be one task.
        df = df.repartition(int(CPUS)) if name in ("products", "pages") else df
        df.write.parquet(f"{root}/{name}")
    staging = time.time() - started

    seconds: dict[str, float] = {"stage_catalog": round(staging, 2)}
    rates: dict[str, float] = {}

    def catalog() -> Catalog:
        return Catalog.from_parquet(spark, root, as_of=derived.AS_OF)

    # One catalog for the single jobs, as in one run; the full export starts from a new one.
    shared = catalog()

    def timed(name: str, make) -> None:
        begin = time.time()
        rows = None
        df = make()
        if df is not None:
            observed = df.groupBy().agg(F.count("*").alias("n"), *[
                F.sum(F.octet_length(F.col(c).cast("string"))).alias(f"b_{c}") for c in df.columns
                if df.schema[c].dataType.simpleString() == "string"
            ]).first()
            rows = observed["n"]
        took = time.time() - begin
        seconds[name] = round(took, 3)
        if rows is not None:
            text = sum(v or 0 for k, v in observed.asDict().items() if k != "n")
            rates[name] = {"rows": rows, "rows_per_sec": round(rows / took), "mb_per_sec": round(text / 1e6 / took, 1)}

    timed("product_records", lambda: blocks.product_records(shared))
    timed("product_section", lambda: blocks.product_section(shared, TEXT_FORMATS))
    timed("page_records", lambda: blocks.page_records(shared))
    timed("category_section", lambda: blocks.category_section(shared, TEXT_FORMATS))
    timed("canonical_urls", lambda: lookups.canonical_urls(shared))
    timed("top_products", lambda: entities.product_listing(shared))
    timed("all_blocks", lambda: Sections().staged_blocks(shared, FORMATS))
    timed("mirror_render", lambda: mirror.mirror_render(shared))
    raw = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    timed("clean_pages", lambda: clean_text(raw.select("page_id", F.col("html").alias("text")), "text"))
    timed("latest_status", lambda: report.latest_status(shared.run_log))
    timed("status_history", lambda: report.status_history(shared.run_log))
    out = staging_path(spark, "export")
    timed("full_export", lambda: run_export(catalog(), out, run_id=1).select("byte_size", "item_count"))
    timed("lint_markdown", lambda: report.lint_markdown(read_lines(spark, f"{out}/documents/run=1/format={COMPACT}")))
    timed("lint_jsonl", lambda: report.lint_jsonl(read_jsonl(spark, f"{out}/documents/run=1/format={JSONL}")))
    timed("contract_check", lambda: report.contract_check(read_jsonl(spark, f"{out}/documents/run=1/format={JSONL}")))
    total = round(sum(v for k, v in seconds.items() if k != "stage_catalog"), 3)
    print(json.dumps({
        "metric": "total time of the export, mirror and report jobs", "value": total, "unit": "sec",
        "queries": seconds, "rates": rates, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
