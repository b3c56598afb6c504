import dataclasses
import hashlib
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.shop import small_documents, small_shop
from tests.test_catalog import COMPACT_DOCUMENT
from vitrine.constants import COMPACT, FORMATS, FULL, JSONL, TEXT_FORMATS
from vitrine.operators.blocks import store_section
from vitrine.plans.document import ORDER, write_documents
from vitrine.functions.cleaning import Cleaner
from vitrine.plans import files
from vitrine.plans.files import file_digests, publish_files
from vitrine.plans.export import manifest, published, quarantined, retire, run_export, run_history
from vitrine.plans.report import contract_check, lint_jsonl, lint_markdown, lint_report, run_totals
from vitrine.plans.sections import DEFAULT_SECTIONS, Sections
from vitrine.sources.outputs import read_jsonl, read_lines, read_status
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import shared_dir, subfolders
from vitrine.streaming.changelog import change_rows, compact, current_changes, write_changes
from vitrine.streaming.incremental import current_records, write_stream


def document(folder, fmt, store):
    parts = sorted((folder / f"format={fmt}" / f"store_code={store}").glob("part-*"))
    return "".join(p.read_text(encoding="utf8") for p in parts)


def test_files_hold_the_documents(spark, shop, tmp_path):
    report = {(r["store_code"], r["format"]): r for r in run_export(shop, str(tmp_path), run_id=1).collect()}
    run = tmp_path / "documents" / "run=1"
    assert document(run, COMPACT, "default") == COMPACT_DOCUMENT
    assert report["default", COMPACT]["byte_size"] == len(COMPACT_DOCUMENT.encode())
    assert report["default", COMPACT]["file_name"] == "llms_default.txt"
    assert report["off", COMPACT]["outcome"] == "skipped" and report["de", FULL]["outcome"] == "skipped"
    lines = document(run, JSONL, "default").splitlines()
    assert [json.loads(x)["entity_type"] for x in lines] == ["store"] + ["category"] * 3 + ["cms_page"] * 2 + ["product"] * 4
    assert [json.loads(x)["entity_id"] for x in lines] == [1, 6, 8, 5, 2, 1, 10, 11, 14, 16]

    text_lines = read_lines(spark, str(run / f"format={COMPACT}"))
    ordered = [r["line"] for r in text_lines.where("store_code = 'default'").orderBy("pos").collect()]
    assert ordered == COMPACT_DOCUMENT[:-1].split("\n")
    lint = lint_markdown(text_lines)
    assert {r["store_code"]: (r["h1_present"], r["blockquotes"], r["errors"]) for r in lint.collect()}["default"] == (True, 4, 0)
    records = read_jsonl(spark, str(run / f"format={JSONL}"))
    assert {r["rule"]: r["records"] for r in contract_check(records).collect()} == {"valid": records.count()}
    done = {r["store_code"]: r for r in lint_report(shop.scan_stores().where("is_active"), lint, lint_jsonl(records)).collect()}
    assert done["default"]["has_text"] and done["default"]["has_records"] and not done["default"]["failed"]
    joined = "".join(open(p.removeprefix("file:"), encoding="utf8").read() for p in report["default", COMPACT]["parts"])
    assert joined == COMPACT_DOCUMENT and report["off", COMPACT]["parts"] is None
    totals = {r["format"]: r for r in run_totals(manifest(spark, str(tmp_path), 1)).collect()}
    assert (totals[JSONL]["generated"], totals[JSONL]["skipped"], totals[JSONL]["has_failures"]) == (3, 1, False)
    assert totals[JSONL]["total_items"] == records.count()


def named(folder):
    return {p.name: p.read_text(encoding="utf8") for p in (folder / "files").iterdir()}


@pytest.mark.parametrize("in_place", [True, False])
def test_named_files_are_the_documents(spark, shop, tmp_path, in_place):
    out = str(tmp_path)
    assert publish_files(spark, out, in_place).count() == 0 and file_digests(spark, out).count() == 0
    run_export(shop, out, formats=(COMPACT, JSONL), run_id=1)
    assert {r["action"] for r in publish_files(spark, out, in_place).collect()} == {"written"}
    run = tmp_path / "documents" / "run=1"
    wanted = {f"llms_{s}.{e}": document(run, f, s) for f, e in ((COMPACT, "txt"), (JSONL, "jsonl")) for s in ("default", "de", "solo")}
    assert named(tmp_path) == wanted
    told = {r["file_name"]: (r["byte_size"], r["sha256"]) for r in file_digests(spark, out).collect()}
    assert told == {n: (len(t.encode()), hashlib.sha256(t.encode()).hexdigest()) for n, t in wanted.items()}

    # A file that was lost or cut comes back, others stay as they are; a store that is switched off loses its files.
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "files").iterdir()}
    (tmp_path / "files" / "llms_de.txt").unlink()
    (tmp_path / "files" / "llms_solo.txt").write_text("cut")
    assert {r["file_name"] for r in publish_files(spark, out, in_place).where("action = 'written'").collect()} == {"llms_de.txt", "llms_solo.txt"}
    assert named(tmp_path) == wanted
    run_export(small_shop(spark, [("general/exclude_store", "stores", 2, "1")]), out, formats=(COMPACT, JSONL), run_id=2, only_changed=True)
    actions = {r["file_name"]: r["action"] for r in publish_files(spark, out, in_place).collect()}
    assert actions["llms_de.txt"] == actions["llms_de.jsonl"] == "removed" and actions["llms_default.jsonl"] == "kept"
    assert set(named(tmp_path)) == {n for n in wanted if "_de." not in n}
    assert (tmp_path / "files" / "llms_default.jsonl").stat().st_mtime_ns == before["llms_default.jsonl"]


def test_unchanged_documents_are_not_written_again(spark, shop, tmp_path):
    out = str(tmp_path)
    run_export(shop, out, formats=(COMPACT, JSONL), run_id=1)
    first = {(r["store_code"], r["format"]): r for r in manifest(spark, out, 1).collect()}
    run_export(shop, out, formats=(COMPACT, JSONL), run_id=2, only_changed=True)
    again = {(r["store_code"], r["format"]): r for r in manifest(spark, out, 2).collect()}
    assert again == first and not list((tmp_path / "documents" / "run=2").rglob("part-*"))
    assert {r["run_id"] for r in published(spark, out).collect()} == {2}
    retire(spark, out)
    assert document(tmp_path / "documents" / "run=1", COMPACT, "default") == COMPACT_DOCUMENT

    dearer = dataclasses.replace(shop, cache={}, products=shop.products.withColumn("price", F.when(F.col("entity_id") == 11, 7.5).otherwise(F.col("price"))))
    run_export(dearer, out, formats=(COMPACT, JSONL), run_id=3, only_changed=True)
    written = {tuple(n.partition("=")[2] for n in p.parts[-3:-1]) for p in (tmp_path / "documents" / "run=3").rglob("part-*") if p.stat().st_size}
    assert written == {(COMPACT, "default"), (JSONL, "default")}
    gone = retire(spark, out)
    assert gone == [f"run=1/format={f}/store_code=default" for f in (JSONL, COMPACT)]
    assert "7.50" in document(tmp_path / "documents" / "run=3", COMPACT, "default") and document(tmp_path / "documents" / "run=1", COMPACT, "solo")


def test_a_publish_that_stops_is_done_again(spark, shop, tmp_path, monkeypatch):
    out = str(tmp_path)
    one_format = dict(formats=(COMPACT,))
    run_export(shop, out, run_id=1, **one_format)
    publish_files(spark, out)
    wanted = named(tmp_path)
    other = dataclasses.replace(shop, cache={}, products=shop.products.withColumn("name", F.concat(F.col("name"), F.lit("!"))))
    run_export(other, out, run_id=2, **one_format)
    real = files._rename

    def broken(hidden, root):
        step = real(hidden, root)

        def some(rows):
            for row in rows:
                yield from step(iter([row]))
                raise InterruptedError("stopped")

        return some

    monkeypatch.setattr(files, "_rename", broken)
    with pytest.raises(Exception, match="stopped"):
        publish_files(spark, out)
    monkeypatch.undo()
    # The names are the old ones again, though some files are of the run between.
    run_export(shop, out, run_id=3, **one_format)
    publish_files(spark, out)
    assert {n: t for n, t in named(tmp_path).items() if not n.startswith("_")} == wanted
    assert not (tmp_path / "files" / "_publish=3").exists()


def test_order_survives_many_parts(spark, tmp_path):
    rng = spark.range(20_000).withColumns({
        "format": F.lit("llms_txt"), "store_code": F.when(F.col("id") % 10 < 7, "big").otherwise("small"),
        "section_ord": (F.col("id") % 3).cast("int"), "position": F.col("id") % 5, "entity_id": F.col("id"), "items": F.lit(1),
        "text": F.concat(F.col("id").cast("string"), F.lit("\nsecond\n")),
    }).drop("id")
    write_documents(rng, str(tmp_path / "out"), partitions=9)
    lines = read_lines(spark, str(tmp_path / "out")).where("line <> 'second'")
    for store in ("big", "small"):
        found = [int(r["line"]) for r in lines.where(F.col("store_code") == store).orderBy("pos").collect()]
        wanted = [r["entity_id"] for r in rng.where(F.col("store_code") == store).orderBy(*ORDER).collect()]
        assert found == wanted
    assert len(list((tmp_path / "out" / "store_code=big").glob("part-*"))) > 1


def test_small_part_files_concern_the_documents_alone(spark, tmp_path):
    rows = spark.range(9).select(F.lit("a").alias("store_code"), F.lit(1).alias("section_ord"), F.col("id").alias("position"),
                                 F.col("id").alias("entity_id"), F.concat(F.col("id").cast("string"), F.lit("\n")).alias("text"))
    held = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    write_documents(rows, str(tmp_path / "out"), partitions=1, file_rows=2)
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == held
    assert len(list((tmp_path / "out" / "store_code=a").glob("part-*"))) == 5
    assert [r["line"] for r in read_lines(spark, str(tmp_path / "out")).orderBy("pos").collect()] == [str(i) for i in range(9)]


def test_many_small_files_are_read_in_few_tasks_and_once(spark, tmp_path, monkeypatch):
    from vitrine.plans import report

    rows = spark.range(60).select(F.lit("a").alias("store_code"), F.lit(1).alias("section_ord"), F.col("id").alias("position"), F.col("id").alias("entity_id"),
                                  F.when(F.col("id") == 0, "# a\n").when(F.col("id").isin(3, 50), "> b\n").when(F.col("id") == 40, "## c\n").otherwise("x\n").alias("text"))
    write_documents(rows, str(tmp_path / "out"), partitions=1, file_rows=1)
    files = list((tmp_path / "out" / "store_code=a").iterdir())
    assert len(files) == 60 and all(f.name.startswith("part-") for f in files)
    tasks, write = [], report.staged
    monkeypatch.setattr(report, "staged", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or write(df, name))
    found = lint_markdown(read_lines(spark, str(tmp_path / "out"))).collect()
    assert [tuple(r) for r in found] == [("a", True, 1, "single", 0)]
    assert len(tasks) == 1 and tasks[0] <= 8


def test_a_failing_section_fails_its_documents(spark, shop, tmp_path):
    def broken(catalog, formats, cleaner):
        rows = store_section(catalog, formats)
        text = F.when((F.col("store_code") == "de") & (F.length("text") > 0), F.raise_error(F.lit("broken at run time"))).otherwise(F.lit("ok\n"))
        return rows.withColumn("text", text.cast("string"))

    run_export(shop, str(tmp_path), run_id=1)
    sections = Sections().register_section("broken", 12, (COMPACT,), broken)
    report = {(r["store_code"], r["format"]): r for r in run_export(shop, str(tmp_path), sections=sections, run_id=2).collect()}
    assert report["de", COMPACT]["outcome"] == "failed" and report["de", COMPACT]["error_message"].startswith("section broken: ")
    assert report["de", JSONL]["outcome"] == "generated" and report["default", COMPACT]["outcome"] == "generated"
    assert not document(tmp_path / "documents" / "run=2", COMPACT, "de")
    current = {(r["store_code"], r["format"]): r["run_id"] for r in published(spark, str(tmp_path)).collect()}
    assert current["de", COMPACT] == 1 and current["default", COMPACT] == 2
    retire(spark, str(tmp_path))
    assert document(tmp_path / "documents" / "run=1", COMPACT, "de") and not document(tmp_path / "documents" / "run=1", COMPACT, "default")


@pytest.mark.parametrize("bad", [{10}, {10, 16}, {11, 14, 16}])
def test_a_stage_that_fails_on_some_rows_fails_no_document(spark, shop, tmp_path, bad):
    rows = shop.products.where("status = 1").withColumns({
        "description": F.concat(F.lit("text "), F.col("entity_id").cast("string")), "short_description": F.lit(None).cast("string")})
    many = spark.range(1000, 3000).select(F.col("id").alias("entity_id"), F.lit("S").alias("sku"), F.lit("n").alias("name"), F.lit(1.0).alias("price"),
                                          F.lit(None).cast("string").alias("short_description"), F.lit("x").alias("description"), F.lit(1).alias("status"), F.lit(4).alias("visibility"))
    shop = dataclasses.replace(shop, cache={}, products=rows.unionByName(many))

    def fails(c):
        return F.when(c.isin(*[f"text {i}" for i in bad]), F.raise_error(F.lit("no")).cast("string")).otherwise(F.upper(c))

    cleaner = Cleaner().register_stage("fragile", fails, order=35)
    report = run_export(shop, str(tmp_path), formats=(COMPACT,), cleaner=cleaner, run_id=1).collect()
    assert {r["outcome"] for r in report if r["store_code"] != "off"} == {"generated"}
    text = document(tmp_path / "documents" / "run=1", COMPACT, "default")
    for i in (10, 11, 14, 16):
        assert (f"Description: text {i}\n" if i in bad else f"Description: TEXT {i}\n") in text
    told = quarantined(spark, str(tmp_path), 1).collect()
    assert {(r["section"], r["stage"], r["low"], r["high"]) for r in told} == {("products", "fragile", i, i) for i in bad}


def test_one_pass_names_all_failing_rows(spark, shop, monkeypatch):
    from vitrine.plans import quarantine as q

    rows = spark.range(1000, 1300).select(
        F.col("id").alias("entity_id"), F.lit("S").alias("sku"), F.lit("n").alias("name"), F.lit(1.0).alias("price"), F.lit(None).cast("string").alias("short_description"),
        F.concat(F.lit("<p>text "), F.col("id").cast("string"), F.lit("</p>")).alias("description"), F.lit(1).alias("status"), F.lit(4).alias("visibility"))
    catalog = dataclasses.replace(shop, cache={}, products=rows)

    def fails(digit):
        return lambda c: F.when(c.rlike(f"{digit}$"), F.raise_error(F.lit("no")).cast("string")).otherwise(c)

    cleaner = Cleaner().register_stage("sevens", fails(7), order=35).register_stage("fours", fails("[47]"), order=45, per_format=True)
    probes, probe = [], q._Ranges.error
    monkeypatch.setattr(q._Ranges, "error", lambda self, *a: probes.append(a) or probe(self, *a))
    found = q.failing_entities("products", catalog, "products", "entity_id", ("short_description", "description"), cleaner)
    assert sorted((p.stage, p.low, p.high) for p in found) == sorted(
        [("sevens", i, i) for i in range(1007, 1300, 10)] + [("fours", i, i) for i in range(1000, 1300) if i % 10 in (4, 7)])
    assert len(probes) == 2


def test_however_many_rows_fail_only_they_skip_the_stage(spark, monkeypatch):
    from vitrine.plans import quarantine as q

    monkeypatch.setattr(q, "MOST_ENTITIES", 3, raising=False)
    ids = range(100, 260)
    # The default text of 100 fails, but its one store sets another.
    catalog = small_shop(
        spark, products=[(i, "S", "n", 1.0, None, f"text {i}", 1, 4) for i in ids], product_stores=[(i, 1) for i in ids],
        product_values=[(100, 1, "description", "own 101")], rewrites=[(i, 1, "product", i, f"p{i}.html", 0) for i in ids], stock=[], prices=[])

    def fails(c):
        return F.when(c.rlike("[02468]$"), F.raise_error(F.lit("no")).cast("string")).otherwise(F.upper(c))

    cleaner, passed = Cleaner().register_stage("fragile", fails, order=35), []
    products = Sections([s for s in DEFAULT_SECTIONS if s.name == "products"])
    blocks, failures = products.isolated_blocks(catalog, (JSONL,), cleaner, passed)
    texts = {r["entity_id"]: json.loads(r["text"])["description"] for r in blocks.collect()}
    assert not failures and texts == {100: "OWN 101"} | {i: f"text {i}" if i % 2 == 0 else f"TEXT {i}" for i in ids[1:]}
    assert sorted((p.stage, p.low, p.high) for found in passed for p in found) == [("fragile", i, i) for i in ids[2::2]]


def test_ranges_left_whole_are_split_in_turn():
    from vitrine.plans import quarantine as q

    class Fake(q._Ranges):
        def __init__(self, ids, bad):
            self.ids, self.bad = ids, bad

        def error(self, low, high, cleaner):
            return "bad" if any(low <= i <= high for i in self.bad) else None

        def cuts(self, low, high):
            inside = [i for i in self.ids if low <= i <= high]
            step = max(1, len(inside) // 16)
            return sorted({*inside[step - 1 :: step], *inside[-1:]})

    ids = [3 * i for i in range(-300, 500)]
    assert sorted(q.failing_ids(Fake(ids, ids[::2]), None)) == [(i, i, "bad") for i in ids[::2]]


def test_probes_stay_few(monkeypatch):
    import math
    from vitrine.plans import quarantine as q

    class Fake(q._Ranges):
        def __init__(self, ids, bad):
            self.ids, self.bad, self.probes = ids, bad, 0

        def error(self, low, high, cleaner):
            self.probes += 1
            return "bad" if any(low <= i <= high for i in self.bad) else None

        def cuts(self, low, high):
            inside = [i for i in self.ids if low <= i <= high]
            step = max(1, len(inside) // 16)
            return sorted({*inside[step - 1 :: step], *inside[-1:]})

    ids = [7 * i for i in range(-500, 5000)]
    for bad in ([ids[0]], [ids[-1]], [ids[77], ids[78]], []):
        fake = Fake(ids, bad)
        assert [(low, high) for low, high, _ in q.failing_ranges(fake, None)] == [(i, i) for i in bad]
        assert fake.probes <= (len(bad) + 1) * (math.log2(len(ids)) + 8)
    fake = Fake(ids, ids[::2])
    ranges = q.failing_ranges(fake, None)
    assert all(any(low <= i <= high for low, high, _ in ranges) for i in ids[::2]) and fake.probes < 500


def test_a_price_of_any_size_loses_no_section(spark, shop, tmp_path):
    dear = dataclasses.replace(shop, products=shop.products.withColumn("price", F.lit(1e16)), cache={})
    report = {(r["store_code"], r["format"]): r for r in run_export(dear, str(tmp_path), formats=(COMPACT,), run_id=1).collect()}
    assert report["default", COMPACT]["outcome"] == "generated"
    assert "### " in document(tmp_path / "documents" / "run=1", COMPACT, "default").partition("## Products")[2]


def test_runs_see_new_rows_and_leave_nothing_staged(spark, shop, tmp_path):
    shop.products.where("entity_id <= 10").write.parquet(str(tmp_path / "products"))
    source = spark.read.schema(shop.products.schema).parquet(str(tmp_path / "products"))
    growing = dataclasses.replace(shop, products=source, cache={})
    staged_before = set(subfolders(spark, shared_dir(spark)))
    first = {r["store_code"]: r["item_count"] for r in run_export(growing, str(tmp_path / "out"), formats=(JSONL,), run_id=1).collect()}
    shop.products.where("entity_id > 10").write.mode("append").parquet(str(tmp_path / "products"))
    source = spark.read.schema(shop.products.schema).parquet(str(tmp_path / "products"))
    growing.products = source
    second = {r["store_code"]: r["item_count"] for r in run_export(growing, str(tmp_path / "out"), formats=(JSONL,), run_id=2).collect()}
    assert second["default"] > first["default"]
    assert set(subfolders(spark, shared_dir(spark))) == staged_before


def test_published_follows_skips_and_failures(spark, shop, tmp_path):
    out = str(tmp_path)
    assert read_status(spark, out + "/run_log").count() == 0
    run_export(shop, out, run_id=1)
    excluded = small_shop(spark, [("general/exclude_store", "stores", 2, "1")])
    run_export(excluded, out, run_id=2, store_code="de")
    current = {(r["store_code"], r["format"]): r["run_id"] for r in published(spark, out).collect()}
    assert current["default", COMPACT] == 1 and ("de", COMPACT) not in current
    failed = spark.createDataFrame([(3, "default", COMPACT, "failed", None, None, None, None, "x")], read_status(spark, out + "/run_log").schema)
    empty = spark.createDataFrame([(4, "default", JSONL, "success", None, 0, 0, 0.1, None)], failed.schema)
    failed.union(empty).withColumn("attempted_at", F.current_timestamp()).write.mode("append").parquet(out + "/run_log")
    current = {(r["store_code"], r["format"]): r["run_id"] for r in published(spark, out).collect()}
    assert current["default", COMPACT] == 1 and current["default", JSONL] == 1
    assert run_history(spark, out).where("status = 'skipped'").count() == 0


def test_partitioned_writes_are_not_sorted(spark, shop, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    for kind in ("parquet", "text"):
        write = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda self, path, *a, _write=write, **k: seen.append((path, self._spark.conf.get(name))) or _write(self, path, *a, **k))
    held = spark.conf.get(name)
    Sections().staged_blocks(dataclasses.replace(shop, cache={}), (COMPACT, JSONL))
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    shop.products.write.parquet(source)
    write_stream(shop, "product", spark.readStream.schema(shop.products.schema).parquet(source), out, state).awaitTermination()
    wide = [int(n) for path, n in seen if "/section=" in path or "/version=" in path]
    assert len(wide) == 6 and min(wide) > 2 and spark.conf.get(name) == held


def test_current_records_move_only_what_came_again(spark, tmp_path):
    for number, ids in enumerate(((1, 2, 3), (2,))):
        rows = spark.createDataFrame([("s", json.dumps({"entity_type": "product", "entity_id": i, "name": f"v{number}"})) for i in ids], "store_code string, value string")
        rows.write.partitionBy("store_code").text(f"{tmp_path}/version={number}")
    found = current_records(spark, str(tmp_path))
    assert sorted((json.loads(r["value"])["entity_id"], json.loads(r["value"])["name"]) for r in found.collect()) == [(1, "v0"), (2, "v1"), (3, "v0")]
    assert "left_anti" in found._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftanti", "left_anti")


def test_stream_takes_only_new_files(spark, shop, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    shop.products.where("entity_id <= 11").write.parquet(source)
    stream = lambda: write_stream(shop, "product", spark.readStream.schema(shop.products.schema).parquet(source), out, state)

    def ids():
        return sorted((r["store_code"], json.loads(r["value"])["entity_id"]) for r in current_records(spark, out).collect())

    stream().awaitTermination()
    assert ids() == [("de", 10), ("default", 10), ("default", 11)]
    shop.products.where("entity_id > 11").write.mode("append").parquet(source)
    stream().awaitTermination()
    assert ids() == [("de", 10), ("default", 10), ("default", 11), ("default", 14), ("default", 16)]


def test_stream_takes_new_and_changed_products(spark, shop, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    empty = dataclasses.replace(shop, products=shop.products.where("false"), cache={})
    stream = lambda: write_stream(empty, "product", spark.readStream.schema(shop.products.schema).parquet(source), out, state)
    shop.products.where("entity_id = 10").write.parquet(source)
    stream().awaitTermination()
    shop.products.where("entity_id = 10").withColumns({"name": F.lit("Renamed"), "price": F.lit(3.0)}).write.mode("append").parquet(source)
    stream().awaitTermination()
    found = {r["store_code"]: json.loads(r["value"]) for r in current_records(spark, out).collect()}
    assert {s: (r["name"], r["price"]) for s, r in found.items()} == {"de": ("Renamed", 3.0), "default": ("Renamed", 3.0)}


def test_changes_follow_versions_in_any_order(spark, shop, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    base = shop.products.where("entity_id in (10, 11, 14)").withColumn("deleted", F.lit(False))

    def deliver(*parts):
        for only, version, changed in parts:
            rows = base.where(F.col("entity_id").isin(*only)).withColumns({"version": F.lit(version).cast("long"), **changed})
            rows.write.mode("append").parquet(source)
        schema = rows.schema
        write_changes(shop, "product", spark.readStream.schema(schema).parquet(source), out, state).awaitTermination()

    def names():
        found = sorted((r["store_code"], json.loads(r["value"])["entity_id"], json.loads(r["value"])["name"]) for r in current_changes(spark, out).collect())
        return [(i, n) for s, i, n in found if s == "default"]

    assert current_changes(spark, out).count() == 0 and compact(spark, out) == -1
    deliver(([10, 11, 14], 1, {}))
    assert names() == [(10, "Red shoe"), (11, "Blue shoe"), (14, "No price")]
    deliver(([10], 3, {"name": F.lit("Third")}), ([10], 2, {"name": F.lit("Second")}), ([11], 2, {"status": F.lit(2)}))
    assert names() == [(10, "Third"), (14, "No price")]
    assert compact(spark, out) == 1 and subfolders(spark, out + "/changes") == []
    assert names() == [(10, "Third"), (14, "No price")]
    deliver(([11], 1, {"name": F.lit("Late")}), ([14], 5, {"deleted": F.lit(True)}), ([14], 5, {}), ([10], None, {"name": F.lit("Undated")}))
    assert names() == [(10, "Third")]
    deliver(([11], 3, {"status": F.lit(1)}), ([14], 4, {}))
    assert names() == [(10, "Third"), (11, "Blue shoe")]
    (tmp_path / "out" / "changes" / "batch=9").mkdir()
    assert names() == [(10, "Third"), (11, "Blue shoe")] and compact(spark, out) == 3 and names() == [(10, "Third"), (11, "Blue shoe")]


def test_changes_of_pages_and_categories(spark, shop):
    for kind, table, key, wanted in (("page", shop.pages, "page_id", {1, 2}), ("category", shop.categories, "entity_id", {5, 6, 8, 30})):
        rows = change_rows(shop, kind, table.withColumn("version", F.lit(1).cast("long"))).collect()
        assert {r["entity_id"] for r in rows if r["store_code"] is None} == {r[key] for r in table.collect()}
        assert {json.loads(r["value"])["entity_id"] for r in rows if r["store_code"]} == wanted


def test_stream_of_pages_and_categories(spark, shop, tmp_path):
    for kind, table, expected in (("page", shop.pages, 4), ("category", shop.categories, 4)):
        source, out, state = (str(tmp_path / kind / d) for d in ("in", "out", "state"))
        table.write.parquet(source)
        write_stream(shop, kind, spark.readStream.schema(table.schema).parquet(source), out, state).awaitTermination()
        assert current_records(spark, out).count() == expected


def test_catalog_from_files_without_optional_tables(spark, shop, tmp_path):
    for name, df in shop.tables().items():
        if name not in ("prices", "countries", "directives", "requests", "run_log"):
            df.write.parquet(str(tmp_path / name))
    catalog = Catalog.from_parquet(spark, str(tmp_path))
    assert catalog.prices is None and catalog.scan_stores("de").count() == 1
    sections = Sections([s for s in Sections().sections if s.name in ("store", "products")])
    text = {r["store_code"]: r["document"] for r in small_documents(sections.blocks(catalog, (COMPACT,))).collect()}["default"]
    assert "> Country: US\n" in text
    assert "Price: 10.00 USD" in text and "Price: 20.50 USD" in text
    assert "Description: See and end\n" in text


def test_compressed_documents_read_back_in_order(spark, tmp_path):
    rows = [("s", 10, n, n, "jsonl", f"{n:05d} " + "same words " * 30 + "\n") for n in range(40)]
    blocks = spark.createDataFrame(rows, "store_code string, section_ord int, position long, entity_id long, format string, text string")
    size = {}
    for kind in ("none", "gzip"):
        path = str(tmp_path / kind)
        write_documents(blocks, path, partitions=1, file_rows=3, compression=kind)
        lines = [r["line"] for r in read_lines(spark, path).orderBy("pos").collect()]
        assert lines == [r[5].rstrip("\n") for r in rows]
        size[kind] = sum(f.stat().st_size for f in (tmp_path / kind).rglob("part-*"))
    assert size["gzip"] < size["none"] / 2
    folder = tmp_path / "named" / "store_code=s"
    folder.mkdir(parents=True)
    for n in range(12):
        (folder / f"part-00000-00c12.c{n:03d}.txt").write_text(f"{n}\n" * (n + 1))
    held = [r["line"] for r in read_lines(spark, str(folder.parent)).orderBy("pos").collect()]
    assert held == [str(n) for n in range(12) for _ in range(n + 1)]


def test_all_formats_are_rendered_in_one_go(spark, monkeypatch):
    import __spark_entry__ as entry

    def asked_by(*parts):
        catalog, asked = SimpleNamespace(cache={}), []
        monkeypatch.setattr(entry.derived, "load", lambda spark, sf: catalog)
        monkeypatch.setattr(Sections, "staged_blocks", lambda self, c, formats: asked.append(formats) or spark.createDataFrame([(f,) for f in formats], "format string"))
        return asked, [sorted(r["format"] for r in part(spark, "").collect()) for part in parts]

    text, every = sorted(TEXT_FORMATS), sorted(FORMATS)
    assert asked_by(entry._all_blocks, entry._text_blocks, entry._record_blocks) == ([FORMATS], [every, text, [JSONL]])
    assert asked_by(entry._text_blocks, entry._all_blocks) == ([TEXT_FORMATS, (JSONL,)], [text, every])
