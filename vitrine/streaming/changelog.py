"""A changelog of records: upserts and removals of entities by version, and its compaction.

Each change of an entity leaves one head row, and a record row per store that lists the entity then. The head of the highest version
decides: records of older versions are void, in stores that still list the entity and in those that no longer do. So neither the
order of batches nor that of rows within one matters, and a batch that is run again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vitrine.functions.cleaning import Cleaner
from vitrine.sources.catalog import Catalog
from vitrine.spark_tools import finished_folders, remove_folder, staged
from vitrine.streaming.incremental import entity_key, records_of

#: Rows of the log; a head has no store.
CHANGE = "kind string, entity_id long, version long, deleted boolean, store_code string, value string"
_OLDEST = -(2**63)


def change_rows(catalog: Catalog, kind: str, changes: DataFrame, cleaner: Cleaner | None = None) -> DataFrame:
    """Log rows for a table of changes: entity rows with a ``version`` and, if any are removed, ``deleted``.

    Only the last version of each entity in the table is rendered. Of equal versions a removal counts; a NULL version is the oldest;
    rows without an id are left out.
    """
    key = entity_key(kind)
    deleted = F.coalesce("deleted", F.lit(False)) if "deleted" in changes.columns else F.lit(False)
    dated = changes.where(F.col(key).isNotNull()).withColumns({"deleted": deleted, "version": F.coalesce("version", F.lit(_OLDEST))})
    last = dated.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct("version", "deleted")).alias("last")).select("_key", "last.*")
    heads = last.select(F.lit(kind).alias("kind"), F.col("_key").alias("entity_id"), "version", "deleted",
                        F.lit(None).cast("string").alias("store_code"), F.lit(None).cast("string").alias("value"))
    # Only entities that come several times need their last version looked up: the few of them meet the texts, not every entity.
    several = dated.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct("version", "deleted")).alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    met = dated.join(staged(several.select("_key", "_last"), "several"), F.col(key) == F.col("_key"), "left")
    live = F.coalesce(F.col("version") == F.col("_last.version"), F.lit(True)) & ~F.coalesce("_last.deleted", "deleted")
    rows = met.where(live).withColumn("change", F.col("version")).drop("_key", "_last", "version", "deleted")
    records = records_of(catalog, kind, rows, cleaner, keep=("entity_id", "change"))
    return heads.unionByName(records.select(
        F.lit(kind).alias("kind"), "entity_id", F.col("change").alias("version"), F.lit(False).alias("deleted"), "store_code", "value"))


def write_changes(catalog: Catalog, kind: str, changes: DataFrame, out: str, checkpoint: str, cleaner: Cleaner | None = None) -> StreamingQuery:
    """Log the changes that have arrived on a stream since the last call under ``{out}/changes/batch=…``, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        change_rows(catalog, kind, batch, cleaner).write.mode("overwrite").parquet(f"{out.rstrip('/')}/changes/batch={number}")

    return (
        changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.partition("=")[2]) for name in finished_folders(spark, folder))


def _log(spark: SparkSession, out: str) -> tuple[DataFrame, int]:
    """Rows of the last snapshot and of the finished batches after it, and the last batch among them (-1: none)."""
    root = out.rstrip("/")
    upto = max(_numbers(spark, f"{root}/snapshots"), default=-1)
    later = [n for n in _numbers(spark, f"{root}/changes") if n > upto]
    paths = [f"{root}/snapshots/upto={upto}"] * (upto >= 0) + [f"{root}/changes/batch={n}" for n in later]
    rows = spark.read.schema(CHANGE).parquet(*paths) if paths else spark.createDataFrame([], CHANGE)
    return rows, max(later, default=upto)


def _heads(rows: DataFrame) -> DataFrame:
    heads = rows.where(F.col("store_code").isNull()).groupBy("kind", "entity_id").agg(F.max(F.struct("version", "deleted")).alias("head"))
    return heads.select("kind", "entity_id", "head.*")


def _current(rows: DataFrame) -> DataFrame:
    """Record rows of each entity's last version; of equal versions the largest record counts."""
    keys = ["kind", "entity_id", "version", "store_code"]
    records = rows.where(F.col("store_code").isNotNull()).drop("deleted")
    made = records.groupBy(*keys).agg(F.count("*").alias("n"))
    heads = _heads(rows).where(~F.col("deleted")).drop("deleted")
    # Void versions and records that come twice in a version are told from the keys, so that the text of the others is not moved.
    void = staged(made.select(*keys[:3]).distinct().join(heads, keys[:3], "left_anti"), "void")
    again = staged(made.where("n > 1").select(*keys), "again")
    live = records.join(void, keys[:3], "left_anti")
    compared = live.join(again, keys, "left_semi").groupBy(*keys).agg(F.max("value").alias("value"))
    return live.join(again, keys, "left_anti").select(*keys, "value").unionByName(compared)


def current_changes(spark: SparkSession, out: str) -> DataFrame:
    """(store_code, value): the record of each entity in each store that lists it, after all logged changes."""
    return _current(_log(spark, out)[0]).select("store_code", "value")


def compact(spark: SparkSession, out: str, remove: bool = True) -> int:
    """Write the current state as a snapshot, heads included, and return its last batch; then drop what it replaces, if asked.

    Heads of removed entities stay, so that an older version that arrives late stays void. A snapshot counts once it is finished, so a
    stopped compaction leaves the log as it was.
    """
    root = out.rstrip("/")
    rows, upto = _log(spark, out)
    if upto < 0 or upto in _numbers(spark, f"{root}/snapshots"):
        return upto
    heads = _heads(rows).withColumns({"store_code": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})
    state = heads.unionByName(_current(rows).withColumn("deleted", F.lit(False)))
    state.write.mode("overwrite").parquet(f"{root}/snapshots/upto={upto}")
    if remove:
        for folder, name in (("snapshots", "upto"), ("changes", "batch")):
            for n in _numbers(spark, f"{root}/{folder}"):
                if n < upto or (n == upto and folder == "changes"):
                    remove_folder(spark, f"{root}/{folder}/{name}={n}")
    return upto
