"""Values that a store sets for an entity in place of the default ones, attribute by attribute.

Facts (name, price, switches) are narrow and ride on the listing rows. Texts are wide: equal ones of an entity make one version, known
by a hash of its content, which is cleaned once and serves every store that sets it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCT_FACTS, PRODUCT_TEXTS = ("name", "price", "status", "visibility"), ("short_description", "description")
CATEGORY_FACTS, CATEGORY_TEXTS = ("name", "is_active"), ("description", "meta_description")
TYPES = {"price": "double", "status": "int", "visibility": "int", "is_active": "boolean"}


def own_values(values: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """(``entity_id``, ``store_id``, a struct per attribute): the store's value, which may be NULL, or no struct where the default counts.

    Of repeated rows the largest value counts. ``values`` has (entity_id, store_id, attribute, value).
    """
    def one(attribute: str) -> Column:
        value = F.col("value").try_cast(TYPES[attribute]) if attribute in TYPES else F.col("value")
        return F.max(F.when(F.col("attribute") == attribute, F.struct(value.alias("value")))).alias(attribute)

    return values.where(F.col("attribute").isin(*attributes)).groupBy("entity_id", "store_id").agg(*map(one, attributes))


def _with_version(values: DataFrame, texts: Sequence[str]) -> DataFrame:
    content = F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})
    return own_values(values, texts).withColumn("version", F.sha2(content, 256))


def own_facts(values: DataFrame, facts: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """(``entity_id``, ``_own``): what each store sets for the entity, in one short array (an entry per store at most), texts as ``version``."""
    both = own_values(values, facts).join(_with_version(values, texts).drop(*texts), ["entity_id", "store_id"], "full")
    return both.groupBy("entity_id").agg(F.collect_list(F.struct("store_id", *facts, "version")).alias("_own"))


def pick_own(listing: DataFrame, facts_of: DataFrame, facts: Sequence[str]) -> DataFrame:
    """``listing`` with ``own_…`` for each fact and the ``version`` of the texts that its store has of the entity, NULL for the default."""
    mine = F.try_element_at(F.filter("_own", lambda o: o["store_id"] == F.col("store_id")), F.lit(1))
    picked = listing.join(facts_of, "entity_id", "left").withColumn("_own", mine)
    return picked.withColumns({**{f"own_{f}": F.col(f"_own.{f}") for f in facts}, "version": F.col("_own.version")}).drop("_own")


def own_or(attribute: str, default: str | Column | None = None) -> Column:
    """The store's value where it sets one, else the default."""
    default = F.col(attribute) if default is None else F.col(default) if isinstance(default, str) else default
    return F.when(F.col(f"own_{attribute}").isNotNull(), F.col(f"own_{attribute}.value")).otherwise(default)


def text_versions(values: DataFrame, texts: Sequence[str]) -> DataFrame:
    """(``entity_id``, ``version``, a struct per text): each distinct content once."""
    rows = _with_version(values, texts)
    return rows.groupBy("entity_id", "version").agg(*(F.max(t).alias(t) for t in texts))


def resolve(rows: DataFrame, values: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """(entity_id, store_id, …) rows with ``attributes`` as the store sees them."""
    own = own_values(values, attributes).select("entity_id", "store_id", *(F.col(a).alias(f"own_{a}") for a in attributes))
    seen = rows.join(own, ["entity_id", "store_id"], "left")
    return seen.withColumns({a: own_or(a) for a in attributes}).drop(*(f"own_{a}" for a in attributes))
