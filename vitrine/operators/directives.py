"""Substitution of ``{{…}}`` directives by values looked up per store.

Values are joined to the distinct (store, token) pairs that texts ask for, as rows; what a text needs of them then comes back to it and is
woven in by position. A store may have any number of values: none of its rows holds more than a text's own tokens.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIRECTIVE = r"(?s)\{\{.*?\}\}"


def distinct_values(values: DataFrame) -> DataFrame:
    """One row per (store_id, token); of repeated ones the largest value counts."""
    return values.groupBy("store_id", "token").agg(F.max("value").alias("value"))


def tokens_of(*texts: Column) -> Column:
    """The distinct directives in some texts."""
    found = [F.when(t.contains("{{"), F.regexp_extract_all(t, F.lit(DIRECTIVE), 0)) for t in texts]
    return F.array_distinct(F.flatten(F.array(*(F.coalesce(f, F.array().cast("array<string>")) for f in found))))


def found_values(asked: DataFrame, values: DataFrame) -> DataFrame:
    """(``entity_id``, ``_found``): the values of the (``entity_id``, ``store_id``, ``token``) rows that have one, gathered per entity."""
    hits = asked.distinct().join(values, ["store_id", "token"])
    return hits.groupBy("entity_id").agg(F.collect_list(F.struct("store_id", "token", "value")).alias("_found"))


def values_in(store: Column) -> Column:
    """Of ``_found``, the token map of one store."""
    own = F.filter("_found", lambda v: v["store_id"] == store)
    return F.map_from_entries(F.transform(own, lambda v: F.struct(v["token"], v["value"])))


def woven(column: str, values: Column) -> Column:
    """The text split at its directives, with values between; a value is never searched again. Without ``values`` it stays."""

    def value_of(token: Column) -> Column:
        return F.coalesce(F.try_element_at(values, token), token)

    text = F.col(column)
    pieces = F.split(text, DIRECTIVE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(DIRECTIVE), 0), value_of)
    joined = F.concat_ws("", F.zip_with(pieces, found, lambda piece, hit: F.concat(piece, F.coalesce(hit, F.lit("")))))
    return F.when(values.isNotNull() & text.contains("{{"), joined).otherwise(text)


def substitute_directives(
    df: DataFrame, columns: Sequence[str], values: DataFrame, store: str = "store_id", key: str = "entity_id"
) -> DataFrame:
    """``df`` with each directive in ``columns`` replaced by its value from a table (store_id, token, value).

    ``key`` names the text; a key that several rows share only brings them each other's values. A token without a value stays (the
    HTML stage drops it later), and so do all tokens of a row whose ``store`` or ``key`` is NULL. Rows without a token are not moved.
    """
    has = functools.reduce(Column.__or__, (F.coalesce(F.col(c).contains("{{"), F.lit(False)) for c in columns)) & F.col(store).isNotNull()
    with_token = df.where(has)
    asked = with_token.select(
        F.col(key).alias("_key"), F.col(store).alias("_of"), F.explode(tokens_of(*map(F.col, columns))).alias("_token"))
    pairs = distinct_values(values).select(F.col("store_id").alias("_of"), F.col("token").alias("_token"), F.col("value").alias("_value"))
    hits = asked.distinct().join(pairs, ["_of", "_token"]).groupBy("_key", "_of").agg(
        F.map_from_entries(F.collect_list(F.struct("_token", "_value"))).alias("_values"))
    joined = with_token.join(hits, (with_token[key] == hits["_key"]) & (with_token[store] == hits["_of"]), "left").drop("_key", "_of")
    return joined.withColumns({c: woven(c, F.col("_values")) for c in columns}).drop("_values").unionByName(df.where(~has))
