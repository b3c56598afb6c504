"""URL filters: host and path rules, then association rules mined by FP-growth from the URLs the rules decide."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.spark_tools import staged

#: Rules of the contract: verdict, host, path.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"
_BLOCK, _ALLOW = "label=block", "label=allow"


def with_rule(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``ruled`` (the verdict of the longest rule that fits, else NULL)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    full = F.coalesce(F.col(url), F.lit(""))
    pages = pages.withColumns({
        "host": F.translate(F.regexp_extract(full, r"(?s)^.*?://([^/?#]*)", 1), upper, lower),
        "path": F.regexp_extract(full, r"(?s)^.*?://[^/?#]*([^?#]*)", 1),
    })
    rule = ruled = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = F.concat(F.lit("."), "host").endswith("." + host) & F.col("path").startswith(path)
        rule, ruled = F.when(fits, host + path).otherwise(rule), F.when(fits, verdict).otherwise(ruled)
    return pages.withColumns({"rule": rule, "ruled": ruled})


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of an address: labels of its host and words of its path; numbers carry no meaning of their own."""
    labels = F.transform(F.split(host, r"\."), lambda t: F.concat(F.lit("h:"), t))
    words = F.transform(F.split(path, r"[^\p{L}\p{N}]+"), lambda t: F.concat(F.lit("p:"), t))
    both = F.filter(F.concat(labels, words), lambda t: (F.char_length(t) > 2) & ~t.rlike(r"^p:\p{N}+$"))
    return F.array_sort(F.array_distinct(both))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (``tokens``, ``verdict``, ``confidence``, ``support``) from rows of (``tokens``, ``ruled``); all rows are used."""
    label = F.when(F.col("ruled") == "block", _BLOCK).otherwise(_ALLOW)
    items = labelled.select(F.array_append("tokens", label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.element_at("consequent", 1).isin(_BLOCK, _ALLOW))
    verdict = F.when(F.element_at("consequent", 1) == _BLOCK, "block").otherwise("allow")
    return rules.select(F.array_sort("antecedent").alias("tokens"), verdict.alias("verdict"), "confidence", "support")


def match_rules(addresses: DataFrame, rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """Verdict per distinct ``tokens``: the best rule whose tokens all occur, found through its rarest token.

    The best has the highest confidence, then the most tokens, the highest support, block before allow, and the first tokens.
    """
    counts = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    by_token = rules.withColumn("token", F.explode("tokens")).join(counts, "token")
    index = by_token.groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    index = index.withColumnRenamed("tokens", "needed")
    hits = addresses.withColumn("token", F.explode("tokens")).join(index, "token").where(F.size(F.array_except("needed", "tokens")) == 0)
    rank = F.struct(-F.col("confidence"), -F.size("needed"), -F.col("support"), F.col("verdict") != "block", F.col("needed"), F.col("verdict").alias("v"))
    return hits.groupBy("tokens").agg(F.min(rank)["v"].alias("mined"))


def token_classes(labelled: DataFrame) -> DataFrame:
    """(``token``, ``rep``): tokens that occur in exactly the same rows of ``labelled`` (``tokens``) share their first as ``rep``.

    The words of a URL template always come together; mined one by one they would give a rule for each of their subsets.
    """
    sets = labelled.select("tokens").distinct()
    rows = sets.select(F.explode("tokens").alias("token"), *(F.xxhash64(F.lit(i), "tokens").alias(f"h{i}") for i in (1, 2)))
    marks = rows.groupBy("token").agg(F.count("*").alias("n"), *(F.bit_xor(f"h{i}").alias(f"x{i}") for i in (1, 2)))
    alike = marks.groupBy("n", "x1", "x2").agg(F.min("token").alias("rep"))
    return marks.join(alike, ["n", "x1", "x2"]).select("token", "rep")


def _as_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(``tokens``, ``reps``) of each distinct ``tokens`` of ``rows``; tokens without a class occur in no labelled row and drop out."""
    parts = rows.select("tokens").distinct().withColumn("token", F.explode("tokens")).join(classes, "token")
    return parts.groupBy("tokens").agg(F.array_sort(F.collect_set("rep")).alias("reps"))


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` without the URL, with ``host``, ``path``, ``rule`` and ``verdict``.

    A URL that no rule fits is judged by mined rules, and allowed where none matches. NULL URLs and such without ``://`` have an
    empty host and path and no tokens. Repeated rows each get their row; an empty table gives no rows. Columns named like a
    result column are replaced; no other column is touched.
    """
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in made and c != url]
    held = [f"_c{i}" for i in range(len(kept))]
    asked = pages.select(*[F.col(c).alias(h) for c, h in zip(kept, held)], F.col(url).alias("url"))
    judged = staged(with_rule(asked, "url", rules).drop("url").withColumn("tokens", url_tokens(F.col("host"), F.col("path"))), "urls")
    ruled = judged.where(F.col("ruled").isNotNull()).select("tokens", "ruled")
    classes = staged(token_classes(ruled), "url-classes")
    reps = staged(_as_classes(judged.where(F.size("tokens") > 0), classes), "url-reps")
    labelled = ruled.join(reps, "tokens").select(F.col("reps").alias("tokens"), "ruled")
    labelled = staged(labelled.unionByName(ruled.where(F.size("tokens") == 0).select("tokens", "ruled")), "url-labelled")
    mined = mine_rules(labelled, min_support, min_confidence)
    verdicts = match_rules(reps.select(F.col("reps").alias("tokens")).distinct(), mined, labelled).withColumnRenamed("tokens", "reps")
    verdicts = staged(reps.join(verdicts, "reps").select("tokens", "mined"), "url-verdicts")
    bare = judged.where(F.col("ruled").isNotNull() | (F.size("tokens") == 0)).withColumn("mined", F.lit(None).cast("string"))
    open_rows = judged.where(F.col("ruled").isNull() & (F.size("tokens") > 0)).join(verdicts, "tokens", "left")
    return bare.unionByName(open_rows).select(
        *[F.col(h).alias(c) for c, h in zip(kept, held)], "host", "path", "rule", F.coalesce("ruled", "mined", F.lit(DEFAULT)).alias("verdict")
    )
