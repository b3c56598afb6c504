"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings; built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of the contract; group 2 of the first is the secret. The longer minimum of access and hex keeps the same matches.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)(?:password|passwd|secret|token|api_?key)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGN = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
HEX_ONLY = r"^[0-9A-Fa-f]+$"
#: Bits per character of a window from which a string of the class counts as random.
HEX_BITS, MIXED_BITS = 3.0, 3.7
#: Suppressed: no digit, no letter, UUIDs, dashed or slashed plain words.
ALLOW = (
    r"^[^0-9]*$", r"^[^A-Za-z]*$", r"(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$", r"^[a-z]+(?:[-_/][a-z]+)*(?:[-_/=][0-9]+)?$",
)
#: Pieces between slashes that name themselves samples aren't random, whatever their characters.
SAMPLE = r"(?i)(?:example|sample|placeholder|dummy|xxxx|0123456789|abcdefgh)"
_SCALE = 1 << 20
#: c * log2(c) as whole numbers, so that the running sum of a window has no rounding drift.
_WEIGHTS = [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 2)]


def _located(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, body), in code points, end exclusive."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("body"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int,body:string>>")

    def step(acc, m):
        start = acc["at"] + F.char_length(m["gap"])
        end = start + F.coalesce(F.char_length(m["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["body"].alias("body"))
        return F.struct(end.alias("at"), F.when(m["whole"].isNull(), acc["all"]).otherwise(F.array_append(acc["all"], span)).alias("all"))

    return F.aggregate(found, F.struct(F.lit(0).alias("at"), none.alias("all")), step, lambda acc: acc["all"])


def _where(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,body:string>>"))


def _random_part(body: Column) -> Column:
    """(first, last): code points of the body covered by windows of high entropy, NULL where none is.

    The window moves one character at a time: the counts of the character that enters and of the one that leaves
    change the sum of c * log2(c), from which the entropy follows.
    """
    weights = F.array(*map(F.lit, _WEIGHTS))
    bits = F.when(body.rlike(HEX_ONLY), F.lit(HEX_BITS)).otherwise(F.lit(MIXED_BITS))
    most = F.floor((math.log2(WINDOW) - bits) * (WINDOW * _SCALE))

    def run(chars: Column, most: Column) -> Column:
        def weight(n):
            return F.element_at(weights, n + 1)

        def step(acc, i):
            held = F.slice(chars, F.greatest(i - WINDOW, F.lit(1)), F.least(i - 1, F.lit(WINDOW)))
            new, old = F.element_at(chars, i), F.element_at(chars, F.greatest(i - WINDOW, F.lit(1)))
            n_new = F.size(F.filter(held, lambda c: c == new))
            n_old = F.size(F.filter(held, lambda c: c == old)) + F.when(new == old, 1).otherwise(0)
            total = acc["total"] + weight(n_new + 1) - weight(n_new)
            total = F.when(i > WINDOW, total + weight(n_old - 1) - weight(n_old)).otherwise(total)
            passed = (i >= WINDOW) & (total <= acc["most"])
            return F.struct(
                total.alias("total"), acc["most"].alias("most"),
                F.when(passed & acc["first"].isNull(), i - WINDOW).otherwise(acc["first"]).alias("first"),
                F.when(passed, i).otherwise(acc["last"]).alias("last"),
            )

        start = F.struct(F.lit(0).cast("long").alias("total"), most.alias("most"), F.lit(None).cast("int").alias("first"),
                         F.lit(None).cast("int").alias("last"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step,
                           lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    # One-element transform: the characters are split once, not at each use.
    plain = F.array_join(F.transform(F.split(body, "/"), lambda p: F.when(p.rlike(SAMPLE), F.repeat(F.lit("a"), F.length(p))).otherwise(p)), "/")
    rated = F.when(body.rlike(SAMPLE), plain).otherwise(body)
    return F.element_at(F.transform(F.array(F.filter(F.split(rated, ""), lambda c: c != "")), lambda chars: run(chars, most)), 1)


def _entropy(text: Column, base: Column) -> Column:
    def suspicious(s):
        out = F.lit(True)
        for pattern in ALLOW:
            out = out & ~s["body"].rlike(pattern)
        return out

    rated = F.transform(F.filter(_located(text, CANDIDATE, 3), suspicious), lambda s: F.struct(s["start"].alias("start"), _random_part(s["body"]).alias("part")))
    spans = F.transform(F.filter(rated, lambda s: s["part"]["first"].isNotNull()), lambda s: F.struct(
        (s["start"] + s["part"]["first"]).alias("start"), F.lit(3).alias("kind"), (s["start"] + s["part"]["last"]).alias("end"),
        F.lit("").alias("body"),
    ))
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``: (start, kind, end) by start, kind an index of `KINDS`, code points, end exclusive.

    NULL and empty texts have none; repeated rows each get theirs; a column of the result's name is replaced, no other
    one is touched. A random stretch that lies wholly inside a pattern's span gets no span of its own; one that goes beyond it does.
    """
    held = "_base"
    while held in docs.columns:
        held += "_"
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        F.filter(_where(body.rlike(ASSIGN_HINT), _located(body, ASSIGN, 0, 2)), lambda s: F.char_length(s["body"]) >= MIN_ASSIGN),
        _where(body.contains("AKIA"), _located(body, ACCESS, 1)),
        _where(body.rlike(HEX), _located(body, HEX, 2)),
    )
    marked = docs.drop("secret_spans").withColumn(held, F.array_sort(F.transform(base, lambda s: F.struct(s["start"], s["kind"], s["end"]))))
    named = F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    marked = marked.withColumn(held, named)
    extra = F.transform(
        _where(body.rlike(CANDIDATE), _entropy(body, F.col(held))),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    return marked.withColumn("secret_spans", F.array_sort(F.concat(held, extra))).drop(held)


def spans_text(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def mask_secrets(docs: DataFrame, text: str = "text", mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with each stretch of secret characters replaced; NULL texts stay NULL."""
    held = [f"_c{i}" for i in range(len(docs.columns))]
    column = held[docs.columns.index(text)]
    found = find_secrets(docs.toDF(*held), column)
    body = F.col(column)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["out"], gap, F.lit(mask)).alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))

    masked = F.aggregate("secret_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.char_length(body))))
    return found.select(*[
        F.when(F.size("secret_spans") > 0, masked).otherwise(body).alias(c) if c == column else F.col(c) for c in held
    ]).toDF(*docs.columns)


def secrets_report(found: DataFrame) -> DataFrame:
    """Counts, digest of the pattern spans, and all spans, from `find_secrets`."""
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{name}": count(kind) for kind, name in enumerate(KINDS[:3])}
    return found.withColumns(counts | {"base_sha256": F.sha2(spans_text(base), 256), "spans": spans_text(F.col("secret_spans"))}).drop("secret_spans")
