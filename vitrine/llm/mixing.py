"""Mixing sources to target weights: exact word quotas per source, split among shards by a multivariate-hypergeometric tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.spark_tools import staged

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
#: Documents of a source per leaf of its tree, on average; the tree deepens with the source. Leaves per span when leftovers are summed.
LEAF_DOCS = 256
LEAF_SPAN = 1024
WORD = r"[^\x20\x09-\x0D]+"
SEED = 20
#: Above this standard deviation a draw is found by rejection, below by inverting the distribution; both draw from it exactly.
INVERTED_SD = 2048.0
#: Proposals of one rejection draw. One in four is taken, so all of them fail with a probability below 1e-31; then the mode is drawn.
PROPOSALS = 256


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source of (``source``, ``size``): ``source_size``, ``target``, and what it means in full ``passes`` and a ``rest``.

    Targets share the total by weight but stop at `MAX_PASSES` times the size, the excess going to the others by weight. That is
    one level L for which min(3 * size, L * weight) sums to the total. One narrow row per source is ordered in one place.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("rank", F.row_number().over(rank))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    ranked = ranked.withColumn("ratio", F.col("source_size") * float(MAX_PASSES) / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "rank")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = F.coalesce(F.sum(F.col("source_size") * MAX_PASSES).over(before), F.lit(0))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(every) - capped) / F.sum("weight").over(after))
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "rank", "level"))).over(every)["level"]
    target = F.least(F.col("source_size") * float(MAX_PASSES), level * F.col("weight"))
    ranked = ranked.withColumn("target", F.coalesce(target, F.lit(0.0)))
    words = F.least(F.round("target").cast("long"), F.col("source_size") * MAX_PASSES)
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    return ranked.select(
        F.col("rank").cast("long").alias("source_no"), "source", "source_size", "target", passes.alias("passes"),
        (words - passes * F.col("source_size")).alias("rest"),
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, *key: Column | str) -> Column:
    """How many of ``drawn`` out of ``total`` words fall on the ``marked`` ones, at random by ``key``.

    Narrow distributions are inverted. Wide ones are drawn by rejection at constant cost: a log-concave distribution with p at its
    mode lies below p * min(1, exp(1 - p * distance from the mode)), and ratios to the mode follow from Stirling's series, whose
    error is far below that of a double at the sizes in question.
    """
    def fraction(hashed):
        return (F.shiftrightunsigned(hashed, 11) + 0.5) / float(1 << 53)

    def let(value, body):
        return F.element_at(F.transform(F.array(value), body), 1)

    uniform = fraction(F.xxhash64(F.lit(SEED), *key))
    args = F.struct(
        total.cast("double").alias("n"), marked.cast("double").alias("m"), drawn.cast("double").alias("d"), uniform.alias("u"),
        F.xxhash64(F.lit(SEED + 1), *key).alias("h"),
    )

    def spread(a):
        mean = a["d"] * a["m"] / a["n"]
        sd = F.sqrt(mean * (a["n"] - a["m"]) / a["n"] * (a["n"] - a["d"]) / F.greatest(a["n"] - 1, F.lit(1.0)))
        least, most = F.greatest(F.lit(0.0), a["d"] - (a["n"] - a["m"])), F.least(a["d"], a["m"])
        return F.struct(
            *[a[c].alias(c) for c in "nmduh"], mean.alias("mean"), sd.alias("sd"), least.alias("least"), most.alias("most"),
            F.greatest(least, F.floor(mean - 9 * sd) - 1).cast("long").alias("lo"), F.least(most, F.ceil(mean + 9 * sd) + 1).cast("long").alias("hi"),
        )

    def exact(s):
        def ratio(k):
            return (s["m"] - k) * (s["d"] - k) / ((k + 1) * (s["n"] - s["m"] - s["d"] + k + 1))

        steps = F.sequence(s["lo"], s["hi"] - 1)
        whole = F.aggregate(
            steps, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum")),
            lambda acc, k: F.struct((acc["w"] * ratio(k)).alias("w"), (acc["sum"] + acc["w"] * ratio(k)).alias("sum")),
            lambda acc: acc["sum"],
        )
        return let(whole * s["u"], lambda goal: F.aggregate(
            steps, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), s["lo"].alias("pick")),
            lambda acc, k: F.struct(
                (acc["w"] * ratio(k)).alias("w"), (acc["sum"] + acc["w"] * ratio(k)).alias("sum"),
                (acc["pick"] + F.when(acc["sum"] < goal, 1).otherwise(0)).alias("pick"),
            ),
            lambda acc: acc["pick"],
        ))

    def grown(a, e):
        """log((a + e)! / a!) without its term e * log(a)."""
        x = e / a
        return a * ((1 + x) * F.log1p(x) - x) + F.log1p(x) / 2 + (1 / (a + e) - 1 / a) / 12

    def log_ratio(c, e):
        """log of the probability of mode + e over that of the mode."""
        slope = F.log(c["mode"] * c["neither"] / (c["unmarked"] * c["undrawn"]))
        return -(e * slope + grown(c["mode"], e) + grown(c["neither"], e) + grown(c["unmarked"], -e) + grown(c["undrawn"], -e))

    def proposal(c, i):
        def number(j):
            return fraction(F.xxhash64(c["h"], i, F.lit(j)))

        # 0.39 / sd is below p, so the bound holds. It is flat up to ``edge``.
        p, w = F.lit(0.39) / c["sd"], 1 + F.lit(0.195) / c["sd"]
        edge = w / p
        far = F.when(number(0) * (1 + w) <= w, number(1) * edge).otherwise(edge - F.log(number(1)) / p)

        def step(y):
            return F.when(number(2) < 0.5, -1.0).otherwise(1.0) * F.floor(y + 0.5).cast("double")

        def judged(q):
            inside = (c["mode"] + q["e"] > 0) & (c["neither"] + q["e"] > 0) & (c["unmarked"] > q["e"]) & (c["undrawn"] > q["e"])
            # A mode that rounding put beside the true one is covered by a bound a millionth higher.
            bound = F.log(number(3) * 1.000001) + F.least(F.lit(0.0), w - p * q["y"])
            return F.when(inside, F.when(bound <= log_ratio(c, q["e"]), q["e"]))

        return let(let(far, lambda y: F.struct(y.alias("y"), step(y).alias("e"))), judged)

    def rejection(s):
        mode = F.floor((s["d"] + 1) * ((s["m"] + 1) / (s["n"] + 2))).cast("double")
        cells = let(mode, lambda k: F.struct(
            s["h"].alias("h"), s["sd"].alias("sd"), k.alias("mode"), (s["d"] - k).alias("unmarked"), (s["m"] - k).alias("undrawn"),
            (s["n"] - s["m"] - s["d"] + k).alias("neither"),
        ))
        tries = F.sequence(F.lit(1), F.lit(PROPOSALS))
        return let(cells, lambda c: (c["mode"] + F.coalesce(F.aggregate(
            tries, F.lit(None).cast("double"), lambda taken, i: F.when(taken.isNotNull(), taken).otherwise(proposal(c, i)),
        ), F.lit(0.0))).cast("long"))

    def pick(s):
        return F.when(s["hi"] <= s["lo"], s["lo"]).when(s["sd"] > INVERTED_SD, rejection(s)).otherwise(exact(s))

    return let(let(args, spread), pick)


def depth_of(docs: Column) -> Column:
    """Levels of a tree with about `LEAF_DOCS` documents per leaf."""
    return F.greatest(F.lit(0), F.ceil(F.log2(docs / LEAF_DOCS))).cast("int")


def split_quotas(leaves: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """Quota of each leaf: (``source_no``, ``leaf``, ``quota``) from leaf sizes (``source_no``, ``depth``, ``leaf``, ``words``).

    ``roots`` has the whole (``source_no``, ``depth``, ``words``, ``quota``), with the depth of each source's own tree, at most ``depth``.
    Each level halves the leaves of the trees that reach it and draws the left half's share.
    """
    nodes = roots.where(F.col("quota") > 0).select("source_no", "depth", F.lit(0).cast("long").alias("node"), "words", "quota")
    for level in range(1, depth + 1):
        halves = leaves.where(F.col("depth") >= level).withColumn("half", F.expr(f"shiftright(leaf, depth - {level})"))
        left = halves.where(F.col("half") % 2 == 0).groupBy("source_no", F.shiftright("half", 1).alias("node")).agg(F.sum("words").alias("left"))
        drawn = nodes.join(left, ["source_no", "node"], "left").fillna(0, ["left"])
        drawn = drawn.withColumn("mine", hypergeometric(F.col("words"), F.col("left"), F.col("quota"), F.lit(level), "source_no", "node"))
        children = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("words"), F.col("mine").alias("quota")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("words") - F.col("left")).alias("words"), (F.col("quota") - F.col("mine")).alias("quota")),
        )
        whole = F.array(F.struct("node", "words", "quota"))
        split = F.when(F.col("depth") >= level, children).otherwise(whole)
        nodes = drawn.select("source_no", "depth", F.inline(split)).where(F.col("quota") > 0)
        if level % 4 == 0:
            nodes = staged(nodes, "quotas")
    return nodes.select("source_no", F.col("node").alias("leaf"), "quota")


def fill_leaves(placed: DataFrame) -> DataFrame:
    """``placed`` with ``part``: words of each document within its leaf's ``quota``, in order of ``place``. One per leaf may be partial."""
    turn = Window.partitionBy("source_no", "leaf").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.coalesce("quota", F.lit(0)) - F.coalesce(F.sum("size").over(turn), F.lit(0))
    return placed.withColumn("part", F.greatest(F.lit(0), F.least("size", left)))


def round_leaves(filled: DataFrame) -> DataFrame:
    """(``source_no``, ``leaf``, ``rounded``): words to take of the one partial document of each leaf that `fill_leaves` left with one.

    The parts of a source sum to the same words as before, but go to whole documents in a random order of the leaves, so that at most
    one document per source stays partial and no leaf is favoured. Sums run over spans of `LEAF_SPAN` leaves first: no source is ordered in one task.
    """
    last = filled.where((F.col("part") > 0) & (F.col("part") < F.col("size"))).select(
        "source_no", "leaf", "size", "part", F.shiftright("leaf", LEAF_SPAN.bit_length() - 1).alias("span"))
    last = staged(last, "mix-last")
    by_span = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(SEED), "source_no", "span"), "span")
    spans = last.groupBy("source_no", "span").agg(F.sum("size").alias("span_size"), F.sum("part").alias("span_part"))
    spans = spans.select(
        "source_no", "span", F.sum("span_part").over(Window.partitionBy("source_no")).alias("goal"),
        F.coalesce(F.sum("span_size").over(by_span.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    by_leaf = Window.partitionBy("source_no", "span").orderBy(F.xxhash64(F.lit(SEED), "source_no", "leaf"), "leaf")
    turn = by_leaf.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("size").over(turn), F.lit(0))
    summed = last.join(spans, ["source_no", "span"])
    return summed.select("source_no", "leaf", F.greatest(F.lit(0), F.least("size", F.col("goal") - earlier)).alias("rounded"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken``, ``passes`` (full copies), ``rest`` (words of a last, partial one),
    and ``shard`` and ``place`` to write the mix by.

    The text is dropped unless asked for. Each source's taken words sum to its rounded target exactly; all documents but one of each
    source are taken whole or not at all in the last pass. NULL and empty texts have
    size 0 and are never taken; NULL sources are one source, ordered last; equal rows are told apart by nothing, so which of
    them has the larger share is open, but not how many do. Columns named like a result column are replaced, all others kept as they are. Reruns agree.
    """
    made = ("size", "source_size", "target", "taken", "passes", "rest", "shard", "place", "source_no", "quota", "depth", "leaf", "part", "rounded")
    kept = [c for c in docs.columns if c not in made and (keep_text or c != text)]
    held = [f"_c{i}" for i in range(len(kept))]
    sized = docs.select(
        *[F.col(c).alias(h) for c, h in zip(kept, held)], F.col(source).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), *[F.col(c) for c in dict.fromkeys([*kept, text]) if docs.schema[c].dataType.typeName() != "map"]).alias("place"),
    )
    sized = staged(sized, "mix-sizes")
    by_source = sized.select(F.col("_source").alias("source"), "size")
    counts = by_source.groupBy(F.col("source").alias("_named")).agg(F.count("*").alias("docs"))
    sources = source_targets(by_source, weights).join(counts, F.col("source").eqNullSafe(F.col("_named")))
    sources = staged(sources.withColumn("depth", depth_of(F.col("docs"))), "mix-sources")
    docs_in_all, deepest = sources.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.max("depth"), F.lit(0))).first()
    shards = 1 << max(0, math.ceil(math.log2(max(1, docs_in_all) / LEAF_DOCS)))
    placed = sized.join(sources.drop("source", "docs"), F.col("_source").eqNullSafe(F.col("_named")))
    placed = placed.withColumns({
        "shard": F.pmod("place", F.lit(shards)).cast("long"), "leaf": F.expr("pmod(place, shiftleft(1L, depth))"),
    })
    leaves = staged(placed.groupBy("source_no", "depth", "leaf").agg(F.sum("size").alias("words")), "mix-leaves")
    roots = sources.select("source_no", "depth", F.col("source_size").alias("words"), F.col("rest").alias("quota"))
    quotas = staged(split_quotas(leaves, roots, deepest), "mix-quotas")
    narrow = placed.select("source_no", "leaf", "place", "size").join(quotas, ["source_no", "leaf"])
    rounded = staged(round_leaves(fill_leaves(narrow)), "mix-rounded")
    leaf_rows = quotas.join(rounded, ["source_no", "leaf"], "left")
    drawn = fill_leaves(placed.drop("rest").join(leaf_rows, ["source_no", "leaf"], "left"))
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    drawn = drawn.withColumn("rest", F.when(cut, F.col("rounded")).otherwise(F.col("part")))
    drawn = drawn.withColumn("taken", F.col("passes") * F.col("size") + F.col("rest"))
    return drawn.select(*[F.col(h).alias(c) for c, h in zip(kept, held)], "size", "source_size", "target", "taken", "passes", "rest", "shard", "place")


def mixed_blocks(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: one row per copy of a document or of its first words, with the columns of ``docs``, ``taken`` words,
    ``shard``, and the random ``place`` by which rows of a shard are ordered.

    Columns of ``docs`` with these names are replaced. One document per source may be cut; what is left of it keeps its line ends and spaces.
    """
    docs = docs.drop("taken", "shard", "place")
    held = [f"_c{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, held))
    drawn = mix(docs.toDF(*held), names[text], names[options.pop("source", "source")], keep_text=True, **options)
    body = F.col(names[text])
    first = F.col("rest").cast("int")
    pieces = F.arrays_zip(
        F.slice(F.split(body, WORD, -1), 1, first).alias("gap"), F.slice(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), 1, first).alias("word"))
    cut = F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], p["word"])), "")
    copies = F.when(F.col("passes") > 0, F.sequence(F.lit(1).cast("long"), "passes")).otherwise(F.array().cast("array<bigint>"))
    copies = F.when(F.col("rest") > 0, F.array_append(copies, F.lit(0).cast("long"))).otherwise(copies)
    rows = drawn.where(F.col("taken") > 0).withColumn("_copy", F.explode(copies))
    words = F.when(F.col("_copy") == 0, F.col("rest")).otherwise(F.col("size"))
    place = F.xxhash64("place", "_copy")
    return rows.select(
        *[F.when((F.col("_copy") == 0) & (F.col("rest") < F.col("size")), cut).otherwise(body).alias(t) if t == names[text] else F.col(t) for t in held],
        words.alias("taken"), "shard", place.alias("place"),
    ).toDF(*docs.columns, "taken", "shard", "place")
