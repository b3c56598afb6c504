"""Quality rules: per-document measures, and cross-document line frequency per host."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.words import EXACT_TABLE, SPACED, Texts, Words, longs, map_texts
from vitrine.spark_tools import staged

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A line is boilerplate of its host if more distinct documents hold it than this many and than this share of the host's.
LINE_MIN_DOCS = 10
LINE_MAX_SHARE = 0.01
#: A document is depleted if fewer words than `MIN_WORDS`, or a smaller share than this, are left without boilerplate.
MIN_LEFT_SHARE = 0.2
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1

_LINE = T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.IntegerType())])
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little", signed=True)


def _line_key(spoken: list[bytes]) -> int:
    return _line_hash(b" ".join(spoken).lower())


def _without_lines(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the lines whose key is in ``_lost`` taken out of the text; all others stay as they are."""

    def strip(body: bytes, lost: set[int]) -> bytes:
        return b"\n".join(x for x in body.split(b"\n") if not (spoken := x.split()) or _line_key(spoken) not in lost)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            bodies, lost = batch.column(at).cast(pa.large_binary()).to_pylist(), batch.column("_lost").to_pylist()
            made = pa.array([strip(b, set(k)) if b and k else b for b, k in zip(bodies, lost)], pa.large_binary())
            yield batch.set_column(at, batch.schema.field(at), made.cast(pa.large_string()).cast(batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _measure(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
    words = Words(texts, lo, hi, SPACED, EXACT_TABLE)
    origin, bounds = texts.bounds[lo], texts.bounds[lo : hi + 1] - texts.bounds[lo]
    part = texts.data[origin : texts.bounds[hi]]
    points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[part])))
    grams, at = words.grams(WINDOW)
    order = np.lexsort((grams, words.rows[at]))
    same = (np.diff(grams[order]) == 0) & (np.diff(words.rows[at[order]]) == 0)
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    repeated = at[order[twice]]
    edges[repeated] += 1
    np.subtract.at(edges, repeated + WINDOW, 1)
    keys, dups, lines = [], [], []
    for row in range(lo, hi):
        body = texts.row(row)
        keys.append(hashlib.blake2b(body, digest_size=16).digest())
        seen, dup, held = set(), 0, {}
        for line in body.split(b"\n"):
            spoken = line.split()
            if not spoken:
                continue
            dup += line in seen
            seen.add(line)
            key = _line_key(spoken)
            held[key] = held.get(key, 0) + len(spoken)
        dups.append(dup)
        lines.append([{"line": k, "words": n} for k, n in held.items()])
    return [
        longs(words.counts), longs(words.sums(points[words.ends - origin] - points[words.starts - origin])),
        longs(np.diff(symbols[bounds])), longs(dups), longs(words.sums(np.cumsum(edges[:-1]) > 0)),
        pa.array(keys, pa.binary()), pa.array(lines, pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))),
    ]


def judge_quality(
    docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = LINE_MIN_DOCS, max_share: float = LINE_MAX_SHARE,
    min_left: float = MIN_LEFT_SHARE, clean_text: bool = False,
) -> DataFrame:
    """``docs`` without its text, or on request (``clean_text``) with it less its common lines; with the measures, ``base_failed``, ``n_boilerplate`` (words in common lines) and ``kept``.

    Lines are compared lower-cased (A-Z) with runs of whitespace as one space. A line counts once per distinct text, so copies of a
    document do not make its lines common. NULL hosts form one host; NULL and empty texts have no words and fail;
    repeated rows each get their row; columns named like a result column are replaced.
    """
    out = [T.StructField(m, T.LongType()) for m in MEASURES]
    out += [T.StructField("_key", T.BinaryType()), T.StructField("_lines", T.ArrayType(_LINE))]
    docs = docs.drop(*MEASURES, "_key", "_lines", "_lost", "_host", "base_failed", "n_boilerplate", "kept")
    docs = docs.withColumn("_host", F.xxhash64(F.col(host).isNull(), F.coalesce(F.col(host).cast("string"), F.lit(""))))
    measured = staged(map_texts(docs, text, out, _measure, keep_text=clean_text), "quality")
    lines = measured.select("_host", "_key", F.inline("_lines")).distinct()
    sizes = measured.select("_host", "_key").distinct().groupBy("_host").agg(F.count("*").alias("host_docs"))
    common = (
        lines.groupBy("_host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
        .join(sizes, "_host").where(F.col("docs") > F.col("host_docs") * max_share).select("_host", "line")
    )
    sums = [F.sum("words").alias("n_boilerplate"), *[F.collect_list("line").alias("_lost")] * clean_text]
    lost = lines.join(common, ["_host", "line"], "left_semi").groupBy("_host", "_key").agg(*sums)
    judged = measured.drop("_lines").join(lost, ["_host", "_key"], "left").fillna(0, ["n_boilerplate"])
    if clean_text:
        judged = _without_lines(judged, text).drop("_lost")
    left = F.col("n_words") - F.col("n_boilerplate")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return judged.withColumns({
        "base_failed": failed, "kept": ~failed & (left >= MIN_WORDS) & (left >= F.col("n_words") * min_left),
    }).drop("_host", "_key")
