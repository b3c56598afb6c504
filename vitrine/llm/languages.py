"""Language ID: script ranges narrow the candidates, Viterbi with a switching penalty labels spans of mixed-language text."""

from __future__ import annotations

import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.words import EXACT_TABLE, FOLDED_TABLE, LETTERS, Texts, Words, longs, map_texts, small_batches

UNKNOWN = "und"
#: Counters of byte trigrams per language: a fixed number, so the model grows with the languages only.
BUCKETS = 1 << 16
#: Most languages a model may learn (it is broadcast: 256 KB each); more raise an error.
MAX_LANGUAGES = 400
SMOOTHING = 0.5
#: A language is a candidate for a word in a script that makes up at least this share of its letters.
MIN_SCRIPT_SHARE = 0.01
#: Share of its letters that a text's language must have for `keep_identified`.
MIN_SHARE = 0.3
#: A text fits its language if its mean log-probability per trigram is at most this many standard deviations below the mean of the
#: labelled texts of its size (in powers of two) in that language; classes of fewer rows take the language's own mean. Floor of a deviation.
MAX_DEVIATION = 6.0
MIN_CLASS_ROWS = 30
MIN_DEVIATION = 0.1
#: Most that one word can count against a language, and the price of changing the language between two words.
WORD_CAP = 6.0
SWITCH = 15.0

#: Ranges of code points and their script, in blocks of 64 (beyond U+FFFF of 4,096); ASCII letters are Latin, all letters outside the
#: ranges are one more script.
SCRIPT_RANGES = (
    (0x00C0, 0x024F, "latin"), (0x1E00, 0x1EFF, "latin"), (0x0370, 0x03FF, "greek"), (0x1F00, 0x1FFF, "greek"), (0x0400, 0x052F, "cyrillic"),
    (0x0540, 0x057F, "armenian"), (0x05C0, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"), (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B00, 0x0B7F, "odia"), (0x0B80, 0x0BFF, "tamil"), (0x0C00, 0x0C7F, "telugu"), (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"),
    (0x0D80, 0x0DFF, "sinhala"), (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"), (0x0F00, 0x0FFF, "tibetan"), (0x1000, 0x107F, "myanmar"),
    (0x0700, 0x073F, "syriac"), (0x0780, 0x07BF, "thaana"), (0x07C0, 0x07FF, "nko"), (0x1400, 0x167F, "syllabics"), (0x1800, 0x18BF, "mongolian"),
    (0x2D40, 0x2D7F, "tifinagh"), (0xA000, 0xA4BF, "yi"), (0xA980, 0xA9FF, "javanese"), (0x20000, 0x3FFFF, "han"), (0x10C0, 0x10FF, "georgian"),
    (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"), (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7BF, "hangul"),
)
SCRIPTS = ("", "latin", *dict.fromkeys(name for _, _, name in SCRIPT_RANGES if name != "latin"))
_WORD = LETTERS.copy()
_WORD[48:58] = False


def _script_table() -> np.ndarray:
    """Script number by the first two bytes of a character."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for first in [*range(65, 91), *range(97, 123)]:
        table[first << 8 : (first + 1) << 8] = 1
    for low, high, name in SCRIPT_RANGES:
        for point in range(low - low % 64, high + 1, 64):
            lead = chr(point).encode()
            if len(lead) == 2:
                table[(lead[0] << 8) + 0x80 : (lead[0] << 8) + 0xC0] = SCRIPTS.index(name)
            else:
                table[(lead[0] << 8) + lead[1]] = SCRIPTS.index(name)
    return table


_SCRIPT_OF = _script_table()


class Features:
    """Words of a block with, per byte, the bucket of the trigram around it (word ends count as a mark), and a script per word."""

    def __init__(self, texts: Texts, lo: int, hi: int) -> None:
        self.words = words = Words(texts, lo, hi, _WORD, EXACT_TABLE)
        self.origin = int(texts.bounds[lo])
        part = texts.data[self.origin : texts.bounds[hi]]
        marks = np.where(_WORD[part], FOLDED_TABLE[part], np.uint64(0))
        ahead, behind = np.zeros_like(marks), np.zeros_like(marks)
        ahead[:-1], behind[1:] = marks[1:], marks[:-1]
        edges = texts.bounds[lo : hi + 1] - self.origin
        behind[edges[edges < len(part)]] = 0
        ahead[edges[edges > 0] - 1] = 0
        mixed = behind * np.uint64(3) + marks * np.uint64(0x9E3779B97F4A7C15) + ahead * np.uint64(0xC2B2AE3D27D4EB4F)
        self.codes = (mixed >> np.uint64(48)).astype(np.int64)
        self.starts, self.ends = words.starts - self.origin, words.ends - self.origin
        pairs = part.astype(np.int64) << 8
        pairs[:-1] |= part[1:]
        scripts = _SCRIPT_OF[pairs]
        # A word's stretch runs to the next word's start; what lies between is no letter.
        self.scripts = np.maximum.reduceat(scripts, self.starts).astype(np.int64) if len(words) else np.zeros(0, dtype=np.int64)
        self.sizes = self.ends - self.starts
        # Bytes of letters: words of no listed script may be dashes or quotes.
        self.letters = self.sizes.copy()
        for k in np.flatnonzero(self.scripts == 0).tolist():
            self.letters[k] = letter_bytes(part[self.starts[k] : self.ends[k]].tobytes().decode(errors="ignore"))

    def per_word(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(values)))
        return sums[self.ends] - sums[self.starts]


def letter_bytes(word: str) -> int:
    """Bytes of the letters and their marks."""
    return sum(len(c.encode()) for c in word if c.isalpha() or unicodedata.category(c)[0] == "M")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Model from all rows with a text and a language: languages, log-probabilities of trigrams, allowed scripts, row counts."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def run(batches):
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + len(SCRIPTS) + 1, dtype=np.int64))
        for batch in batches:
            texts, langs = Texts(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=object)
            for lo, hi in texts.blocks():
                found = Features(texts, lo, hi)
                named = langs[lo:hi]
                # Index of every byte of every word, and the row it lies in.
                skipped = found.starts - np.concatenate(([0], np.cumsum(found.sizes)[:-1]))[: len(found.sizes)]
                inside = np.repeat(skipped, found.sizes) + np.arange(int(found.sizes.sum()))
                byte_rows = np.repeat(found.words.rows, found.sizes)
                for name in set(named.tolist()):
                    own = named == name
                    held = counts[name]
                    held[:BUCKETS] += np.bincount(found.codes[inside[own[byte_rows]]], minlength=BUCKETS)
                    mine = own[found.words.rows]
                    held[BUCKETS:-1] += np.bincount(found.scripts[mine], weights=found.letters[mine], minlength=len(SCRIPTS)).astype(np.int64)
                    held[-1] += int(own.sum())
        for name, held in counts.items():
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), longs(some), longs(held[some])], names=["lang", "bucket", "n"])

    small_batches(rows.sparkSession)
    summed = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(langs), BUCKETS + len(SCRIPTS) + 1))
    table = summed.toArrow()
    place = {name: i for i, name in enumerate(langs)}
    if langs:
        counts[[place[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:-1]
    chance = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)).astype(np.float32)
    allowed = scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return {"langs": langs, "chance": chance, "allowed": allowed.T, "rows": counts[:, -1]}


def word_scores(found: Features, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each word in each language, at most 0 and at least -`WORD_CAP`; words that have a candidate at all; log-probabilities)."""
    scores = np.stack([found.per_word(chance[found.codes]) for chance in model["chance"]], axis=1)
    allowed = model["allowed"][found.scripts]
    judged = allowed.any(axis=1) & (found.letters > 0)
    logs = scores.copy()
    scores[~allowed] = -np.inf
    scores[~judged] = 0.0
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, -WORD_CAP), judged, logs


def label_words(scores: np.ndarray) -> np.ndarray:
    """Best language of each word when each change of language between two words costs `SWITCH`."""
    best = int(scores.sum(axis=0).argmax())
    gains = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gains[:-1]]), axis=0)
    # If k >= 2 stretches in other languages each gain at most half the price, they gain no more than their k - 1 changes cost; a
    # single one that is the whole text gains nothing, and any other pays for a change: one language is the best path.
    if (gains - lowest).max() <= SWITCH / 2:
        return np.full(len(scores), best)
    states = range(scores.shape[1])
    now, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        top = max(now)
        lead, floor = now.index(top), top - SWITCH
        back.append([s if now[s] >= floor else lead for s in states])
        now = [(v if v >= floor else floor) + row[s] for s, v in enumerate(now)]
    at = now.index(max(now))
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1])


def identify(docs: DataFrame, model: dict, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of the bytes of all letters in that language), ``lang_spans`` (language, first word,
    end), and ``fit`` (mean log-probability per trigram of its words in that language) over ``n_fit`` trigrams, the text only if asked.

    Words are runs of letters. NULL texts and texts without a letter give ``und`` and 0, as do all with a model that learned nothing;
    texts without a word in a script of any learned language get the language with the most rows, and 0. Ties go to the first language
    by name. Repeated rows each get their row; columns named like a result column are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        model = held.value
        langs = model["langs"]
        names, shares, spans, fits, grams = [], [], [], [], []
        found = Features(texts, lo, hi)
        scores, judged, logs = word_scores(found, model) if langs else (None, None, None)
        for row in range(hi - lo):
            a, b = int(found.words.first[row]), int(found.words.first[row + 1])
            if not langs or a == b or not _has_letter(texts, lo + row, found.scripts[a:b]):
                names.append(UNKNOWN), shares.append(0.0), spans.append([]), fits.append(None), grams.append(0)
                continue
            sizes = found.letters[a:b] * judged[a:b]
            if not sizes.any():
                names.append(langs[int(model["rows"].argmax())]), shares.append(0.0), spans.append([]), fits.append(None), grams.append(0)
                continue
            labels = label_words(scores[a:b])
            total = np.bincount(labels, weights=sizes, minlength=len(langs))
            lang = int(total.argmax())
            names.append(langs[lang])
            shares.append(float(total.max() / found.letters[a:b].sum()))
            own = judged[a:b] & (labels == lang)
            grams.append(int(found.sizes[a:b][own].sum()))
            fits.append(float(logs[a:b, lang][own].sum() / max(grams[-1], 1)))
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), b - a]
            spans.append([{"lang": langs[labels[x]], "start": x, "end": y} for x, y in zip(cuts, cuts[1:])])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return [
            pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, kind), pa.array(fits, pa.float64()), longs(grams),
        ]

    out = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", T.ArrayType(span))]
    out += [T.StructField("fit", T.DoubleType()), T.StructField("n_fit", T.LongType())]
    return map_texts(docs.drop(*[f.name for f in out]), text, out, make, keep_text)


def _has_letter(texts: Texts, row: int, scripts: np.ndarray) -> bool:
    return bool((scripts == 1).any()) or any(c.isalpha() for c in texts.row(row).decode(errors="ignore"))


def fold(doc_id: Column) -> Column:
    """Fold 0 to 3 of a document; fold 2 is held out of training. NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % 4


def keep_identified(docs: DataFrame, min_score: float = MIN_SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without those that no learned language fits: no letters, less than ``min_score`` of all letters in its language, or a
    mean log-probability far below that of the labelled texts of this language and size; see `MAX_DEVIATION`.

    Languages without a rightly predicted labelled text judge no fit.
    """
    held = [f"_c{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, held))
    rows = docs.toDF(*held)
    model = train(rows, names[text], names[lang])
    own = identify(rows.select(names[lang], names[text]), model, names[text]).where(F.col(names[lang]) == F.col("lang_pred"))
    found = identify(rows, model, names[text], keep_text=True).withColumn("_class", _size_class())
    # At most 64 rows per language.
    found = found.join(F.broadcast(fit_limits(own)), ["lang_pred", "_class"], "left")
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score) & (F.col("lowest").isNull() | (F.col("fit") >= F.col("lowest")))
    return found.where(kept).select(*held).toDF(*docs.columns)


def _size_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_fit"), F.lit(1)))).cast("int")


def fit_limits(own: DataFrame) -> DataFrame:
    """Lowest ``fit`` by (``lang_pred``, ``_class`` of size) from identified texts that are labelled in their language."""
    def lowest(mean, spread):
        return F.col(mean) - MAX_DEVIATION * F.greatest(F.coalesce(spread, F.lit(0.0)), F.lit(MIN_DEVIATION))

    by_class = own.groupBy("lang_pred", _size_class().alias("_class")).agg(
        F.count("fit").alias("n"), F.avg("fit").alias("mean"), F.stddev("fit").alias("spread"))
    whole = own.groupBy("lang_pred").agg(F.avg("fit").alias("mean_all"), F.stddev("fit").alias("spread_all"))
    every = whole.withColumn("_class", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return every.join(by_class, ["lang_pred", "_class"], "left").select(
        "lang_pred", "_class",
        F.when(F.col("n") >= MIN_CLASS_ROWS, lowest("mean", F.col("spread"))).otherwise(lowest("mean_all", F.col("spread_all"))).alias("lowest"),
    )
