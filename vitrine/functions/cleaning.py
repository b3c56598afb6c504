"""The cleaning pipeline: ordered stages over text columns of a DataFrame.

A stage is built from small column steps, applied one ``withColumn`` at a time. Catalyst merges
neighbouring projections but does not copy an expensive input into a step that reads it twice, so
each regular expression runs once per text, and cheap ``contains`` tests skip the ones not needed.

Stages that do not depend on the verbosity run once per text; from the first one that does, they run
per output format (see ``shared_stages`` / ``format_stages``).
"""

from __future__ import annotations

import functools
import json
import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import markup
from vitrine.functions.text import collapse_ascii, collapse_ws, cut_spaces, text, trim_column, trim_text, truncate_words

log = logging.getLogger(__name__)

Step = Callable[[Column], Column]

# fixed values: tags that read as a space
_BLOCK_TAG = (
    r"(?i)</?(?:p|div|span|br|li|ul|ol|h[1-6]|blockquote|section|article|header|footer|tr|td|th)[^>]*>"
)
# fixed values: elements dropped with their bodies, and the ends of paragraphs
_STYLE = r"(?is)<style[^>]*>.*?</style>"
_SCRIPT = r"(?is)<script[^>]*>.*?</script>"
_PARAGRAPH_END = r"(?i)</(?:p|div|li|h[1-6]|blockquote|section|article|tr)\s*>|<br\s*/?>"

# A tag is '<' and no space, up to '>' outside quotes; the end of text closes all.
_INSIDE = r"""[^<>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|<(?=[ \t\n\x0B\f\r])"""
_OPEN = r"<(?![ \t\n\x0B\f\r])"


def _tag(levels: int) -> str:
    """A tag that may hold further ones, ``levels`` deep; possessive throughout, so it is read once."""
    inside = _INSIDE if levels == 0 else f"{_INSIDE}|{_tag(levels - 1)}"
    return rf"{_OPEN}(?:{inside})*+(?:>|\z)"


# Deeper nesting is read token by token.
_LEVELS = 24
_STRIP = rf"(?s)<!(?=--).*?(?:-->|\z)|<\?.*?(?:\?>|\z)|{_tag(_LEVELS)}"
_CHUNK = 256
_MARKS = r"""(?s)<!-->|<!--|-->|<\?|\?>|<[ \t\n\x0B\f\r]|[<>"']|[^<>"'?-]+|."""


def _strip_nested(col: Column) -> Column:
    """What lies outside tags, comments and processing instructions; tags may nest.

    One pass over the tokens. What is kept goes to a short chunk, and full chunks to a list, so that no step copies all of it.
    """
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("quote"), F.lit("").alias("until"), none.alias("chunk"), none.alias("chunks"))

    def read(acc: Column, t: Column) -> Column:
        depth, quote, until = acc["depth"], acc["quote"], acc["until"]
        plain, top = (until == "") & (quote == ""), depth == 0
        opens, closes = t.isin("<", "<!--", "<?"), t.isin(">", "-->", "?>")
        whole = plain & top & t.isin("<!--", "<?")
        deeper = F.when(plain & opens & ~whole, depth + 1).when(plain & closes & ~top, depth - 1).otherwise(depth)
        quoted = F.when((until != "") | top, "").when(quote != "", F.when(t == quote, "").otherwise(quote)).when(t.isin('"', "'"), t).otherwise("")
        ends = F.when(until != "", F.when(t == until, "").otherwise(until)).when(whole, F.when(t == "<?", "?>").otherwise("-->")).otherwise("")
        shown = plain & top & ~opens & (t != "<!-->")
        full = F.size(acc["chunk"]) >= _CHUNK
        chunk = F.when(~shown, acc["chunk"]).when(full, F.array(t)).otherwise(F.array_append(acc["chunk"], t))
        chunks = F.when(shown & full, F.array_append(acc["chunks"], F.array_join(acc["chunk"], ""))).otherwise(acc["chunks"])
        return F.struct(deeper.alias("depth"), quoted.alias("quote"), ends.alias("until"), chunk.alias("chunk"), chunks.alias("chunks"))

    return F.aggregate(
        F.regexp_extract_all(col, F.lit(_MARKS), F.lit(0)), start, read,
        lambda acc: F.concat(F.array_join(acc["chunks"], ""), F.array_join(acc["chunk"], "")),
    )


def _strip_tags(col: Column) -> Column:
    """Text outside tags. A tag too deep for the pattern leaves its '<' there, and only then the text is read token by token."""
    read = F.transform(F.array(F.regexp_replace(col, _STRIP, "")), lambda out: F.when(out.contains("<") & out.rlike(_OPEN), _strip_nested(col)).otherwise(out))
    return F.when(col.contains("<"), F.element_at(read, 1)).otherwise(col)


def _if_contains(needles: Sequence[str], *patterns: tuple[str, str]) -> Step:
    """Apply the replacements in order, to texts that hold one of the needles."""

    def step(col: Column) -> Column:
        present = col.contains(needles[0])
        for needle in needles[1:]:
            present = present | col.contains(needle)
        changed = col
        for pattern, by in patterns:
            changed = F.regexp_replace(changed, pattern, by)
        return F.when(present, changed).otherwise(col)

    return step


# The names of the HTML standard, as Python's library has them.
_ENTITY = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# One string, so that a plan holds one constant and not thousands; names by their first letter, as a map is searched entry by entry.
_NAMED = json.dumps({
    letter: {f"&{name}": char for name, char in html5.items() if name.endswith(";") and name[0] == letter}
    for letter in sorted({name[0] for name in html5})
})
# Tried first.
_FREQUENT = ("amp", "nbsp", "lt", "gt", "quot", "copy", "middot", "trade", "ndash", "mdash", "rsquo", "hellip")


def _allowed_point(code: Column) -> Column:
    """Code points that a numeric entity may stand for."""
    low = (code >= 0x20) | code.isin(0x09, 0x0A, 0x0C)
    high = (code >= 0xA0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF) & ~code.between(0xFDD0, 0xFDEF)
    return F.when(code < 0x7F, low).otherwise(high & (code.bitwiseAND(0xFFFE) != 0xFFFE))


def _entity(token: Column) -> Column:
    """What an entity stands for, else itself."""
    hexadecimal = F.regexp_extract(token, "^&#[xX]0*([0-9A-Fa-f]{1,8});$", 1)
    decimal = F.regexp_extract(token, "^&#0*([0-9]{1,8});$", 1)
    code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).cast("long")
    char = F.when(_allowed_point(code), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    letter = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,map<string,string>>"), F.substring(token, 2, 1))
    named = F.when(token.startswith("&#"), char)
    for name in _FREQUENT:
        named = named.when(token == f"&{name};", html5[f"{name};"])
    return F.coalesce(named.otherwise(F.try_element_at(letter, token)), token)


def _decode(col: Column) -> Column:
    """One pass over entities that end in ';'; what a replacement spells is not decoded again."""
    gaps, found = F.split(col, _ENTITY, -1), F.transform(F.regexp_extract_all(col, F.lit(_ENTITY), F.lit(0)), _entity)
    woven = F.array_join(F.zip_with(gaps, found, lambda gap, char: F.concat(gap, F.coalesce(char, F.lit("")))), "")
    return F.when(col.contains("&") & col.rlike(_ENTITY), woven).otherwise(col)


# fixed values: leftovers of the page editor
def _tidy(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("#html-body"), F.lit("")), F.lit("&nbsp;"), F.lit(" "))


def html_steps(mode: str = "code") -> list[Step]:
    """HTML to text.

    ``mode='code'`` is what the exports use: script bodies stay as text and line ends become spaces.
    ``mode='intent'`` drops script bodies, ends paragraphs with a newline and makes no-break spaces plain.
    """
    def tidy(col: Column) -> Column:
        return F.when(col.contains("#html-body") | col.contains("&nbsp;"), _tidy(col)).otherwise(col)

    brackets = _if_contains(["{{", "["], (r"(?s)\{\{.*?\}\}", " "), (r"(?s)\[.*?\]", " "))
    if mode == "code":
        styles, tags = _if_contains(["<s", "<S"], (_STYLE, " ")), _if_contains(["<"], (_BLOCK_TAG, " "))
        return [_decode, styles, tags, _strip_tags, brackets, tidy, collapse_ascii, cut_spaces, trim_column]
    tags = _if_contains(
        ["<"], (_STYLE, " "), (_SCRIPT, " "), (_PARAGRAPH_END, "\n"), (_BLOCK_TAG, " ")
    )

    def lines(col: Column) -> Column:
        blanks = F.regexp_replace(_tidy(col), r"[\h\x0B\f\r]+", " ")
        return trim_text(F.regexp_replace(blanks, r" ?\n ?", "\n"))

    return [_decode, tags, _strip_tags, brackets, lines]


def prune_step(rule: Column | str) -> Step:
    """Drop marked elements; only texts that carry the marker under a dropping rule reach Python.

    A rule known to keep all is no step: the optimizer copies whatever a Python function reads into the call.
    """
    if isinstance(rule, str):
        if rule.partition("|")[0] in ("preserve", ""):
            return lambda col: col
        rule = F.lit(rule)

    def step(col: Column) -> Column:
        needed = col.contains(markup.MARKER) & ~F.substring_index(rule, "|", 1).isin("preserve", "")
        return F.coalesce(markup.prune(F.when(needed, col), rule), col)

    return step


@dataclass(frozen=True)
class Stage:
    """A named cleaning stage: ``build(rule, verbosity)`` gives its column steps."""

    order: int
    name: str
    build: Callable[[Column | str, Column], Sequence[Step]]
    per_format: bool = False


DEFAULT_STAGES = (
    Stage(20, "elements", lambda rule, verbosity: [prune_step(rule)]),
    Stage(30, "html", lambda rule, verbosity: html_steps()),
    Stage(40, "whitespace", lambda rule, verbosity: [lambda c: collapse_ws(c, verbosity), cut_spaces, trim_column], per_format=True),
)


@dataclass(frozen=True)
class Skip:
    """Entities, by id, whose texts a stage passes on as they are."""

    stage: str
    low: int
    high: int


class Cleaner:
    """Default stages plus registered ones, kept in order."""

    def __init__(self, stages: Sequence[Stage] = DEFAULT_STAGES, skips: Sequence[Skip] = (), skip_tables: Sequence[DataFrame] = ()):
        self.stages = sorted(stages, key=lambda s: s.order)
        self.skips, self.skip_tables = tuple(skips), tuple(skip_tables)

    def skipping(self, skips: Iterable[Skip]) -> "Cleaner":
        """A new cleaner that also skips stages for some entities; its rows then need an ``entity_id``."""
        return Cleaner(self.stages, [*self.skips, *skips], self.skip_tables)

    def skipping_rows(self, table: DataFrame) -> "Cleaner":
        """The same for a table (``entity_id``, ``stage``) of any size; its rows then need to come through ``with_skips`` first."""
        return Cleaner(self.stages, self.skips, [*self.skip_tables, table])

    def with_skips(self, df: DataFrame) -> DataFrame:
        """``df`` with the stages that each entity skips by a table."""
        if not self.skip_tables:
            return df
        pairs = functools.reduce(DataFrame.unionByName, self.skip_tables)
        return df.join(pairs.groupBy("entity_id").agg(F.collect_set("stage").alias("_skips")), "entity_id", "left")

    def register_stage(self, name: str, fn: Step, order: int, per_format: bool = False) -> "Cleaner":
        """A new cleaner with ``fn`` as one more stage. A stage whose building fails is logged and skipped."""
        return Cleaner([*self.stages, Stage(order, name, lambda rule, verbosity: [fn], per_format)], self.skips, self.skip_tables)

    def _split(self) -> int:
        return next((i for i, s in enumerate(self.stages) if s.per_format), len(self.stages))

    @property
    def shared_stages(self) -> list[Stage]:
        return self.stages[: self._split()]

    @property
    def format_stages(self) -> list[Stage]:
        return self.stages[self._split():]

    def shared(self, df: DataFrame, columns: Sequence[str], rule: Column | str) -> DataFrame:
        return self._apply(df, columns, self.shared_stages, rule, F.lit("full"))

    def per_format(self, df: DataFrame, columns: Sequence[str], rule: Column | str, verbosity: Column) -> DataFrame:
        return self._apply(df, columns, self.format_stages, rule, verbosity)

    def _skipped(self, stage: Stage) -> Column | None:
        own = [s for s in self.skips if s.stage == stage.name]
        ranges = [F.col("entity_id").between(s.low, s.high) for s in own if s.low < s.high]
        single = sorted({s.low for s in own if s.low == s.high})
        ranges += [F.col("entity_id").isin(single)] if single else []
        ranges += [F.coalesce(F.array_contains("_skips", stage.name), F.lit(False))] if self.skip_tables else []
        return functools.reduce(Column.__or__, ranges) if ranges else None

    def _apply(self, df, columns, stages, rule, verbosity) -> DataFrame:
        for stage in stages:
            try:
                staged, skipped = df, self._skipped(stage)
                for step in stage.build(rule, verbosity):
                    done = {c: step(F.col(c)) for c in columns}
                    if skipped is not None:
                        done = {c: F.when(skipped, F.col(c)).otherwise(v) for c, v in done.items()}
                    staged = staged.withColumns(done)
                df = staged
            except Exception as error:
                log.warning("cleaning stage %s skipped: %s", stage.name, error)
        return df


class Probe(Cleaner):
    """A cleaner whose stages pass their input on where they raise, and that tells where.

    Errors of built-in functions are found, those of Python functions end the job.
    """

    def __init__(self, cleaner: Cleaner):
        super().__init__(cleaner.stages, cleaner.skips, cleaner.skip_tables)
        self.cleaned: list[DataFrame] = []

    def failing(self) -> DataFrame:
        """(``entity_id``, ``stage``) of the stages that raise on the rows that went through."""
        rows = functools.reduce(DataFrame.unionByName, self.cleaned)
        rows = rows.select(F.col("entity_id").cast("long").alias("entity_id"), F.explode("_failing").alias("stage"))
        return rows.where(F.col("entity_id").isNotNull()).distinct()

    def shared(self, df: DataFrame, columns: Sequence[str], rule: Column | str) -> DataFrame:
        return super().shared(df.withColumn("_failing", F.array().cast("array<string>")), columns, rule)

    def per_format(self, df: DataFrame, columns: Sequence[str], rule: Column | str, verbosity: Column) -> DataFrame:
        df = super().per_format(df, columns, rule, verbosity)
        self.cleaned.append(df.select("entity_id", "_failing"))
        return df

    def _apply(self, df, columns, stages, rule, verbosity) -> DataFrame:
        for stage in stages:
            try:
                steps = list(stage.build(rule, verbosity))
                try:
                    tried = self._tried(df, columns, [_in_turn(steps)])
                except AnalysisException:
                    # Python functions have no place inside of others.
                    tried = self._tried(df, columns, steps)
            except Exception as error:
                log.warning("cleaning stage %s skipped: %s", stage.name, error)
                continue
            skipped = self._skipped(stage)
            passes = F.col("_failed") if skipped is None else F.col("_failed") | skipped
            failed = F.col("_failed") if skipped is None else F.col("_failed") & ~skipped
            done = {c: F.when(passes, F.col(c)).otherwise(F.col(f"_tried_{c}")) for c in columns}
            done["_failing"] = F.when(failed, F.array_append("_failing", F.lit(stage.name))).otherwise(F.col("_failing"))
            df = tried.withColumns(done).drop("_failed", *(f"_tried_{c}" for c in columns))
        return df

    def _tried(self, df: DataFrame, columns: Sequence[str], steps: Sequence[Step]) -> DataFrame:
        names = {c: f"_tried_{c}" for c in columns}
        tried = df.withColumns({n: F.col(c) for c, n in names.items()} | {"_failed": F.lit(False)})
        for step in steps:
            # NULL where the step raises; a mark in front tells a text from one that the step makes NULL.
            marked = {n: F.concat(F.lit("+"), step(F.col(n))) for n in names.values()}
            tried = tried.withColumns({n: F.try_to_binary(F.coalesce(m, F.lit("-")), F.lit("utf-8")) for n, m in marked.items()})
            bad = functools.reduce(Column.__or__, (F.col(n).isNull() for n in names.values()))
            read = {n: F.col(n).cast("string") for n in names.values()}
            tried = tried.withColumns({n: F.when(v.startswith("+"), v.substr(F.lit(2), F.length(v))) for n, v in read.items()} | {"_failed": F.col("_failed") | bad})
        return tried


def _in_turn(steps: Sequence[Step]) -> Step:
    """The steps as one expression; each reads its input as a variable, so that no step is copied into the next."""
    def whole(col: Column) -> Column:
        for number, step in enumerate(steps):
            col = step(col) if number == 0 else F.element_at(F.transform(F.array(col), step), 1)
        return col

    return whole


def clean_text(
    df: DataFrame,
    column: str,
    verbosity: str = "full",
    max_len: int | None = None,
    rule: Column | str = "preserve|",
    cleaner: Cleaner | None = None,
) -> DataFrame:
    """``df`` with ``column`` cleaned by every stage, then cut to ``max_len`` code points."""
    cleaner = cleaner or Cleaner()
    df = df.withColumn(column, text(F.col(column)))
    df = cleaner.shared(df, [column], rule)
    df = cleaner.per_format(df, [column], rule, F.lit(verbosity))
    return df.withColumn(column, truncate_words(F.col(column), max_len)) if max_len else df
