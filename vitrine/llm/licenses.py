"""License scans: template markup compiled to token automata, run over the words of whole texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.words import FOLDED_TABLE, LETTERS, Texts, Words, longs, map_texts

#: Phrases and labels of the contract.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, template). ``<<beginOptional>>…<<endOptional>>`` may be left out, ``<<var>>`` stands for any words, ``<<var n>>`` for n at most.
TEMPLATES = (
    ("cc-by-nc-4.0", "<<beginOptional>>This <<var 24>> is <<endOptional>>licensed under <<beginOptional>>a <<endOptional>>"
                     "<<beginOptional>>Creative Commons <<endOptional>>CC BY NC 4.0<<beginOptional>> International<<endOptional>>"),
    ("gpl-3.0", "<<beginOptional>>This <<var 24>> is <<endOptional>>licensed under the <<beginOptional>>terms of the <<endOptional>>"
                "GNU General Public License<<beginOptional>> GPL<<endOptional>> version 3<<beginOptional>> or any later version<<endOptional>>"),
    ("apache-2.0", "Licensed under the Apache License Version 2.0<<beginOptional>> the License <<beginOptional>>you may not use this file "
                   "except in compliance with the License<<endOptional>><<endOptional>>"),
    ("mit", "Released under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this <<var>> to deal in the <<var>> "
            "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted<<beginOptional>> "
            "provided that the following conditions are met<<endOptional>>"),
    ("copyright", "Copyright <<var>> All rights reserved"),
)
_MARK = re.compile(r"<<(beginOptional|endOptional|var)\s*(\d*)>>")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ANY = None


def fold(text: str) -> str:
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), text)


class Automaton:
    """States 0..n with word moves and free moves; state n accepts. States of an unbounded region loop on any word."""

    def __init__(self, template: str) -> None:
        self.moves: list[list[tuple[str | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.loops: set[int] = set()
        opened: list[int] = []
        for piece in re.split(r"(<<[^>]*>>)", template):
            mark = _MARK.fullmatch(piece)
            if mark and mark[1] == "beginOptional":
                opened.append(self._last)
            elif mark and mark[1] == "endOptional":
                self.free[opened.pop()].append(self._last)
            elif mark and mark[2]:
                at = self._last
                for _ in range(int(mark[2])):
                    self._add(_ANY)
                for state in range(at, self._last):
                    self.free[state].append(self._last)
            elif mark:
                # A state of its own, so that an optional region that begins here can still be skipped as a whole.
                self.free[-1].append(len(self.moves))
                self.moves.append([(_ANY, len(self.moves))])
                self.free.append([])
                self.loops.add(self._last)
            else:
                for word in _WORD.findall(fold(piece)):
                    self._add(word)
        if opened:
            raise ValueError(f"unclosed optional region in {template!r}")

    @property
    def _last(self) -> int:
        return len(self.moves) - 1

    def _add(self, word: str | None) -> None:
        self.moves[-1].append((word, len(self.moves)))
        self.moves.append([])
        self.free.append([])

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return seen

    def first_words(self) -> set[str]:
        words = {word for state in self.closure({0}) for word, _ in self.moves[state]}
        if _ANY in words or self._last in self.closure({0}):
            raise ValueError("a template needs a fixed first word")
        return words

    def match(self, word_at, start: int, end: int, seen: dict) -> int:
        """End of the match of words start..end, or -1: the first end, moved on by fixed words of optional regions that follow it.

        ``seen`` keeps, per row, what a run that only waited in its unbounded regions came to: later starts that wait in the same
        ones reach the same end, so that each stretch of a row is read once per template however often its first word occurs.
        """
        states, best, k = self.closure({0}), -1, start
        waits: list[tuple[frozenset, int, int]] = []
        while k < end and states:
            waiting = states & self.loops
            if best < 0 and waiting and states == self.closure(waiting):
                key = frozenset(waiting)
                known = seen.get(key)
                if known and known[0] <= k <= known[1]:
                    best = known[2]
                    break
                if waits and waits[-1][0] == key:
                    waits[-1] = (key, waits[-1][1], k)
                else:
                    waits.append((key, k, k))
            word = word_at(k)
            states = self.closure({
                to for s in states for want, to in self.moves[s] if want == word or (want is _ANY and best < 0)
            })
            k += 1
            if self._last in states:
                best = k
        for key, first, last in waits:
            seen[key] = (first, last if best >= 0 else end, best)
        return best


def hashes_of(phrases: list[str]) -> np.ndarray:
    """Hash of each one-word phrase, as `Words` has it."""
    texts = Texts(pa.array(phrases, pa.string()))
    return Words(texts, 0, len(phrases), LETTERS, FOLDED_TABLE).hash


def scan_licenses(
    docs: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES
) -> DataFrame:
    """``docs`` without its text, with ``n_words`` and ``license_spans``: (label, start, end, base) in words, end exclusive.

    Phrases give a span at every place. A template matches from a start to the first place where its wording is complete, and on over
    optional wording that follows; of matches with one label and end, the first start counts. Optional regions may be absent,
    replaceable ones hold any words (or as many as their markup says), all other words must match. NULL and empty texts have no words
    and no spans; repeated rows each get their result; other columns pass through (those named like a result column are replaced).
    """
    span = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])
    openers: dict[str, list[tuple[str, Automaton, bool]]] = {}
    for rules, is_base in ((templates, False), ([(label, p) for p, label in phrases.items()], True)):
        for label, rule in rules:
            automaton = Automaton(rule)
            for word in automaton.first_words():
                openers.setdefault(word, []).append((label, automaton, is_base))
    keys = hashes_of(sorted(openers))

    def make(texts: Texts, lo: int, hi: int) -> list[pa.Array]:
        words = Words(texts, lo, hi, LETTERS, FOLDED_TABLE)
        spans: list[list[dict]] = [[] for _ in range(hi - lo)]
        seen: dict[tuple[int, int], dict] = {}
        closed: set[tuple[int, str, int]] = set()

        def word_at(k: int) -> str:
            return texts.data[words.starts[k] : words.ends[k]].tobytes().lower().decode()

        for k in np.flatnonzero(np.isin(words.hash, keys)).tolist():
            row = int(words.rows[k])
            for label, automaton, is_base in openers.get(word_at(k), ()):
                end = automaton.match(word_at, k, int(words.first[row + 1]), seen.setdefault((row, id(automaton)), {}))
                if end > 0 and (is_base or (row, label, end) not in closed):
                    if not is_base:
                        closed.add((row, label, end))
                    at = int(words.first[row])
                    spans[row].append({"label": label, "start": k - at, "end": end - at, "base": is_base})
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        return [longs(words.counts), pa.array(spans, kind)]

    out = [T.StructField("n_words", T.LongType()), T.StructField("license_spans", T.ArrayType(span))]
    return map_texts(docs.drop("n_words", "license_spans"), text, out, make)


def license_report(scanned: DataFrame) -> DataFrame:
    """Digest of `scan_licenses`: counts and labels; ``score`` is the share of the words that lie in a span."""
    spans = F.col("license_spans")
    base = F.filter(spans, lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    covered = F.aggregate(
        ordered, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"),
                                (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n")),
        lambda acc: acc["n"],
    )

    def labels(of):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))))

    return scanned.withColumns({
        "n_base": F.size(base).cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts),
        "base_labels": labels(base), "labels": labels(spans),
        "score": F.when(F.size(spans) > 0, covered / F.col("n_words")).otherwise(F.lit(0.0)),
    }).drop("license_spans")
