"""The one text step that built-in expressions cannot state, as an Arrow-batched Pandas UDF.

Callers mask the input to NULL where a row does not need it, so only marked-up texts travel to Python.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vitrine.constants import DEFAULT_ALLOWED, DEFAULT_EXCLUDED

MARKER = "data-content-type="


# fixed values: HTML elements without content, and those an equal sibling closes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING_SIBLINGS = frozenset("p li dt dd option tr td th".split())
LIST_SCOPE = frozenset("ul ol dl table select div section article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?</\1\s*>"
    r"|<(/?)([A-Za-z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_TYPE = re.compile(r"\bdata-content-type\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def _dropper(rule: str):
    """Test of an element type under a rule ``strategy|comma separated types``."""
    strategy, _, listed = rule.partition("|")
    types = frozenset(t for t in listed.split(",") if t)
    if strategy == "strip":
        return lambda kind: True
    if strategy == "exclude":
        excluded = types or frozenset(DEFAULT_EXCLUDED)
        return lambda kind: kind in excluded
    if strategy == "allow":
        allowed = types or frozenset(DEFAULT_ALLOWED)
        return lambda kind: kind not in allowed
    return None


def prune_markup(value: str, rule: str, drops=None) -> str:
    """Leave out every element whose type the rule drops, with all it holds."""
    drops = drops or _dropper(rule)
    if drops is None or MARKER not in value:
        return value
    kept: list[str] = []
    open_names: list[str] = []
    dropped_at = -1  # depth of the dropped element we are inside, or -1
    start = 0  # where the text not yet copied begins

    def close_to(depth: int) -> None:
        nonlocal dropped_at
        del open_names[depth:]
        if dropped_at >= depth:
            dropped_at = -1

    for token in _TOKEN.finditer(value):
        closing, name, attributes = token.group(2), token.group(3), token.group(4)
        if name is None:
            continue
        name = name.lower()
        if closing:
            if name not in open_names:
                continue
            depth = len(open_names) - 1 - open_names[::-1].index(name)
            was_dropped = dropped_at >= 0
            ends_at_tag = dropped_at == depth
            close_to(depth)
            if was_dropped and dropped_at < 0:
                # The end tag belongs to what was dropped, unless it closes an outer element.
                start = token.end() if ends_at_tag else token.start()
            continue
        if name in SELF_CLOSING_SIBLINGS:
            for depth in range(len(open_names) - 1, -1, -1):
                if open_names[depth] == name:
                    was_dropped = dropped_at >= 0
                    close_to(depth)
                    if was_dropped and dropped_at < 0:
                        start = token.start()
                    break
                if open_names[depth] in LIST_SCOPE:
                    break
        empty = name in VOID or attributes.rstrip().endswith("/")
        if dropped_at < 0:
            found = _TYPE.search(attributes)
            if found and drops(next(g for g in found.groups() if g is not None)):
                kept.append(value[start:token.start()])
                start = token.end()
                if not empty:
                    dropped_at = len(open_names)
        if not empty:
            open_names.append(name)
    if dropped_at < 0:
        kept.append(value[start:])
    return "".join(kept)


def _prune_or_keep(value, rule, droppers):
    if value is None:
        return None
    try:
        if rule not in droppers:
            droppers[rule] = _dropper(rule)
        return prune_markup(value, rule, droppers[rule])
    except Exception:  # a step that fails on a row passes its input on
        return value


@F.pandas_udf(StringType())
def prune(texts: pd.Series, rules: pd.Series) -> pd.Series:
    droppers: dict = {}
    return pd.Series([_prune_or_keep(t, r, droppers) for t, r in zip(texts, rules)], dtype=object)


# The function travels whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
