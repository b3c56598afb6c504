import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm import words as w

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def found(texts, kind, table):
    held = w.Texts(pa.array(texts, pa.string()))
    out, hashes = [], []
    for lo, hi in held.blocks():
        words = w.Words(held, lo, hi, kind, table)
        for r in range(hi - lo):
            span = range(words.first[r], words.first[r + 1])
            out.append([held.data[words.starts[k] : words.ends[k]].tobytes().decode() for k in span])
            hashes += [words.hash[k] for k in span]
    return out, hashes


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBz09 \t\n\x0b-_.éß文😀\x00\x7f", max_size=40)), max_size=12))
def test_words_match_the_patterns(texts):
    plain = [t or "" for t in texts]
    assert found(texts, w.SPACED, w.EXACT_TABLE)[0] == [SPACED.findall(t) for t in plain]
    words, hashes = found(texts, w.LETTERS, w.FOLDED_TABLE)
    assert [[fold(x) for x in row] for row in words] == [LETTERS.findall(fold(t)) for t in plain]
    flat = [fold(x) for row in words for x in row]
    assert len(dict(zip(flat, hashes))) == len(set(hashes)) and len(set(zip(flat, hashes))) == len(set(flat))


@pytest.mark.parametrize("size", [64, 100])
def test_long_texts_are_scanned_in_pieces(monkeypatch, size):
    monkeypatch.setattr(w, "BLOCK_BYTES", size)
    texts = ["x" * 500, None, "", "ab cd " * 200, "é文 " * 90, " ", "y"]
    words, hashes = found(texts, w.SPACED, w.EXACT_TABLE)
    assert words == [SPACED.findall(t or "") for t in texts]
    assert len(set(hashes)) == len({x for row in words for x in row})


def test_grams_stay_within_rows():
    held = w.Texts(pa.array(["a b c", "c", None, "a b c d"], pa.string()))
    words = w.Words(held, 0, 4, w.SPACED, w.EXACT_TABLE)
    hashes, at = words.grams(3)
    assert at.tolist() == [0, 4, 5] and hashes[0] == hashes[1] != hashes[2]
    assert words.counts.tolist() == [3, 1, 0, 4] and words.sums(np.ones(8)).tolist() == [3, 1, 0, 4]
