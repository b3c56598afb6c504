"""Substring dedup against earlier documents, by brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_words import SPACED
from vitrine.llm import earlier_text as et

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    held = [(i, SPACED.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in held:
        if i is not None:
            for p in range(len(words) - window + 1):
                key = tuple(words[p : p + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, words in held:
        gone = set()
        for p in range(len(words) - window + 1):
            if i is not None and first[tuple(words[p : p + window])] < i:
                gone.update(range(p, p + window))
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(left.encode()).hexdigest(), left))
    return sorted(out, key=repr)


def found(spark, rows, window):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n_words": F.lit("own"), "body": F.lit(1), "spans": F.lit(2), "_id": F.lit(3), "_c0": F.lit(4)})
    out = et.remove_earlier(df, window=window, keep_text=True)
    assert out.columns == ["doc_id", "body", "spans", "_id", "_c0", "n_words", "n_removed", "kept_sha256", "kept"]
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")) for r in out.collect()), key=repr)


@pytest.mark.parametrize("window, seed", [(13, 1), (4, 2), (2, 3), (5, 4)])
def test_removed_words_match_brute_force(spark, window, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab") if rng.random() < 0.3 else f"w{rng.randrange(30)}é"
    shared = [[word() for _ in range(rng.choice([window - 1, window, window + 1, 2 * window, 6 * window]))] for _ in range(8)]
    rows = []
    for i in range(160):
        words = []
        for _ in range(rng.randrange(0, 5)):
            part = rng.choice(shared) if rng.random() < 0.5 else [word() for _ in range(rng.randrange(3 * window))]
            cut = rng.randrange(len(part) + 1)
            words += part if rng.random() < 0.6 else part[cut:]
        rows.append((rng.randrange(120), rng.choice([" ", "\n", " \t"]).join(words)))
    rows += rows[:6] + [(None, rows[3][1]), (None, None), (200, None), (201, ""), (202, "a " * 50), (203, "a " * 60), (-5, rows[9][1])]
    assert found(spark, rows, window) == brute(rows, window)


def test_very_long_text_and_group_of_copies(spark, monkeypatch):
    import vitrine.llm.words as w
    monkeypatch.setattr(w, "BLOCK_BYTES", 3000)
    rng = random.Random(7)
    words = [f"x{rng.randrange(5000)}" for _ in range(40_000)]
    rows = [(5, " ".join(words)), (9, " ".join(words[100:30_000])), (1, " ".join(words[20_000:20_050]))]
    rows += [(20 + i, " ".join(words[:40])) for i in range(300)]
    assert found(spark, rows, 13) == brute(rows, 13)


def test_empty_table(spark):
    assert found(spark, [], 13) == []
