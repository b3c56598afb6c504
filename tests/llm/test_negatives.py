"""Hard-negative mining against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>"


def whole(vector):
    return [int(np.floor(256 * x)) for x in vector]


def brute(rows):
    held = [(i, v, l, whole(e)) for i, (v, l, e) in enumerate(rows)
            if v is not None and l is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, anchor, label, a in held:
        if anchor % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), v, l) for j, v, l, b in held if j != i]
        for s, positive, _ in sorted(r for r in scored if r[2] == label)[:5]:
            fits = sorted(r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s)[:10]
            out += [(anchor, positive, k, v, -s, -t) for k, (t, v, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).withColumns({"row": F.lit("own"), "rank": F.lit(1), "group": F.lit(None)})
    return sorted(map(tuple, hn.mine_hard_negatives(df, anchor=F.col("vec_id") % 10 == 0).collect()))


@pytest.mark.parametrize("most, width", [(300, 3), (10**6, 70), (2**27, 130), (2**30, 2), (0, 1), (5, 3000)])
def test_scores_are_exact(most, width):
    rng = np.random.default_rng(most)
    a, b = (rng.integers(-most, most + 1, (n, width)) for n in (7, 9))
    a[0], b[0], b[1] = most, most, -most
    found = hn.scores(a, b, hn.residue_primes(width, width * most * most))
    assert found.tolist() == (a.astype(object) @ b.astype(object).T).tolist()


@pytest.mark.parametrize("block_rows, group_blocks", [(4096, 64), (16, 2)])
def test_negatives_match_brute_force(spark, monkeypatch, block_rows, group_blocks):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hn, "GROUP_BLOCKS", group_blocks)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 7)
    rng = random.Random(1)
    rows = [(i, rng.randrange(3), [rng.choice([-0.5, 0.0, 0.25, 1.0]) + rng.random() / 50 for _ in range(4)]) for i in range(250)]
    # Ties, repeated rows, equal ids, ragged and empty vectors.
    rows += [(i, i % 2, [0.5, 0.5, 0.5, 0.5]) for i in range(250, 330)] + [rows[20], rows[20], (20, 1, [0.5, 0.25]), (340, 0, [])]
    rows += [(None, 1, [1.0]), (350, None, [1.0]), (360, 1, None), (370, 1, [1.0, None]), (380, 0, [float("nan")]), (390, 0, [float("-inf")])]
    assert mined(spark, rows) == brute(rows)


def test_long_vectors_and_large_components(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.uniform(-400, 400) for _ in range(1500)]) for i in range(40)]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(ValueError):
        mined(spark, [(0, 1, [1e9]), (1, 0, [1.0])])


def test_tables_without_pairs(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(10, 1, [1.0]), (11, 2, [1.0])]) == []
