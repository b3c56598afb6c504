"""Operators that compare rows: near duplicates, suffix-array dedup, URL filter, mixing, chats."""

import collections
import hashlib
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.test_texts import docs
from tests.llm.test_words import SPACED, fold
from vitrine.llm import chats, mixing, near_dups, substrings, urls

# near duplicates


def shingles(text, n):
    words = SPACED.findall(fold(text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def classes(texts, n, p, q):
    sets = [shingles(t, n) for t in texts]
    comp = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and q * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j]) and comp[i] != comp[j]:
            comp = [comp[i] if c == comp[j] else c for c in comp]
    least = {c: min(i for i, x in enumerate(comp) if x == c) for c in comp}
    return [(len(s), least[c]) for s, c in zip(sets, comp)]


def altered(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"z{rng.randrange(10 ** 6)}"
    return " ".join(out)


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "one", "one two", "ONE  two"]
    base = [f"w{rng.randrange(60)}" for _ in range(90)]
    texts += [" ".join(base)] * 3 + [altered(rng, base, rng.randrange(1, 4)) for _ in range(25)]
    # A chain whose ends don't link by themselves, and a star around a text that comes last.
    chain = list(base[:60])
    for i in range(12):
        chain[i * 4] = f"q{i}"
        texts.append(" ".join(chain))
    star = [f"s{rng.randrange(400)}" for _ in range(120)]
    texts += [altered(rng, star, 3) for _ in range(15)] + [" ".join(star)]
    texts += [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 60))) for _ in range(25)]
    return texts


@pytest.mark.parametrize("n, p", [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, n, p):
    texts = corpus(n)
    found = near_dups.near_duplicates(docs(spark, *texts), n=n, p=p, q=100).collect()
    expected = classes(texts, n, p, 100)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [(i, *x) for i, x in enumerate(expected)]


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f g h i j k l", "a b c d e f g h i j k l", None, "", "x y z", "a b c d e f g h i j k l m"]
    df = docs(spark, *texts).withColumn("n_shingles", F.lit("own"))
    kept = near_dups.keep_one_each(df.union(df.where("doc_id in (0, 3, 4)")))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 3, 4]
    assert near_dups.keep_one_each(df.where("false")).count() == 0
    nameless = near_dups.keep_one_each(df.withColumn("doc_id", F.lit(None).cast("long")))
    assert sorted((r["text"] or "") for r in nameless.collect()) in (["", "", texts[0], "x y z"], ["", "", texts[5], "x y z"])


# suffix-array dedup


def without_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    places = collections.Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if places[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("length, block", [(40, None), (41, 128), (400, 1000)])
def test_removed_bytes_match_brute_force(spark, monkeypatch, length, block):
    rng = random.Random(length)

    def text(n):
        return "".join(rng.choice("abé文 \n") for _ in range(n))

    shared = [text(n) for n in (length // 2, length - 1, length, length + 3, 3 * length)]
    texts = [None, "", "x", "a" * (2 * length), "ab" * length, text(length), shared[4], shared[4], shared[4][5:-7]]
    for _ in range(25):
        texts.append("".join(rng.choice([text(rng.randrange(3 * length)), rng.choice(shared)]) for _ in range(rng.randrange(1, 5))))
    if block:
        import vitrine.llm.words as w
        monkeypatch.setattr(w, "BLOCK_BYTES", block)
        monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    df = docs(spark, *texts).withColumn("n_spans", F.lit("own"))
    found = substrings.remove_repeats(df, length=length, keep_bytes=True).collect()
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in sorted(found, key=lambda r: r["doc_id"])]
    assert got == without_repeats(texts, length)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)
    assert substrings.remove_repeats(df.where("false"), length=length).count() == 0


# URL filter


def split_url(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else None
    if rest is None:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return fold(host), re.match(r"[^?#]*", rest[len(host):])[0]


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if ("." + host).endswith("." + h) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "x://Www.example.com/en", "http://notexample.com/en/1",
    "a://b://c.net/es/1", "http://d.net/fr/?q=/", "http://d.net#/fr/", "http://net/fr/", "https://com", "https://com/", "http://e.org/en/", "http://É.ORG/a",
    "http://e.org/en/",
]


def clashing(df):
    """With columns named like those the operator works with, and one of a result's name."""
    return df.withColumns({"mined": F.lit(1), "tokens": F.lit(2), "ruled": F.lit(3), "reps": F.lit(4), "_c0": F.lit(5), "host": F.lit("own")})


def test_rules_match_brute_force(spark):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    found = {r["page_id"]: r for r in urls.judge_urls(clashing(df)).collect()}
    assert len(found) == len(URLS) and all((r["mined"], r["tokens"], r["ruled"], r["reps"]) == (1, 2, 3, 4) for r in found.values())
    for i, url in enumerate(URLS):
        host, path = split_url(url)
        rule, verdict = ruled(host, path)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == verdict if verdict else found[i]["verdict"] in ("allow", "block")
    assert urls.judge_urls(df.where("false")).count() == 0


def test_words_of_one_template_make_one_class(spark):
    words = "/".join(f"w{chr(97 + i // 5)}{chr(97 + i % 5)}" for i in range(25))
    rows = [f"http://a.net/fr/{words}/{i}" for i in range(40)] + [f"http://b.com/{chr(97 + i % 7) * 3}" for i in range(300)]
    asked = [f"http://c.org/{w}" for w in words.split("/")] + [f"http://c.org/{words}", "http://c.org/ccc", "http://c.org/" + "x/" * 50_000]
    df = spark.createDataFrame(list(enumerate(rows + asked)), "page_id long, url string")
    found = [r["verdict"] for r in urls.judge_urls(df).orderBy("page_id").collect()]
    assert found == ["block"] * 40 + ["allow"] * 300 + ["block"] * 26 + ["allow"] * 2


def test_token_classes_match_brute_force(spark):
    rng = random.Random(8)
    sets = [sorted({t for t in "abcdefg" if rng.random() < 0.5} | ({"x", "y"} if rng.random() < 0.5 else set())) for _ in range(12)]
    rows = sets + sets[:5]
    found = {r["token"]: r["rep"] for r in urls.token_classes(spark.createDataFrame([(s,) for s in rows], "tokens array<string>")).collect()}
    where = {t: tuple(t in s for s in rows) for s in rows for t in s}
    assert found == {t: min(o for o in where if where[o] == where[t]) for t in where}


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(4)
    names = ["h:a", "h:b", "p:x", "p:y", "p:z"]
    rows = []
    for _ in range(120):
        tokens = sorted(rng.sample(names, rng.randrange(1, 4)))
        rows.append((tokens, "block" if {"h:a", "p:x"} <= set(tokens) or (tokens == ["p:y"] and rng.random() < 0.95) else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, ruled string")
    mined = {(tuple(r["tokens"]), r["verdict"]): (round(r["confidence"], 9), round(r["support"], 9)) for r in urls.mine_rules(labelled, 0.02, 0.9).collect()}
    expected = {}
    for k in range(1, 4):
        for some in itertools.combinations(names, k):
            own = [v for t, v in rows if set(some) <= set(t)]
            for verdict in ("block", "allow"):
                n = own.count(verdict)
                if n >= 0.02 * len(rows) and n >= 0.9 * len(own):
                    expected[some, verdict] = (round(n / len(own), 9), round(n / len(rows), 9))
    assert mined == expected

    asked = [(list(s),) for k in range(1, 6) for s in itertools.combinations(names, k)]
    rules = urls.mine_rules(labelled, 0.02, 0.9)
    found = {tuple(r["tokens"]): r["mined"] for r in urls.match_rules(spark.createDataFrame(asked, "tokens array<string>"), rules, labelled).collect()}
    for (tokens,) in asked:
        fits = [(-c, -len(t), -s, v != "block", t, v) for (t, v), (c, s) in expected.items() if set(t) <= set(tokens)]
        assert found.get(tuple(tokens)) == (min(fits)[-1] if fits else None)


# mixing


def targets(sizes):
    """Excess above three times the size goes to the others by weight until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        left = {s: w for s, w in weights.items() if s not in capped}
        rest = total - sum(capped.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def test_mixing_takes_exact_quotas(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(0, 60), "en", rng.choice(["big"] * 6 + ["a", "é", "z", None, "tiny"][: 1 + i % 5])) for i in range(1500)]
    rows += [(1500, None, "en", "a"), (1501, "", "en", "none"), (7, rows[7][1], "en", rows[7][3])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"rest": F.lit("own"), "_source": F.lit(1), "_named": F.lit(2)})
    first, again = (mixing.mix(df).collect() for _ in range(2))
    key = lambda r: (r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])
    assert sorted(map(key, first)) == sorted(map(key, again)) and len(first) == len(rows)
    sizes, taken, told = collections.Counter(), collections.Counter(), {}
    for r in first:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        told[r["source"]] = (r["source_size"], r["target"])
    for source, target in targets(sizes).items():
        assert told[source][0] == sizes[source] and told[source][1] == pytest.approx(target)
        assert abs(taken[source] - target) <= 0.5
    assert mixing.mix(df.where("false")).count() == 0
    assert {r["target"] for r in mixing.mix(df.where("size(split(coalesce(text, ''), ' ')) = 1 and coalesce(text, '') = ''")).collect()} == {0.0}


def test_mixed_blocks_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 30)), "en", "ab"[i % 7 == 0]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("shard", F.lit("own"))
    blocks = mixing.mixed_blocks(df).collect()
    assert all(len(SPACED.findall(r["text"])) == r["taken"] > 0 for r in blocks)
    per_doc = collections.Counter()
    for r in blocks:
        per_doc[r["doc_id"]] += r["taken"]
    total = sum(i % 30 for i in range(200))
    assert abs(sum(per_doc.values()) - total) <= 1 and all(n <= 3 * (i % 30) for i, n in per_doc.items())


def test_one_document_per_source_is_cut(spark):
    rng = random.Random(5)
    names = [f"s{i:02}" for i in range(20)] + [None]
    rows = [(i, " \n".join(f"w{j}" for j in range(rng.randrange(1, 40))), "en", names[i % 20]) for i in range(6000)]
    rows += [(6000 + i, "x  y\nz\tu " * rng.randrange(1, 8), "en", None) for i in range(60)]
    rows += [(7000 + i, "v " * rng.randrange(1, 30), "en", "s01") for i in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = mixing.mix(df).collect()
    cut = collections.Counter(r["source"] for r in found if 0 < r["rest"] < r["size"])
    assert len(found) == len(rows) and max(cut.values()) == 1 and len({r["shard"] for r in found if r["source"] is None}) > 10
    sums = collections.defaultdict(lambda: [0, 0])
    for r in found:
        sums[r["source"]][0] += r["taken"]
        sums[r["source"]][1] = r["target"]
    assert set(sums) == set(names) and all(abs(taken - target) <= 0.5 for taken, target in sums.values())
    plain = {i: text for i, text, _, _ in rows}
    blocks = mixing.mixed_blocks(df).collect()
    assert all(plain[r["doc_id"]].startswith(r["text"]) for r in blocks)
    cut = collections.Counter(r["source"] for r in blocks if plain[r["doc_id"]] != r["text"])
    assert max(cut.values()) == 1


def test_draws_follow_the_distribution(spark):
    cases = spark.range(4000).withColumns({"n": F.lit(50), "m": F.lit(20), "d": F.lit(15)})
    drawn = [r[0] for r in cases.select(mixing.hypergeometric(F.col("n"), F.col("m"), F.col("d"), "id")).collect()]
    assert min(drawn) >= 0 and max(drawn) <= 15
    mean, var = 15 * 20 / 50, 15 * 0.4 * 0.6 * 35 / 49
    assert sum(drawn) / 4000 == pytest.approx(mean, abs=0.15)
    assert sum((x - mean) ** 2 for x in drawn) / 4000 == pytest.approx(var, rel=0.12)
    edge = spark.createDataFrame([(10, 10, 4, 4), (10, 0, 4, 0), (10, 3, 10, 3), (10, 3, 0, 0), (1, 1, 1, 1)], "n long, m long, d long, e long")
    assert all(r["x"] == r["e"] for r in edge.select("e", mixing.hypergeometric(F.col("n"), F.col("m"), F.col("d"), "n").alias("x")).collect())
    big = spark.range(200).select(mixing.hypergeometric(F.lit(10 ** 12), F.lit(4 * 10 ** 11), F.lit(10 ** 11), "id").alias("x")).collect()
    assert all(abs(r["x"] - 4 * 10 ** 10) < 6 * 1.5e5 for r in big) and len({r["x"] for r in big}) > 150


@pytest.mark.parametrize("n, m, d", [(20_000, 4000, 5000), (3000, 300, 700), (4000, 2000, 2000)])
def test_draws_by_rejection_have_the_exact_probabilities(spark, monkeypatch, n, m, d):
    monkeypatch.setattr(mixing, "INVERTED_SD", 5.0)
    drawn = collections.Counter(r[0] for r in spark.range(10_000).select(mixing.hypergeometric(F.lit(n), F.lit(m), F.lit(d), "id")).collect())
    whole = math.comb(n, d)
    wanted = {k: 10_000 * (math.comb(m, k) * math.comb(n - m, d - k) / whole) for k in range(min(drawn) - 5, max(drawn) + 5)}
    terms = [(drawn[k] - e) ** 2 / e for k, e in wanted.items() if e >= 8]
    assert sum(terms) < len(terms) + 4 * math.sqrt(2 * len(terms)) and sum(wanted.values()) > 9990


# chats


def test_chat_edge_cases(spark):
    turns = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
        (3, 5, "user", "a"), (3, 9, "assistant", "b"), (3, 9, "assistant", "b"), (4, 0, None, None), (5, 0, None, ""), (6, None, "user", "z"),
        (6, 1, "user", "x"), (None, 0, "user", "lost"), (7, 0, "user", "a"), (8, 0, "user", "a"), (8, 1, "assistant", "B"), (9, 0, None, None),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("n_copies", F.lit("own"))
    found = {r["conv_id"]: r for r in chats.format_chats(df).collect()}
    assert set(found) == {2, 4, 5, 6, 8}
    assert found[2]["n_turns"] == 3 and found[4]["n_copies"] == 2 and found[4]["rendered"] == "<|user|>\n\n<|end|>\n"
    assert found[6]["rendered"] == "<|user|>\nz\n<|end|>\n<|user|>\nx\n<|end|>\n"
    assert chats.format_chats(df.where("false")).count() == 0
