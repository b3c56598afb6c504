import random
import re
import time
from html.entities import html5

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.functions import text as tx
from vitrine.functions import urls, values
from vitrine.functions.cleaning import Cleaner, _decode, clean_text, html_steps
from vitrine.functions.markup import prune_markup


@pytest.mark.parametrize("html, expected", [
    ("<h2>Oak &amp; <em>ash</em></h2>", "Oak & ash"),
    ("<div>Shown</div><style>p{}</style><script>let q = 1</script>", "Shown let q = 1"),
    ("<li>First</li><li>Second</li>", "First Second"),
    ("left <!-- aside --> right", "left right"),
    ("12\u00a0kg", "12\u00a0kg"),
    ("", ""),
    ("a &lt;b&gt;bold&lt;/b&gt; c", "a bold c"),
    ("1 < 2 and <i>x</i>", "1 < 2 and x"),
    ("<a title=\"x > y\">link</a> rest", "link rest"),
    ("<a <b> c> out", "out"),
    ("open <em never closed", "open"),
    ("<!-- > --> kept <!--->x", "kept x"),
    ("<pre>code</pre><thead>h</thead>", "code h"),
    ("see {{widget a}} and [gallery] #html-body end", "see and end"),
    ("x<a<b<c<d>1>2>3>y", "xy"),
    ("<i<u<q<a t='>'>>>>in<!-- <b<i --> out", "in out"),
    ("&eacute;t&eacute; &rsquo; &#8364; &#x1F600;", "été ’ € 😀"),
    ("&amp;lt; &#38;amp; &hearts; &nosuch; &#0; &#x41;", "&lt; &amp; ♥ &nosuch; &#0; A"),
])
def test_html_to_text(cleaned, html, expected):
    assert cleaned(html) == expected


def test_null_reads_as_blank(spark):
    assert clean_text(spark.createDataFrame([(None,)], "t string"), "t").first()["t"] == ""


def test_intent_mode(spark):
    def run(value):
        df = spark.createDataFrame([(value,)], "t string")
        for step in html_steps("intent"):
            df = df.withColumn("t", step(F.col("t")))
        return df.first()["t"]

    assert run("<div>Shown</div><script>let q = 1</script>") == "Shown"
    assert run("<li>First</li><li>Second</li>") == "First\nSecond"
    assert run("12\u00a0kg") == "12 kg"


def test_very_long_tag_does_not_overflow(cleaned):
    assert cleaned("a<i " + "x='1' " * 60_000 + ">b") == "ab"


def test_whitespace(one):
    assert one(lambda c: tx.normalize_ws(c, "compact"), "a\n b \u00a0\u2003c\n") == "a b c"
    assert one(lambda c: tx.normalize_ws(c, "full"), "a \t b\n\n\n\nc") == "a b\n\nc"
    assert one(lambda c: tx.normalize_ws(c, "full"), "") == ""


def test_truncate(one):
    cut = one(lambda c: tx.truncate_words(c, 17), "willow alder hazel rowan")
    assert cut == "willow alder…" and len(cut) <= 18
    assert one(lambda c: tx.truncate_words(c, 40), "elm") == "elm"
    assert one(lambda c: tx.truncate_words(c, 4), "abcdefgh") == "abcd…"
    assert one(lambda c: tx.truncate_words(c, 10), "ab cdefghijklm") == "ab cdefghi…"


def _truncate(value, n):
    if len(value) <= n:
        return value
    head = value[:n]
    at = head.rfind(" ")
    if at != -1 and at > n * 0.7:
        head = head[:at]
    return head.rstrip(" \t\n\r\0\x0b") + "…"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\té😀", max_size=40), min_size=1, max_size=30), st.integers(1, 30))
def test_truncate_matches_plain_python(spark, texts, n):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.truncate_words(F.col("t"), n).alias("c"))
    assert all(r["c"] == _truncate(r["t"], n) and len(r["c"]) <= n + 1 for r in df.collect())


def test_escape_and_embedding(one):
    assert one(tx.escape_markdown, "[a](b)|`c`") == r"\[a\]\(b\)\|\`c\`"
    assert one(lambda a, b, c: tx.embedding_text(a, b, c), "n", "", "d") == "n\n\nd"
    assert one(lambda a, b: tx.embedding_text(a, b, limit=3), " ab", "cd") == "ab\n"


def test_values(one):
    assert one(values.format_price, 1234.5) == "1234.50"
    assert one(values.format_price, 1.005) == "1.01"
    assert [one(values.format_bytes, n) for n in (5, 2048, 3 * 1048576)] == ["5 B", "2.0 KB", "3.0 MB"]
    assert [one(values.bcp47, v) for v in ("en_US", "")] == ["en-US", "en-US"]
    assert one(values.parse_list, " a, b\n0,,c ") == ["a", "b", "c"]
    assert [one(values.leading_int, v) for v in ("12abc", "-3", "x", "")] == [12, -3, 0, 0]
    assert [one(values.leading_int, s + "9" * 20) for s in ("", "-")] == [(1 << 63) - 1, -(1 << 63)]
    assert one(values.format_price, 1e16) == "1" + "0" * 16 + ".00" and one(values.format_price, -0.001) == "0.00"
    assert [one(values.flag, v) for v in ("1", "0", "", "no")] == [True, False, False, True]
    assert one(values.utc_time, 86400) == "1970-01-02 00:00:00"
    assert one(values.iso_time, 0) == "1970-01-01T00:00:00+00:00"


def test_urls(one):
    assert one(urls.absolute_url, "https://s.test", "/p.html") == "https://s.test/p.html"
    assert one(urls.store_base_url, "https://s.test//", "de", True, False) == "https://s.test/de"
    assert one(urls.store_base_url, "https://s.test/", "de", True, True) == "https://s.test"
    names = [one(urls.output_name, f, "de") for f in ("llms_txt", "llms_full_txt", "jsonl")]
    assert names == ["llms_de.txt", "llms-full_de.txt", "llms_de.jsonl"]
    paths = ["/llms.txt", "/de/llms-full.jsonl", "/a/b.md", "/a/llms.txt.bak", "/"]
    assert [one(urls.route_class, p) for p in paths] == ["document", "document", "mirror", None, None]
    assert one(urls.url_path, "https://s.test/a/b.md?x=1#y") == "/a/b.md"


KEEP = '<section data-content-type="text"><b>Kept words</b></section>'


@pytest.mark.parametrize("html, rule, keeps, drops", [
    (KEEP + '<i data-content-type="products">cut</i>', "exclude|", ["Kept words"], ["cut"]),
    ('<h4>Above</h4><table data-content-type="map"><tr><td data-content-type="text">within</td></tr></table><h4>Below</h4>',
     "strip|", ["Above", "Below"], ["within", "data-content-type"]),
    ('<b data-content-type="slider" class="s">moving</b>' + KEEP + '<b data-content-type="tabs">tabbed</b>',
     "exclude|slider,video", ["Kept words", "tabbed"], ["moving"]),
    ('<b data-content-type="video">played</b>' + KEEP, "allow|text,tabs", ["Kept words"], ["played"]),
    ('<ol data-content-type="grid"><li data-content-type="cell">stays<em data-content-type="slider">out <u>far</u> out</em></li></ol>',
     "exclude|slider", ["stays"], ["out", "far"]),
    ('<ul><li data-content-type="products">a<li>b</ul>c', "exclude|", ["b", "c"], ["a<"]),
    ('<img data-content-type="banner">x<br>y', "exclude|", ["x", "y"], ["img"]),
    ('<div><p data-content-type="banner">a</div>b', "exclude|", ["b", "</div>"], [">a"]),
    ('<!-- <div data-content-type="banner"> -->x', "strip|", ["x"], []),
])
def test_pruning(html, rule, keeps, drops):
    out = prune_markup(html, rule)
    assert all(k in out for k in keeps) and not any(d in out for d in drops)


def test_pruning_leaves_text_alone():
    plain, marked = "<p>Plain</p>", KEEP
    assert prune_markup(plain, "strip|") == plain
    assert prune_markup(marked, "preserve|") == marked
    assert prune_markup(marked, "unknown|") == marked
    bad = '<ul data-content-type="grid"><li>never <b data-content-type="cell">closed'
    assert isinstance(prune_markup(bad, "strip|"), str)


def test_pruning_through_the_pipeline(cleaned):
    html = KEEP + '<div data-content-type="products">cut</div>'
    assert cleaned(html, rule="exclude|") == "Kept words"
    assert cleaned(html, rule="preserve|") == "Kept words cut"
    assert cleaned("plain", rule="strip|") == "plain"


def _decoded(value):
    def one(m):
        token = m.group()
        if not token.startswith("&#"):
            return html5.get(token[1:], token)
        digits, base = (token[3:-1], 16) if token[2] in "xX" else (token[2:-1], 10)
        code = int(digits, base)
        bad = code > 0x10FFFF or 0x7F <= code < 0xA0 or 0xD800 <= code < 0xE000 or 0xFDD0 <= code <= 0xFDEF or code & 0xFFFE == 0xFFFE
        return token if bad or (code < 0x20 and code not in (9, 10, 12)) else chr(code)

    return re.sub(r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);", one, value)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.text(alphabet="&#xa1;ltgmp ", max_size=30), st.integers(0, 0x120000).map(lambda n: f"a&#{n};b"),
    st.integers(0, 0x120000).map(lambda n: f"&#x{n:X};&amp;"), st.sampled_from(sorted(html5)).map(lambda n: f"&{n}")), min_size=1, max_size=30))
def test_entities_decode_once(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", _decode(F.col("t")).alias("d"))
    assert all(r["d"] == _decoded(r["t"]) for r in df.collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="<>/style p\"'!-&;", max_size=60), min_size=1, max_size=20))
def test_cleaning_leaves_no_style(spark, texts):
    df = clean_text(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert not any("<style>" in r["t"].lower() for r in df.collect())


def test_stages_run_in_order_and_failures_pass_through(spark):
    def broken(col):
        raise RuntimeError("no")

    cleaner = (
        Cleaner([]).register_stage("a", lambda c: F.concat(c, F.lit("A")), 1)
        .register_stage("broken", broken, 2).register_stage("b", lambda c: F.concat(c, F.lit("B")), 3)
    )
    assert clean_text(spark.createDataFrame([("X",)], "t string"), "t", cleaner=cleaner).first()["t"] == "XAB"


# tags that hold tags


def outside_tags(value):
    """What lies outside tags, comments and processing instructions, character by character."""
    out, i, depth, quote = [], 0, 0, ""
    while i < len(value):
        rest = value[i:]
        if depth == 0:
            special = ("<!--", "-->", 2) if rest.startswith("<!--") else ("<?", "?>", 2) if rest.startswith("<?") else None
            if special:
                end = value.find(special[1], i + 2)
                i = len(value) if end < 0 else end + len(special[1])
                continue
        c = value[i]
        opens = c == "<" and (i + 1 == len(value) or value[i + 1] not in " \t\n\x0b\f\r")
        if quote:
            quote = "" if c == quote else quote
        elif opens:
            depth += 1
        elif depth == 0:
            out.append(c)
        elif c == ">":
            depth -= 1
        elif c in "\"'":
            quote = c
        i += 1
    return "".join(out)


def test_nested_tags_match_brute_force(spark):
    from vitrine.functions.cleaning import _strip_tags
    rng = random.Random(3)
    pieces = ["<", "<a", ">", "</b>", " ", "x", '"', "'", "<!--", "-->", "<?", "?>", "< ", "é", "=\"<i>\"", "-", "\n"]
    values = ["".join(rng.choices(pieces, k=rng.randrange(0, 25))) for _ in range(1500)]
    values += ["<a" * n + "in" + ">" * m + "out" for n, m in ((24, 24), (25, 25), (26, 26), (60, 60), (60, 59), (3, 90))] + ["x<a" * 40, "<" * 30 + ">" * 29 + "y"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r["s"] for r in df.select(_strip_tags(F.col("t")).alias("s")).collect()]
    for value, found in zip(values, got):
        assert found == outside_tags(value), value


def test_long_nested_markup_is_read_once(spark):
    text = "<p>some text &amp; more <a href='x'<b>>in</a> plain words here &eacute; </p>" * 13_000
    df = spark.createDataFrame([(text,)], "t string")
    clean_text(df, "t").first()
    begun = time.time()
    assert clean_text(df, "t").first()["t"].startswith("some text & more in plain words here é")
    assert time.time() - begun < 10


def test_blanks_are_cut_as_by_plain_patterns(spark):
    rng = random.Random(7)
    values = ["", " ", "  ", "\n", "\0", " \0 ", "é\n", "é\n\n", *("".join(rng.choices(" \t\n\r\0\x0b\x0c\u00a0\u2003 aé.", k=rng.randint(1, 12))) for _ in range(400))]
    c = F.col("t")
    steps = {"ascii": tx.collapse_ascii(c), "any": tx.collapse_any(c), "lines": tx.collapse_lines(c), "trim": tx.trim_column(c),
             "cut": tx.cut_spaces(c), "line": tx.without_last_newline(c)}
    some = spark.createDataFrame([(v,) for v in [*values, None]], "t string").select("t", *(v.alias(k) for k, v in steps.items()))
    for row in some.collect():
        t = row["t"]
        if t is None:
            assert set(row) == {None}
            continue
        cut = t[1:] if t.startswith(" ") else t
        assert row.asDict() == {
            "t": t, "ascii": re.sub("[ \t\n\x0b\f\r]+", " ", t), "any": re.sub("[ \t\n\x0b\f\r\u00a0\u2003]+", " ", t),
            "lines": re.sub("\n{3,}", "\n\n", re.sub("[ \t]+", " ", t)), "trim": t.strip(tx.TRIM_CHARS),
            "cut": cut[:-1] if cut.endswith(" ") else cut, "line": t.removesuffix("\n")}
