"""URL rules and main text against plain versions, and pages of every odd kind."""

import random

from silverloom.llm import html_model, queries, url_rules
from tests.conftest import SF

SITES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in SITES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    token, tokens = "", set()
    for c in host + " ":
        if c.isascii() and c.isalnum():
            token += c
        else:
            tokens.add(token)
            token = ""
    return host, path, None, "block" if tokens & set(url_rules.BLOCKED_WORDS) else "allow"


def test_url_rules_equal_every_rule_on_every_url(spark, tmp_path):
    r = random.Random(6)
    hosts = ["example.org", "a.example.org", "EXAMPLE.org", "notexample.org", "x.com", "com", "org", "free-bets.net", "bets.example.com", "abets.net", "", "ÄÖ.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/2", "/fr/x", "/FR/x", "/de/1", "//de/", "/a/de/1"]
    urls = [f"{s}{h}{p}{q}" for h in hosts for p in paths for s, q in [(r.choice(["http://", "https://", "", "HTTP://"]), r.choice(["", "?q=/es/", "#top", "?x#y"]))]]
    urls += [None, "", "://", "http://", "http:///x", "a://b://c/de/", "http://x\n.com/de/\n", "mailto:a@b.org", "http://x.com?/de/", "http://casino", "http://a-casino.x/y"]
    df = spark.createDataFrame([(k, u, "extra", "extra") for k, u in enumerate(urls)] + [(0, urls[0], "e", "e"), (None, "http://a.org/", "e", "e")],
                               "page_id long, url string, host string, verdict string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op3_url_rules(spark, str(tmp_path)).collect()
    assert len(got) == len(urls) + 2
    for g in got:
        url = urls[g["page_id"]] if g["page_id"] is not None else "http://a.org/"
        assert (g["host"], g["path"], g["rule"], g["verdict"]) == plain(url), url
    assert url_rules.judge(df.limit(0)).count() == 0


def test_a_rule_is_filed_under_its_rarest_token():
    rule = url_rules.site_rule("block", "example.org", "/en/1")
    assert rule.tokens == ("example", "org", "en")
    index = url_rules.Index((rule,), {"example": 5, "org": 9, "en": 2})
    assert list(index._by_token) == ["en"]
    assert index("a.example.org", "/en/17") == ("example.org/en/1", "block") and index("example.org", "/fr/1") is None


MODEL = html_model.train()


def page(article, before="<nav><ul><li><a href=x>Menu</a></li></ul></nav><div class=ad>Buy this now.</div>", after="<footer>&copy; me</footer>"):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><article>x</article>'</script></head><body>{before}{article}{after}</body></html>"


def test_main_text_of_many_shapes():
    cases = {
        page("<article><h1>Title</h1><p><b>One &amp; two.<br><p>Three\n  four.</p></article>"): "Title\nOne & two.\nThree four.",
        page("<article><p>a<br>b</p><p></p><p> </p><p>c&nbsp;d &lt;i&gt;</p></article>"): "a b\nc d <i>",
        page("<article><p>Same</p><p>Same</p></article>"): "Same\nSame",
        page("<article><p>Kept.</p></article>", after="<section class='comments'><article class=comment><p>Reader.</p></article></section><aside class=sidebar><p>Side</p></aside>"): "Kept.",
        page("<article><p>Kept.</p><form><p>Mail</p><input><button>Go</button></form><!-- note --></article>", before="<header><p>Site</p></header><div class='cookie notice'>We use cookies.</div>"): "Kept.",
        page("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>"): "one\ntwo\nx\ny",
        page("<article><p>" + "long " * 50_000 + "</p></article>"): " ".join(["long"] * 50_000),
        page("<article>" + "<div>" * 8 + "deep" + "</div>" * 8 + "</article>"): "deep",
        "<html><body><p>Nothing but</p><p>paragraphs.</p></body></html>": "Nothing but\nparagraphs.",
        page("<article><p>unended"): "unended",
    }
    for html, text in cases.items():
        assert MODEL.extract(html) == text, html[:300]
    MODEL.extract(page("<article>" + "<div>" * 5000 + "deep"))  # deep nesting does not fail
    for nothing in (None, "", "   ", "<", "<html>", "<script>x", "</p></div>", "<!-- <p>x</p> -->", "<nav><p>x</p></nav>"):
        assert MODEL.extract(nothing) == ""


def test_formulas_and_odd_marks_keep_the_text_around_them():
    cases = {
        "<p>Let <math><mi>x</mi><mo>=</mo><mrow><mn>1</mn></mrow><annotation>x=1</annotation></math> be a number.</p>": "Let x=1 be a number.",
        "<p>a<![ b</p><p>c</p>": "a\nc", "<p>a</p><![foo[x]]><p>b</p>": "a\nb", "<p>a</p><![CDATA[x]]><!x><?php y ?></ ><p>b</p>": "a\nb",
        "<p>a</p><![ b": "a", "<p>1 < 2 <3 & 4</p>": "1 < 2 <3 & 4", "<p>a<object><b>b</b></object>c <ruby>d<rt>e</rt></ruby></p>": "abc de",
        "<p>a <math>x<p>b</p>": "a x\nb", "<p>a<br/>b<hr/></p><p/><p>c": "a b\nc", "<p>a</p><!--> <p>b</p> --> <p>c": "a\nb\n-->\nc",
        '<p>a</p><p class="x><y" id=\'">\'>b</p><p x= "un': "a\nb", "<p>a</p><textarea><p>x</textarea><iframe><p>y</iframe><p>b": "a\nb",
        "<p>a</p><a href=x/>b</a>": "a\nb", "<p>a <script>x</script>b <button>c</button>d</p>": "a b d",
    }
    for inner, text in cases.items():
        assert MODEL.extract(page("<article>" + inner, before="", after="")).split("\n")[:9] == text.split("\n"), inner


def test_time_grows_with_the_length_whatever_is_left_open():
    from time import perf_counter
    n = 100_000
    shapes = ["<div>" * n + "</section>" * n, "<a " * (5 * n), "<b>" * n + "</i>" * n, "<i><div>" + "<b>" * n + "</i>" * n, "<b>" * n + "<p>" * n,
              "<center>" * n + "<li>" * n, "<!-" * n, "<![" * n, "<a x='" * n, "<script>" * n, "</" * n, "<p>" * n, "<math>" * n + "<mi>" * n, "&amp" * n,
              "<a" + " " * n + "x" * n, "<table>" * n + "<tr>" * n, "x" * 2_000_000, "<a =" + "=" * n, "<head>" * n + "<body>" * n, "<" * n]
    for shape in shapes:
        start = perf_counter()
        MODEL.extract("<article><p>Kept.</p>" + shape)
        assert perf_counter() - start < 20, shape[:40]


def test_messages_equal_sums_over_all_labellings():
    """Marginals of a small tree by enumeration."""
    from itertools import product
    from math import exp
    p = html_model.Page("<div><article><p>a</p><p>some more</p></article><nav>b</nav></div>")
    total, one = 0.0, [0.0] * len(p.parent)
    for y in product((0, 1), repeat=len(p.parent)):
        w = exp(sum(MODEL._own(p.features(k)) * y[k] for k in range(len(y))) + sum(MODEL.pair[y[p.parent[k]]][y[k]] for k in range(1, len(y))))
        total += w
        one = [a + w * b for a, b in zip(one, y)]
    assert all(abs(a / total - b) < 1e-9 for a, b in zip(one, MODEL.marginals(p)))


def test_given_pages_keep_their_articles_alone(spark):
    import html as h
    import re
    got = queries.op5_html_tree_model(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for g in got:
        inner = re.search(r"(?s)<article>(.*?)</article>", pages[g["page_id"]]).group(1)
        parts = [" ".join(h.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert g["text"] == "\n".join(x for x in parts if x) and g["n_chars"] == len(g["text"])


def test_pages_with_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>Just a paragraph that stands alone on its page.</p>", "x"), (2, "u", "", "x"), (2, "u", "", "x")],
                               "page_id long, url string, html string, text string")
    rows = html_model.extract_text(df, MODEL).collect()
    assert sorted((str(r["page_id"]), r["text"] != "") for r in rows) == [("1", False), ("2", False), ("2", False), ("None", rows[1]["text"] != "")]
    assert html_model.extract_text(df.limit(0), MODEL).count() == 0
