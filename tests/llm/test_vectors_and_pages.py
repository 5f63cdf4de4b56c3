import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import cap_filters, html_main, topk, url_filter

VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, q boolean, n_links string, rank int"


def vectors(rows, spark):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", 1, True, "n", 2) for i, v, label in rows], VECTORS)


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(7)
    rows, base = [], rng.normal(size=(60, 16))
    for i, b in enumerate(base):
        rows.append((i, b, i % 3))
    for i in range(80):  # near copies at all distances round the threshold
        b = base[i % 20] + rng.normal(size=16) * rng.uniform(0, 0.5) * np.linalg.norm(base[i % 20]) / 4
        rows.append((100 + i, b * rng.uniform(0.1, 30), (i % 20) % 3))
    for i in range(30):  # one large group of near copies
        rows.append((300 + i, base[1] + rng.normal(size=16) * 0.01, 1))
    rows += [(400, base[2], 2), (401, base[2], None), (402, None, 1), (403, [0.0] * 16, 1), (404, [math.nan, *[1.0] * 15], 1), (405, [math.inf, *[1.0] * 15], 1), (406, [None, *[1.0] * 15], 1)]
    rows += [(407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1), (409, [], 1), (410, [1e30] * 16, 1), (411, [1e-30] * 16, 1)]
    return [(i, None if v is None else list(np.float32(v)) if None not in list(v) else list(v), label) for i, v, label in rows]


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, threshold=0.93):
    ok = {i: np.array(v, float) for i, v, label in rows if sound(v) and any(v) and label is not None}
    unit = {i: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for i, v in ok.items()}
    label = {i: x for i, _, x in rows}
    links = {i: set() for i, _, _ in rows}
    for i in ok:
        for j in ok:
            if i != j and label[i] == label[j] and len(ok[i]) == len(ok[j]) and unit[i] @ unit[j] >= threshold:
                links[i].add(j)
    part = {}
    for i in sorted(links):
        if i not in part:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in part:
                    part[x] = i
                    todo += links[x]
    return {i: (len(links[i]), part[i]) for i in links}


@pytest.mark.parametrize("chunk", [cap_filters.CHUNK, 8])
def test_cap_filters(spark, awkward, monkeypatch, chunk):
    monkeypatch.setattr(cap_filters, "CHUNK", chunk)
    got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.near_duplicates(vectors(awkward, spark)).collect()}
    expected = brute_links(awkward)
    assert set(got) == set(expected)
    # a filter scheme: recall close to one, and never a link below the threshold
    assert all(got[i][0] <= expected[i][0] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in expected.values())
    assert np.mean([got[i][1] == expected[i][1] for i in got]) > 0.98
    assert all(got[i] == (0, i) for i in range(401, 407)) and got[410][1] == got[411][1] == 410


def test_cap_filters_empty(spark):
    assert cap_filters.near_duplicates(vectors([], spark)).collect() == []
    assert [tuple(r) for r in cap_filters.near_duplicates(vectors([(5, None, None)], spark)).collect()] == [(5, 0, 5, True)]


def test_lists_hold_all_exceeding_filters():
    f = cap_filters.Filters(16, 2, 6)
    rng = np.random.default_rng(0)
    unit = rng.normal(size=(20, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    directions = np.zeros((36, 16))
    for n, place in enumerate(f.places):
        for p, c in enumerate(place):
            directions[n, f.cuts[p]] = f.codes[p][c] / np.sqrt(2)
    assert np.allclose(np.linalg.norm(directions, axis=1), 1)
    scores = unit @ f.rotation @ directions.T
    for got, row in zip(f.lists(unit, 0.3, 3), scores, strict=True):
        assert set(got) >= set(np.flatnonzero(row >= 0.3)) and len(got) >= 3


def brute_top(rows, k=5):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in ok if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("block", "tile"), [(256, 8192), (4, 30)])
def test_top_k(spark, awkward, monkeypatch, block, tile):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "TILE", tile)
    rows = [(i, v, x) for i, v, x in awkward if i < 407]
    rows += [(500, rows[3][1], 1), (501, rows[3][1], 1)]  # ties
    got = topk.top_k(vectors(rows, spark), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_k_few_and_none(spark):
    assert topk.top_k(vectors([], spark), F.col("vec_id") % 50 == 0).collect() == []
    got = topk.top_k(vectors([(0, [1, 2], None), (1, [1, 1], None), (2, None, 1)], spark), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 256 * 256 * 3)]
    assert topk.top_k(vectors([(0, [1, 2], None)], spark), F.col("vec_id") % 50 == 0).collect() == []


URLS = "page_id long, url string, html string, host string, path string, rule string, text string, verdict string"


def test_urls(spark):
    rules = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"), ("allow", "x.org", "")]
    cases = {
        "http://a.Example.COM/en/70?x": ("a.example.com", "/en/70", "example.com/en/7", "allow"),
        "https://notexample.com/en/7#f": ("notexample.com", "/en/7", "com/en/", "block"),
        "http://example.net/de/80": ("example.net", "/de/80", "example.net/de/8", "block"),
        "http://example.net/de": ("example.net", "/de", None, "allow"),
        "http://org?a=/es/": ("org", "", None, "allow"),
        "http://y.x.org/es/1": ("y.x.org", "/es/1", "org/es/", "block"),
        "ftp://x.org": ("x.org", "", "x.org", "allow"),
        "no scheme/en/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://É.com/en/ü": ("É.com", "/en/ü", "com/en/", "block"),
        "://com/en/" + "z" * 50000: ("com", "/en/" + "z" * 50000, "com/en/", "block"),
        "a://b://c.com/en/": ("b:", "//c.com/en/", None, "allow"),
    }
    rows = [(i, u, "h", "clash", "p", "r", "t", "v") for i, u in enumerate(cases)] * 2
    got = url_filter.judge(spark, spark.createDataFrame(rows, URLS), rules).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r.url
    none = url_filter.judge(spark, spark.createDataFrame(rows[:3], URLS), [], default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")}
    assert url_filter.judge(spark, spark.createDataFrame([], URLS), rules).collect() == []


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "_keys", lambda strings: np.array([len(s) % 2 for s in strings], np.uint64))
    rules = [("block", "a.com", "/x"), ("allow", "b.com", "/y"), ("block", "cc.com", "/")]
    url_filter.DigestArray.build(rules, str(tmp_path / "d"))
    index = url_filter.DigestArray(str(tmp_path / "d"))
    assert isinstance(index.keys, np.memmap)
    got = index.probe(["b.com\n/y", "z.com\n/y", "cc.com\n/", "a.com\n/x"])
    assert [index.name(i) if i >= 0 else None for i in got] == ["b.com\n/y", None, "cc.com\n/", "a.com\n/x"]


def page(*body):
    return "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>" + "".join(body) + "</body></html>"


ARTICLE = "<article class='post-1'><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text &lt;x&gt;<br><p>Second&nbsp;part</article>"
TEXT = "Head & line First bold text <x> Second part"


def test_pages(spark):
    menu, foot = "<nav><ul><li><a href=/>Home of everything that is here</a></li></ul></nav>", "<footer>&copy; host " + "legal words " * 40 + "</footer>"
    extra = "<div class='ad'>Buy now " + "really " * 30 + "</div><div id=comments><p>" + "I think so too. " * 30 + "</p></div><script>var t='</p>';</script><aside>side " * 1 + "</aside><form>Name <button>Go</button></form><div class='cookie-notice'>We use</div>"
    rows = [(i, f"http://h.com/{i}", page(menu, extra, ARTICLE, "<!-- gone -->", extra, foot), *["clash"] * 5) for i in range(4)]
    rows += [(10, "http://h.com/div", page(menu, "<div class='content-17'><p>Only a division " + "with words " * 20 + "</p></div>", foot), *["c"] * 5)]
    rows += [(11, None, page(ARTICLE), *["c"] * 5), (12, "http://h.com/none", None, *["c"] * 5), (13, "http://h.com/empty", "", *["c"] * 5), (14, "http://h.com/bare", "just <i>some</i> text", *["c"] * 5)]
    rows += [(15, "http://h.com/long", page("<main>" + "<p>word</p>" * 40000 + "</main>"), *["c"] * 5), rows[0], (16, "x", "<", *["c"] * 5), (17, "x", "<p <div", *["c"] * 5)]
    df = spark.createDataFrame(rows, URLS)
    out = html_main.extract(df)
    got = {r.page_id: r for r in out.collect()}
    assert out.count() == len(rows) and "html" not in out.columns and out.columns.count("text") == 1
    assert all(got[i].text == TEXT and got[i].n_chars == len(TEXT) for i in range(4)) and got[11].text == TEXT
    assert got[10].text.startswith("Only a division with") and "legal" not in got[10].text and "Home" not in got[10].text
    assert (got[12].text, got[13].text, got[12].n_chars) == ("", "", 0) and got[14].text == "just some text"
    assert got[15].text == " ".join(["word"] * 40000)
    assert html_main.extract(spark.createDataFrame([], URLS)).collect() == []


def test_the_host_decides(spark):
    """A page whose own best container is another one follows its host."""
    good = lambda i: page(f"<div class='box-{i}'><p>" + f"the real text {i} " * 30 + "</p></div><div class='teaser'>short one</div>")
    odd = page("<div class='box-9'><p>real but short</p></div><div class='teaser'>" + "a very long teaser " * 50 + "</div>")
    rows = [(i, "http://one.com/x", good(i), *["c"] * 5) for i in range(5)] + [(9, "http://one.com/y", odd, *["c"] * 5)]
    got = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, URLS)).collect()}
    assert got[9] == "real but short" and html_main.Page(odd).best().endswith("teaser")


def prose(n, word):
    return (word + " ") * (n // (len(word) + 1))


def test_nested_and_split_articles_are_whole(spark):
    nested = page("<div class=post><h1>The title</h1><p>" + prose(300, "lead") + "</p><div class=entry-content><p>" + prose(2000, "body") + "</p></div></div><div class=more>" + prose(100, "teaser") + "</div>")
    split = page("<article><div class=wrap><div class=intro>" + prose(600, "intro") + "</div><div class=body>" + prose(1400, "body") + "</div></div><p>The end</p></article>")
    plain = page("<div class=x><h2>Heading</h2><div class=y><p>" + prose(2000, "body") + "</p></div></div>")
    sections = page("<section class=a>" + prose(600, "one") + "</section><section class=b>" + prose(1400, "two") + "</section>")
    links = page("<div class=a><a href=/>" + prose(90, "one") + "</a></div><div class=b><a href=/>" + prose(90, "two") + "</a></div>")
    expected = {
        nested: "The title " + prose(300, "lead") + prose(2000, "body"), split: prose(600, "intro") + prose(1400, "body") + "The end",
        plain: "Heading " + prose(2000, "body"), sections: prose(600, "one") + prose(1400, "two"), links: prose(90, "one") + prose(90, "two"),
    }
    rows = [(10 * i + k, f"http://h{i}.com/{k}", source, *["c"] * 5) for i, source in enumerate(expected) for k in range(3)]
    got = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, URLS)).collect()}
    for i, text in enumerate(expected.values()):
        assert {got[10 * i + k] for k in range(3)} == {text.strip()}


def main_text(*body):
    p = html_main.Page(page(*body))
    return p.text(p.best())


@pytest.mark.parametrize("wrapper", ["class='content with-sidebar'", "id=wrapper class='no-sidebar'", "class='sidebar-right'", "id=nav", "role=banner"])
def test_wrappers_with_words_of_layouts(wrapper):
    assert main_text(f"<div {wrapper}><h1>Title</h1><p>" + prose(900, "body") + "</p></div><div class=sidebar>" + prose(100, "side") + "</div>") == "Title " + prose(900, "body").strip()


def test_names_hide_only_what_is_beside_the_article():
    parts = ["<section id='side-effects'>Effects</section>", "<section id=legal>Law</section>", "<h2 id='related-work'>Related</h2>", "<h2 id='legal-status'>Status</h2>", "<p class='alert'>Mind</p>", "<div class=notice>Note</div>"]
    long = "<p>" + prose(900, "body") + "</p>"
    words = "Effects Law Related Status Mind Note " + prose(900, "body").strip()
    beside = "".join(f"<div class='{c}'><p>" + prose(200, "beside") + "</p></div>" for c in ("sidebar", "site-footer", "ad-slot-2", "nav-links", "comment-list", "share-buttons", "cookie-notice"))
    assert main_text("<article>", *parts, long, "</article>", beside) == words
    assert main_text("<div class=post>", *parts[2:5], long, "</div>", beside) == "Related Status Mind " + prose(900, "body").strip()
    # comments longer than the article stay out, also in the article
    comments = "<section id=comments><p>" + prose(5000, "reply") + "</p></section>"
    assert main_text("<article>", long, comments, "</article>") == main_text("<article>", long, "</article>", comments) == prose(900, "body").strip()


def test_open_elements_end():
    assert main_text("<div class=x><p class=ad>Buy<p>" + prose(900, "body") + "<ul><li class=share>Share<li>One<li>Two</ul></div>") == prose(900, "body") + "One Two"
    assert html_main.Page("<html><head><meta charset=utf-8><body><p>text").text("") == "text"


def test_nothing_left_is_shown():
    assert main_text("<form id=aspnet><div class=menu>Menu</div><p>" + prose(300, "body") + "</p></form>") == prose(300, "body").strip()
    assert main_text("<div class=comments><p>" + prose(300, "body") + "</p></div>") == prose(300, "body").strip()
    assert main_text("<nav>Home</nav><footer>Law</footer>") == ""


@pytest.mark.parametrize("script", ["for(i=0;i<n;i++){a(i)}", "var s=\"it's <b\";", "if(a<b)x('", "document.write('<article><p>no')", "x='</scripted>'"])
def test_scripts_are_no_markup(script):
    article = "<article><p>" + prose(300, "body") + "</p></article>"
    assert main_text(f"<script>{script}</script>", article) == prose(300, "body").strip()
    assert main_text("<article><p>One</p>", f"<SCRIPT type=a>{script}</Script ><style>a<b{{}}</style>", "<p>Two</p></article>", f"<script>{script}") == "One Two"
    assert main_text(f"<canvas><script>{script}</script>", article) == prose(300, "body").strip()


def test_quotes_and_labels():
    body = "<p>" + prose(300, "body") + "</p>"
    assert main_text("<article><p title=\"5\" tall\">One</p><p title='a>b' id=\"x\">Two</p><img alt=\"a > b\">", body, "</article>") == "One Two " + prose(300, "body").strip()
    assert main_text("<article><p>Text <label>labelled</label> more</p>", body, "</article>") == "Text labelled more " + prose(300, "body").strip()
    assert main_text("<label for=m>Menu</label><div class=x><p>Text <label>labelled</label> more</p>", body, "</div>") == "Text labelled more " + prose(300, "body").strip()
    assert main_text("<script><!-- hide</script><article>", body, "</article>") == prose(300, "body").strip()
    assert main_text("<article><div class=a <p>One</p>", body, "</article>") == "One " + prose(300, "body").strip()


@pytest.mark.parametrize("part", ["<a ", "<!", "<div>", "<div class=menu>", "<a x='", "=\"<a ", "<script>", "<svg>", "<li>", "<!--", "<p><table><b>", "&amp", "<"])
def test_time_is_linear(part):
    """A megabyte of what opens and never ends."""
    import time

    began = time.perf_counter()
    p = html_main.Page(part * (1_000_000 // len(part)) + "<p>end")
    p.text(p.best())
    assert time.perf_counter() - began < 30


def generated_page(rng):
    """(html, main text) of a page made of parts whose place is known."""
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh")) for _ in range(rng.randint(2, 9))) for _ in range(n))
    said = []

    def block():
        kind = rng.choice(["p", "p", "p", "h2", "ul", "quote", "div", "table"])
        parts = [words(rng.randint(4, 40)) for _ in range(rng.randint(1, 3))]
        if kind in ("p", "h2", "div"):
            said.append(" ".join(parts))
            mixed = f" <b>{parts[0]}</b>\n" + "  ".join(f"<i>{x}</i>" for x in parts[1:])
            return f"<{kind}>{mixed}</{kind}>"
        said.extend(parts)
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{x}" for x in parts) + "</ul>"
        if kind == "table":
            return "<table><tr>" + "".join(f"<td>{x}" for x in parts) + "</table>"
        return "<blockquote>" + "".join(f"<p>{x}" for x in parts) + "</blockquote>"

    beside = [
        lambda: "<nav><ul>" + "".join(f"<li><a href='/{i}'>{words(3)}</a>" for i in range(rng.randint(2, 30))) + "</ul></nav>",
        lambda: f"<aside><p>{words(30)}</p></aside>",
        lambda: f"<div class='sidebar'><p>{words(40)}</p></div>",
        lambda: f"<div class='ad-slot-{rng.randint(1, 9)}'>{words(50)}</div>",
        lambda: f"<form><label>{words(2)}</label><input name=q><button>{words(1)}</button></form>",
        lambda: f"<script>if (a<b && c>d) {{ x = '<p>{words(5)}' }}</script><style>p > a {{}}</style><!-- {words(9)} <p> -->",
        lambda: f"<div class='cookie-notice'>{words(20)}</div>",
        lambda: f"<section id=comments><p>{words(60)}</p></section>",
        lambda: f"<footer><p>{words(25)}</p></footer>",
    ]
    around = lambda: "".join(rng.choice(beside)() for _ in range(rng.randint(0, 4)))
    inner = "".join(block() + (rng.choice(beside)() if rng.random() < 0.2 else "") for _ in range(rng.randint(4, 14)))
    inner = rng.choice(["<article class='post-{}'>{}</article>", "<main><div class='wrap'>{1}</div></main>", "<div class='entry-{}'>{}</div>", "<div class=outer><div class='story'>{1}</div></div>"]).format(rng.randint(1, 99), inner)
    head = "<header><h1>" + words(3) + "</h1></header>" if rng.random() < 0.5 else ""
    return page(head, around(), inner, around()), " ".join(said)


def test_generated_pages(spark):
    """Texts that are known because the pages were made around them."""
    rng = random.Random(17)
    rows, expected = [], {}
    for i in range(160):
        source, expected[i] = generated_page(rng)
        rows.append((i, f"http://host{i}.com/", source, *["c"] * 5))
    got = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, URLS)).collect()}
    wrong = [i for i in expected if got[i] != expected[i]]
    assert not wrong, (rows[wrong[0]][2], expected[wrong[0]], got[wrong[0]])
