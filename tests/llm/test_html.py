import random
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import html_text
from barloom.llm.html_text import ARTICLE, FURNITURE, OPEN, read_lines


def texts(page, kind):
    return [t for k, t in read_lines(page) if k == kind]


def test_marked_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body class="no-sidebar">
      <header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>gone</p> --><div class="ad top">Buy</div>
      <div id="cookie-notice">Accept</div><article class='post'><header><h1>Title &amp; more</h1></header><p><b>One
      two&nbsp;three.<br><p>Caf&eacute; &#169; &lt;b&gt; 1 < 2</p><aside>Side</aside><form><input><label>Mail</label><button>Send</button></form>
      <ul><li>a<li>b</ul><div class="comments"><p>Reader</p></div><section id=comments><article class="comment">Me too</article></section>
      <footer>Share</footer><p hidden>h</p><div style="display: none">no</div></article><aside>More</aside><footer>&copy; x</footer></body></html>"""
    assert texts(page, ARTICLE) == ["Title & more", "One two three.", "Café © <b> 1 < 2", "a", "b", "h"]
    assert not texts(page, OPEN)


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>a</div>b<div>c", "a\nb\nc"), ("<article>cut off <b", "cut off"),
    ("<script>only", ""), ("<!-- open", ""), ('<p title="a > b">x</p>', "x"), ("<p title='unclosed>x</p><p>y</p>", "x\ny"), ("&#10;a&#9;&#10;b", "a b"),
    ("<main>m<div>n</div></main><p>o", "m\nn"), ("<main>m<article>n</article></main>", "n"), ("<nav>only menu</nav>", ""), ("a</div></p></article>b", "a\nb"),
])
def test_odd_pages(page, want):
    assert html_text.main_text(read_lines(page)) == want


@pytest.mark.parametrize("page,want", [
    ("<html><head><title>T</title><meta charset=x><article><p>a<p>b</article>", "a\nb"), ("<head><title>T</title>\n<p>a</p>b", "a\nb"),
    ("<head><title>T</title> a<br>b", "a b"), ("<head><link rel=x><script>var a</script></head>a", "a"), ("<head><title>T<body><p>a", "a"),
    *[(f"<article><p>a<{raw}>no<p>b</p>c</article>", "a\nb\nc") for raw in ("button", "object", "noscript", "svg", "video", "iframe", "textarea")],
    ("<article><p>a</p><div><select><option>no<option>no</div>b</article>", "a\nb"), ("<button>no<p>a</p><button>no</button>", "a"),
    ("<div><button>no</div><article>a</article><footer><button>no</button></footer>", "a"), ("a<button><div>no</div></button>b", "a b"),
    ("a<object><object>no</object>no</object>b", "a b"), ("<p>a<button>no", "a"), ("a<noscript><style></div></style><p>no</p></noscript>b", "a b"),
    ("<form><header>no</header><article>a<aside>no</aside>b</article></form>", "a\nb"),
    ("<div class=sidebar-layout><nav>no</nav><main>long enough</main><aside><article>no</article></aside></div><p>x", "long enough"),
    ("<p>an open text</p><aside class=related><article>no</article></aside>", "an open text"), ("<article>a</article><form><article>no, too long</article></form>", "a"),
    ("<div class=comments><article>no</article></div>", ""), ("<form><div id=comments><article>no</article></div><article>a</article></form>", "a"),
    ("<div hidden><article>no</article></div>", ""),
])
def test_articles_are_not_lost(page, want):
    assert html_text.main_text(read_lines(page)) == want


def test_common_subsequence_is_the_longest():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                length[i + 1][j + 1] = length[i][j] + 1 if a[i] == b[j] else max(length[i][j + 1], length[i + 1][j])
        found = sorted(html_text.shared_lines(a, b))
        assert len(found) == length[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def brute(rows):
    """Pair each distinct page of a host with the neighbour by path whose path begins most alike."""
    out = []
    for pid, url, page in rows:
        lines = read_lines(page)
        if not any(k == OPEN for k, _ in lines):
            out.append((pid, html_text.main_text(lines)))
            continue
        host = html_text.host_and_path(url)[0]
        paths = {}
        for _, u, p in rows:
            h, path = html_text.host_and_path(u)
            if h == host:
                key = html_text._content(read_lines(p))
                paths[key] = min(paths.get(key, path), path)
        order = sorted(paths, key=lambda k: (paths[k], k))
        at = order.index(html_text._content(lines))
        near = []
        for n in (at - 1, at + 1):
            if 0 <= n < len(order):
                x, y = paths[order[at]], paths[order[n]]
                same = max(i for i in range(min(len(x), len(y)) + 1) if x[:i] == y[:i])
                near.append((-same, n))
        other = None
        if near:
            key = order[min(near)[1]]
            other = next([t for _, t in read_lines(p)] for _, u, p in rows if html_text.host_and_path(u)[0] == host and html_text._content(read_lines(p)) == key)
        out.append((pid, html_text.main_text(lines, other)))
    return sorted(out, key=str)


def test_unmarked_pages_are_differenced(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        host = ["a.org", "www.a.org", "b.org", "big.org", "big.org"][i % 5]
        body = "".join(f"<p>{w}</p>" for w in ["Welcome", f"{host} top", *[f"own {i} {rng.randrange(9)}" for _ in range(rng.randrange(4))], "Latest news", "Imprint"])
        if i % 7 == 0:
            body = f"<nav>menu</nav><article>{body}</article>"
        rows.append((i, f"http://{host}/{rng.choice(['x', 'y', 'xy'])}/{rng.randrange(30)}{rng.choice(['', '/', '#top'])}", body))
    rows += [(100 + i, f"http://big.org/copy/{i}", rows[3][2]) for i in range(20)]
    rows += [(200, None, "<p>no address"), (201, "http://alone.org/", "<p>alone"), (202, "http://[bad", None), (None, "http://b.org/z", "<p>Welcome<p>new"), rows[0]]
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in html_text.extract(pages).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert ("own" in t for _, t in got) and not any("Latest news" in t for i, t in got if i in (1, 2, 3))


def test_only_marked_or_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "<article><p>x</p></article>")] * 2, "page_id long, url string, html string")
    assert [r.text for r in html_text.extract(pages).collect()] == ["x", "x"]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_deep_and_unended_markup_takes_time_in_proportion():
    n = 40_000
    pages = {
        "one end for many objects": "<object><p>x</p>" * n + "</object>",
        "ends behind that of an ancestor": "<div>" + "<object><p>x</p>" * n + "</div>" + "</object>" * n,
        "nested": "<object>" * n + "<p>x</p>" + "</object>" * n,
        "buttons without an end": "<button><p>x</p>" * n,
        "select after select": "<select><option>x" * n,
        "styles without an end": "<svg><style>" * n,
        "sections closed as divs": "<section>" * n + "</div>" * n,
        "blocks inside an object closed as others": "<object>" + "<section>" * n + "</div>" * n + "</object>",
        "raw elements below many open blocks": "<div>" * n + "<button>x</button>" * n,
    }
    for name, page in pages.items():
        start = time.perf_counter()
        lines = read_lines("<p>first</p>" + page)
        assert time.perf_counter() - start < 5, name
        assert lines[0][1] == "first", name


@settings(deadline=None, max_examples=150)
@given(st.lists(st.sampled_from(["<object>", "</object>", "<p>a</p>", "b", "<div>", "</div>", "<button>", "</button>", "<svg>", "</svg>", "<style>", "</style>",
                                 "<object/>", "<li>"]), max_size=14))
def test_raw_elements_end_where_a_plain_search_says(parts):
    """The plain search looks from every start again; it has no memory to be wrong."""
    page = "".join(parts)
    names = Counter({"div": 1})
    shared = html_text.RawElements(page)
    at = 0
    while token := html_text.TOKEN.search(page, at):
        at = token.end()
        close, name = html_text._parts_of(token)
        if not close and name in html_text.RAW and not token[0].endswith("/>"):
            end = shared.end(at, name, names)
            assert end == html_text.RawElements(page).end(at, name, names)
            at = max(end, at)


def test_pages_that_mark_articles_are_differenced_too(spark):
    """Of several articles the one that the neighbour has line for line goes; an article with a line of its own stays whole."""
    teaser = "<article><h2>Teaser</h2><p>Read on</p></article>"
    rows = [(i, f"http://a.org/{i}", f"<nav>menu {i}</nav><main><article><h1>Title</h1><p>own {i}</p><section><article>part</article></section></article>{teaser}</main>")
            for i in range(6)]
    rows += [(10, "http://b.org/1", "<article><p>same</p></article>"), (11, "http://b.org/2", "<p>top</p><article><p>same</p></article>"),
             (12, "http://c.org/1", teaser * 2), (13, "http://c.org/2", f"{teaser * 2}<footer>x</footer>"), (14, "http://alone.org/", f"<article>a</article>{teaser}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {i: f"Title\nown {i}\npart" for i in range(6)} | {
        10: "same", 11: "same", 12: "Teaser\nRead on\nTeaser\nRead on", 13: "Teaser\nRead on\nTeaser\nRead on", 14: "a\nTeaser\nRead on"}


def test_marks_of_equal_lines_are_judged_apart(spark):
    """Pages of one host with the same lines are one place in its order, but each is checked by its own marks."""
    rows = [(1, "http://a.org/1", "<p>top</p><p>x</p>"), (2, "http://a.org/1", "<p>top</p><article><p>x</p></article>"), (3, "http://a.org/2", "<p>top</p><p>y</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == {1: "x", 2: "x", 3: "y"}
