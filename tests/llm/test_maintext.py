import random
import time
from os.path import commonprefix

import pytest

from gridpulse.llm import maintext as m

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    return {r.page_id: r.text for r in m.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_article_without_what_surrounds_it(spark):
    page = """<!DOCTYPE html><html><head><title>t &amp; u</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="page-menu"><header>top</header><nav><ul><li><a href=x>menu</a></li></ul></nav><div id=cookie-notice>we use cookies</div><!-- ad --><div class="ad">buy</div>
    <article><header><h1>A&nbsp;title</h1></header><p><b>One<br><p>two &lt;three&gt;  x<i>y</i>z &copy <form><input>q</form><aside>side</aside><p>four<script>x</script>
    <div class="comments"><p>reader says</div></article><footer>&copy; foot</footer></body></html>"""
    assert texts(spark, [(1, "http://a/1", page)]) == {1: "A title One two <three> xyz © four"}


def test_shared_lines_go_where_no_element_marks_the_article(spark):
    frame = "<body><div>Site name</div><p>{}</p><p>shared words at the end</p></body>"
    rows = [(i, f"http://h/dir/{i}", frame.format(f"own text of page number {i}, which is much longer than what all pages share")) for i in range(3)]
    rows += [(9, "http://other/1", frame.format("alone"))]
    got = texts(spark, rows)
    assert all(got[i] == f"own text of page number {i}, which is much longer than what all pages share" for i in range(3))
    assert got[9] == "Site name alone shared words at the end"


def test_copies_keep_their_text(spark):
    page = "<p>the same text of a page</p><p>that is there twice</p>"
    assert set(texts(spark, [(1, "http://h/a", page), (2, "http://h/a?x=1", page)]).values()) == {"the same text of a page that is there twice"}


def test_odd_pages(spark):
    broken = "<p class='x>never closed <b>text"
    rows = [(1, None, None), (2, "http://a", ""), (3, "not a url", "plain &lt; text"), (4, "http://a", "<article></article>"), (None, None, "<p>x"), (5, "http://b", broken), (6, "http://c", "<p>" + "word " * 200_000), (6, "http://c", "<p>again")]
    got = m.extract(spark.createDataFrame([(*r, "extra") for r in rows], PAGES + ", text string")).collect()
    assert len(got) == 8 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id in (1, 2, 3, 4, None)} == {1: "", 2: "", 3: "plain < text", 4: "", None: "x"}
    assert max(r.n_chars for r in got) == 999_999
    assert m.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_alignment_by_brute_force():
    def lcs(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rnd = random.Random(0)
    for _ in range(200):
        pool = [f"l{i}" for i in range(12)]
        a, b = rnd.sample(pool, rnd.randint(0, 12)), rnd.sample(pool, rnd.randint(0, 12))
        got = sorted(m.shared(a, b))
        assert len(got) == lcs(a, b)
        places = [b.index(a[i]) for i in got]
        assert places == sorted(places)


def test_random_markup_never_fails():
    rnd = random.Random(1)
    bits = ["<", ">", "<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<!--", "-->", "<script>", "text", "&amp;", "&", "'", '"', "<b", "/>", "<br/>"]
    for _ in range(300):
        assert all(x == " ".join(x.split()) for x, _ in m.lines_of("".join(rnd.choice(bits) for _ in range(40))))


@pytest.mark.parametrize("odd", ['<a ' + '"x" ' * 10_000, '<a x="' * 10_000, "<" * 100_000, "<div>" * 20_000 + "</b>" * 20_000, "<b>" * 20_000 + "<div></div>" * 20_000, "<!--" * 10_000, "<title>" * 10_000])
def test_broken_markup_takes_little_time(odd):
    began = time.time()
    m.lines_of(odd)
    assert time.time() - began < 1


def test_only_named_parts_go():
    page = """<title>t</title><body><article><p class="notice-of-motion">a<div class="share price">b</div><section id="related-work">c</section>
    <math><mi>d</mi></math><svg><text>e</text></svg><video>f</video><div class="article-body ad-free">g</div><div class="has-sidebar">h</div>
    <div class="header">i</div><p>j</p></article><div class="cookie-notice">no</div><div class="site-footer">no</div><div id="sidebar-left">no</div>
    <ul class="main-menu"><li>no</ul><ul role="navigation"><li>no</ul><section class="comments-section">no</section><p>k</p>"""
    kept = [x for x, kind in m.lines_of(page) if kind != m.NAMED]
    assert " ".join(kept).replace(" ", "") == "abcdefghijk"


def test_teasers_do_not_hide_the_text(spark):
    page = "<body><div><p>the main text {}</p></div><aside><article><h2>teaser</h2></article></aside><div>Our site</div>"
    got = texts(spark, [(i, f"http://h/{i}", page.format(i)) for i in range(3)])
    assert got == {i: f"the main text {i}" for i in range(3)}


def test_a_shared_article_survives(spark):
    page = "<div>Site name</div><article><p>the same article</p></article><div>{}</div>"
    rows = [(1, "http://h/a", page.format("Posted on Monday")), (2, "http://h/b", page.format("Posted on Tuesday"))]
    assert texts(spark, rows) == {1: "the same article Posted on Monday", 2: "the same article Posted on Tuesday"}


def brute(rows):
    """All pairs of pages in one sorted list."""
    def parts(url):
        head, _, rest = (url or "").partition("://")
        end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
        path = rest[end:]
        return rest[:end].lower() if rest else "", path[: min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))]

    out = {}
    order = sorted(rows, key=lambda r: (*parts(r[1]), r[0]))
    for at, (page_id, url, markup) in enumerate(order):
        host, path = parts(url)
        lines = m.lines_of(markup or "")
        outside = [(x, k) for x, k in lines if k != m.ARTICLE]
        near = [order[i] for i in (at - 1, at + 1) if 0 <= i < len(order) and host and parts(order[i][1])[0] == host]
        gone = set()
        for _, other, text in sorted(near, key=lambda o: -len(commonprefix([path, parts(o[1])[1]]))):
            far = [(x, k) for x, k in m.lines_of(text or "") if k != m.ARTICLE]
            both = m.shared([x for x, _ in outside], [x for x, _ in far])
            size = lambda some: sum(len(x) for x, k in some if k == m.PLAIN)
            if size([outside[i] for i in both]) <= 0.8 * max(size(outside), size(far)):
                gone = both
                break
        left = [i for i, (_, k) in enumerate(outside) if k == m.PLAIN and i not in gone]
        places = [i for i, (_, k) in enumerate(lines) if k != m.ARTICLE]
        stay = {places[i] for i in left} | {i for i, (_, k) in enumerate(lines) if k == m.ARTICLE}
        out[page_id] = " ".join(x for i, (x, _) in enumerate(lines) if i in stay)
    return out


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(3)
    frame = ["Site name", "Home", "About us", "Read more", "All rights reserved"]
    rows = []
    for i in range(160):
        own = [f"text {rnd.randint(0, 10**6)} of page {i}" for _ in range(rnd.randint(1, 4))]
        body = frame[: rnd.randint(1, 3)] + own + frame[rnd.randint(3, 4) :]
        tag = rnd.choice(["p", "div", "li"])
        markup = "".join(f"<{tag}>{x}</{tag}>" for x in body) + rnd.choice(["", "<article>an article</article>", "<nav>Home</nav>"])
        rows.append((i, f"http://h{rnd.choice('aaab')}/{rnd.choice('xy')}/{rnd.randint(0, 99)}{rnd.choice(['', '?q=1'])}", markup))
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 61])
def test_texts_do_not_depend_on_partitions(spark, pages, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.enabled", str(partitions == 8).lower())
        got = {r.page_id: r.text for r in m.extract(spark.createDataFrame(pages, PAGES).repartition(partitions)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == brute(pages)
    assert sum("Site name" in t for t in got.values()) < len(got) / 4


def test_differencing_deletes_lines_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    keyed = pages.select("page_id", "url", "html").selectExpr("*", "xxhash64(page_id, url, html) AS k1", "xxhash64(1, html, url, page_id) AS k2")
    assert m.differences(keyed).selectExpr("sum(size(gone))").first()[0] > 0
