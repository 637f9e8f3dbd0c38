import html
import re

from textmill.llm import html_template as H

SMALL = "/root/testdata/sf0.001"


def article(page):
    """Headings and paragraphs of the table's article element, read by plain patterns."""
    body = re.search(r"<article>(.*)</article>", page or "", re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    lines = [" ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in parts]
    return "\n".join(x for x in lines if x)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    source = {r.page_id: r for r in pages.collect()}
    found = H.extract(pages).collect()
    assert len(found) == len(source)
    for r in found:
        assert r.url == source[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == article(source[r.page_id].html), r.page_id


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<div id="top"><a href="/">Home</a> <a href="/b">More</a></div><div class="wrap">
<div class="story">{body}</div><div class="box"><ul><li><a href="/1">{link}</a></li><li><a href="/2">Next one</a></li></ul></div>
</div><div class="footer-line">Fixed closing words</div><p>Always the same line</p></body></html>"""


def test_region_is_deduced_without_article_element(spark):
    rows = [
        (k, f"https://Site.org:80/{k}", PAGE.format(body="".join(f"<p>Story {k} part {j} " + f"word{j} " * 60 + "</p>" for j in range(k % 3 + 1)), link=f"Link {k}"))
        for k in range(6)
    ]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert found[k].split("\n") == [f"Story {k} part {j} " + " ".join([f"word{j}"] * 60) for j in range(k % 3 + 1)]


def test_classes_group_equal_vectors(spark):
    rows = [(k, f"http://h/{k}", "<body><ul>" + "<li><i>x</i>" * (k + 1) + f"</ul><p>only {k}</p></body>") for k in range(4)]
    pages = H.hosts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    tokens = {r.path: r for r in H.tokens_of(pages).collect() if r.path}
    assert tokens["body/ul/li"].vector == tokens["body/ul/li/i"].vector != tokens["body/ul"].vector == tokens["body/p"].vector
    assert (tokens["body/ul/li"].pages, tokens["body/ul/li"].total) == (4, 10)
    paths = {r.path for r in H.valid_classes(H.tokens_of(pages)).collect()}
    assert {"body", "body/ul", "body/ul/li", "body/ul/li/i"} <= paths


def one(page):
    return H.main_text(page, None, set(), set())


def test_blocks_and_references():
    assert one("<p>a &amp; b&nbsp;<b>c</b>d<br>e\n f<p>g</p>h") == "a & b cd e f\ng\nh"
    assert one("<article><h1>T</h1><nav>n</nav><p>x<aside>side</aside><div class='comments'>c</div><footer>f</footer></article><p>out") == "T\nx"
    assert one("<header>h</header><form>f</form><div class='cookie-notice'>c</div><p>x &lt;y&gt; &#233;") == "x <y> é"
    assert one("<div id='site-header'>h</div><div class='post-header'>t</div><div class='add-on'>x</div><div class='ad-slot'>y</div>") == "t\nx"
    assert one("<p>1 < 2 <!-- no <p> --> done<style>p{}</style> <script>x</p></script>end") == "1 < 2 done\nend"
    assert one("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert one("") == one("<article></article>") == ""


def test_tags_without_an_end_cut_nothing():
    assert one("<p>a</p><svg viewBox='0 0 1 1'/><p>b</p><svg><text>x</text></svg><p>c</p><math/><p>d</p>") == "a\nb\nc\nd"
    for name in ("object", "canvas", "select", "svg", "math", "template", "noscript"):
        assert one(f"<p>a</p><{name} class='k'><p>b</p><p>c</p>") == "a\nb\nc", name
        assert one(f"<p>a</p><{name}><p>b</p><{name}>x</{name}><p>c</p>") == "a\nb\nc", name
    assert one("<p>a</p><object><object>x</object>y</object><p>b</p>") == "a\nb"
    for name in ("script", "style", "textarea", "iframe"):
        assert one(f"<p>a</p><{name}><p>b</p>") == "a", name
        assert one(f"<p>a</p><{name}><p>b</p></{name}><p>c</p>") == "a\nc", name
    assert len(one("<object><p>x</p>" * 20_000)) == 39_999  # one scan, not one for each tag


def test_a_part_with_the_page_in_it_is_no_noise():
    text = "<h1>T</h1><p>" + "x " * 40 + "</p>"
    want = "T\n" + " ".join("x" * 40)
    menu = "<div class='menu'>" + "y " * 15 + "</div>"
    assert one(f"<body><form>{menu}<article>{text}</article></form></body>") == want
    assert one(f"<body><form>{menu}<div>{text}</div></form></body>") == want
    assert one(f"<body><form>{menu * 4}<article><p>short</p></article></form></body>") == "short"
    assert one(f"<body><div class='modal'><main>{text}</main>{menu}</div></body>") == want
    assert one(f"<body><div class='banner-page social'><div>{text}</div></div></body>") == want
    assert one(f"<div class='post'>{text}</div><aside class='related'><article class='card'><h3>C</h3><p>c</p></article></aside><div id='comments'>{'z ' * 200}</div>") == want


def test_names_inside_articles_are_read_as_a_whole():
    page = "<article><h1>T</h1><section id='related-work'><h2 id='menu'>Menu</h2><p>r</p></section><div class='text social-policy'>s</div>{}</article>"
    assert one(page.format("")) == "T\nMenu\nr\ns"
    for name in ("comments", "post-comments", "share-buttons", "text ad-slot", "newsletter-box", "sidebar-left"):
        assert one(page.format(f"<div class='{name}'>n</div>")) == "T\nMenu\nr\ns", name


def test_copies_keep_their_text(spark):
    story = "".join(f"<div class='{x}'><p>part {j} " + f"word{j} " * 20 + "</p></div>" for j, x in enumerate("abc"))
    rows = [(f"h{n}", f"<body><div class='top'>{story}</div></body>") for n in (3, 4, 1000) for _ in range(n)]
    rows += [("near", f"<body><div>{story}<p>seen at {k}</p></div></body>") for k in range(5)]
    rows += [("fixed", f"<body><div><p>{'own ' * 9}{k}</p><i>the same</i></div></body>") for k in range(4)] + [("fixed", "<body><div><i>the same</i></div></body>")]
    pages = spark.createDataFrame([(k, f"http://{h}/{k}", t) for k, (h, t) in enumerate(rows)], "page_id long, url string, html string")
    want = "\n".join(f"part {j} " + " ".join([f"word{j}"] * 20) for j in range(3))
    for r in H.extract(pages).collect():
        host, text = rows[r.page_id]
        end = "\nseen at " + text.split("seen at ")[1][0] if host == "near" else ""
        if host != "fixed":
            assert r.text == want + end, host
        else:
            assert ("own" in r.text) != ("the same" in r.text)


def test_text_beside_the_largest_container_stays(spark):
    page = """<body><div class="top"><a href="/">Home</a> <a href="/b">More</a></div><div class="wrap"><h1>Title {k}</h1><p class="lead">Lead {k}</p>
    <div class="story">{body}</div></div><div class="below">Fixed closing words</div></body>"""
    bodies = [f"<p>Story {k} " + "word " * (200 if k else 0) + "</p>" for k in range(6)]
    rows = [(k, f"http://site/{k}", page.format(k=k, body=b)) for k, b in enumerate(bodies)]
    for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text.split("\n")[:2] == [f"Title {r.page_id}", f"Lead {r.page_id}"]
        assert [x[:7] for x in r.text.split("\n")[2:]] == [f"Story {r.page_id}"]


def test_repeated_notices_inside_articles(spark):
    page = "<article><h1>Title {k}</h1><h2>Method</h2>{body}<p>Get our <b>letter</b> now</p><p>By <i>Writer {k}</i></p><ul><li><a href='/{k}'>Source {k}</a></ul></article>"
    rows = [(f"h{n}", page.format(k=k, body=f"<p>Story {k} {'word ' * 20}</p>" * (k + 1))) for n in (3, 5) for k in range(n)]
    pages = spark.createDataFrame([(k, f"http://{h}/{k}", t) for k, (h, t) in enumerate(rows)], "page_id long, url string, html string")
    for r in H.extract(pages).collect():
        host, k = rows[r.page_id][0], r.page_id - 3 * (r.page_id > 2)
        lines = r.text.split("\n")
        assert [x for x in lines if not x.startswith("Story")] == [f"Title {k}", "Method", "Get our letter now", f"By Writer {k}", f"Source {k}"]
        assert len([x for x in lines if x.startswith("Story")]) == k + 1


def test_shared_paragraphs_stay_and_parts_of_their_own_go(spark):
    """However many pages a host has, a repeated paragraph among an article's own is text; a notice in a part of its own is none."""
    page = "<article><h1>Title {k}</h1><div class='body'><p>All figures below are in millions of euro.</p>{own}</div><div class='x'><p>Get our <b>letter</b> now</p></div></article>"
    rows = [(n, k) for n in (3, 4, 300) for k in range(n)]
    # one page of the large host has nothing of its own beside the shared paragraph
    own = lambda n, k: "" if (n, k) == (300, 7) else f"<p>Story {k} {'word ' * 9}</p>"
    pages = spark.createDataFrame([(i, f"http://h{n}/{k}", page.format(k=k, own=own(n, k))) for i, (n, k) in enumerate(rows)], "page_id long, url string, html string")
    found = H.extract(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        n, k = rows[r.page_id]
        lines = [x for x in r.text.split("\n") if not x.startswith("Story")]
        assert lines == [f"Title {k}", "All figures below are in millions of euro.", *["Get our letter now"] * (n < H.FIXED_PAGES)]


def test_nothing_that_differs_by_page_is_gathered(spark):
    """Menus under ids of their own in every page are no set that grows with the host."""
    page = "<div id='post-{k}'><ul class='m{k}'><li><a href='/'>Home {k}</a></li></ul><article><p>Story {k}</p></article></div>"
    pages = spark.createDataFrame([(k, f"http://h/{k}", page.format(k=k)) for k in range(200)], "page_id long, url string, html string")
    (row,) = H.templates(H.hosts(pages)).collect()
    assert len(row.menus or ()) + len(row.parts or ()) + len(row.fixed or ()) <= 4
    assert [r.text for r in H.extract(pages).orderBy("page_id").collect()] == [f"Story {k}" for k in range(200)]


def test_odd_rows(spark):
    long = "<article><p>" + "word " * 300_000 + "</article>"
    rows = [
        (1, None, "<p>no url"), (2, "http://a/1", None), (3, "http://a/2", ""), (4, "x", "<article><p>q</article>"), (4, "x", "<article><p>q</article>"), (None, None, "<p>z"),
        (5, "http://a/3", long), (6, "http://a/4", '<p a="open><p>x'), (7, "http://a/5", "<" * 2_000 + "</p></b>"),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int").repartition(3)
    found = sorted(((r.page_id, r.text[:20]) for r in H.extract(pages).collect()), key=repr)
    assert [x for x in found if x[0] not in (6, 7)] == sorted([(1, "no url"), (2, ""), (3, ""), (4, "q"), (4, "q"), (None, "z"), (5, "word word word word ")], key=repr)
    assert len(found) == len(rows) and H.extract(pages.limit(0)).count() == 0
