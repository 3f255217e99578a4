from mortar.llm.wrappers import extract, match_trees, parse, skeleton, text_digest

SCHEMA = "page_id long, url string, html string"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article><h1>Head &amp; more</h1><p>One  two<br>three <b>four</b>.</p><div class="ad">Buy</div><p>&lt;five&gt; &#233;&eacute;
<ul><li>a<li>b</ul><form><input value="q">Ask</form><section id="comments"><p>reader says</p></section></article>
<footer>&copy; foot</footer></body></html>"""


def test_article_text():
    from mortar.llm.wrappers import main_text
    assert main_text(parse(PAGE), set()) == "Head & more\nOne two three four.\n<five> éé\na\nb"


def test_names_made_from_titles_stay_inside_an_article():
    from mortar.llm.wrappers import main_text
    kept = ('<h2 id="social-history">Social history</h2><section id="related-work"><p>Work</p></section>'
            '<h2 id="navigation">Navigation</h2><section id="sharing-economy"><p>Economy</p></section>'
            '<p class="notice-period">Notice</p>')
    left = ('<div class="related-posts">r</div><div class="cookieNotice">c</div><section id="comments">s</section>'
            '<div class="post-foot newsletter">n</div><h3 class="share">s</h3>')
    for root in ("article", "main"):
        page = f"<body><{root}>{kept}{left}</{root}></body>"
        assert main_text(parse(page), set()) == "Social history\nWork\nNavigation\nEconomy\nNotice"


def test_edges(spark):
    rows = [(0, "http://a/", None), (1, None, ""), (2, "x", "plain text only"), (3, "http://a/", "<p>cut off <a href='"),
            (4, "http://a/", "<script>never closed <p>x"), (5, "http://a/", "<article><p>a</article><p>b"),
            (6, "http://a/", "</div></p>stray<!-- open"), (7, "http://a/", "<p>" + "word " * 50_000),
            (8, "http://a/", "<div>" * 3000 + "deep" + "</div>" * 3000), (8, "http://a/", PAGE)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS host", "3 AS reference")
    out = sorted([(r.page_id, r.text, r.n_chars) for r in text_digest(df).collect()], key=str)
    texts = ["", "", "plain text only", "cut off", "", "a", "stray", "word " * 49_999 + "word", "deep",
             "Head & more\nOne two three four.\n<five> éé\na\nb"]
    assert out == sorted([(i, t, len(t)) for (i, _, _), t in zip(rows, texts)], key=str)
    assert text_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_template_of_pages_without_an_article(spark):
    def page(n):
        return (f"<html><body><div><p>Welcome to our site, dear reader</p></div><div><p>Text number {n} of this host</p>"
                f"<p>More of {n * 7}</p></div><div>All rights reserved by us</div></body></html>")
    rows = [(n, "http://host.example.com/%d" % n, page(n)) for n in range(8)] + [(50, "http://other/", page(99))]
    out = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[3] == "Text number 3 of this host\nMore of 21"
    assert out[50].startswith("Welcome")  # one page alone has no template


def test_template_of_a_host_with_odd_pages(spark):
    def divs(n, note="All rights reserved by us"):
        return (f"<html><body><div><p>Welcome to our site</p></div><div><p>Text {n} of this host</p></div>"
                f"<div>{note}</div></body></html>")

    def table(n):
        return f"<html><body><table><tr><td>Old menu</td></tr></table><center>Old text {n}</center></body></html>"
    empty = [(0, "http://host/0", None), (1, "http://host/1", ""), (2, "http://host/2", "gone")]
    rows = [*empty, (3, "http://host/3", "<html><body><p>404</p></body></html>"),
            *[(n, "http://host/%d" % n, divs(n)) for n in range(10, 40)], (40, "http://host/40", divs(40, "Alle Rechte")),
            *[(n, "http://host/%d" % n, table(n)) for n in range(50, 56)]]
    out = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[n] for n in range(4)] == ["", "", "gone", "404"]
    assert {out[n] for n in range(10, 40)} == {f"Text {n} of this host" for n in range(10, 40)}
    assert out[40] == "Text 40 of this host\nAlle Rechte"
    assert {out[n] for n in range(50, 56)} == {f"Old text {n}" for n in range(50, 56)}


def test_constant_boxes_inside_an_article_are_template(spark):
    def page(n, root):
        return (f"<body><{root}><h1>Title</h1><p class='by'>By our <b>desk</b></p><p>Story {n}, part <i>one</i></p>"
                f"<div><h3>Read more</h3><ul><li>Weather</li><li>Sports</li></ul></div><div><p>End of {n}</p></div></{root}></body>")
    rows = [(n, f"http://{root}/{n}", page(n, root)) for root in ("article", "main") for n in range(9)]
    rows += [(50, "http://other/", page(50, "article"))]
    found = extract(spark.createDataFrame(rows, SCHEMA)).collect()
    out = {(r.page_id, r.url): r.text for r in found}
    for root in ("article", "main"):
        for n in range(9):
            assert out[n, f"http://{root}/{n}"] == f"Title\nStory {n}, part one\nEnd of {n}"
    assert "Read more" in out[50, "http://other/"]  # one page alone has no template


def test_copies_of_an_article_stay_whole(spark):
    rows = [(n, f"http://host/{n}", f"<body><div><p>day {n}</p></div><article><h1>One</h1><p>the same story</p></article></body>")
            for n in range(9)]
    assert {r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {"One\nthe same story"}


def test_equal_articles_are_no_template(spark):
    rows = [(n, "http://host/%d" % n, "<body><nav>m</nav><article><p>the same story</p></article></body>") for n in range(9)]
    assert {r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {"the same story"}


def test_tree_matching_keeps_order():
    a = skeleton(parse("<div><p>x</p><ul><li>1</li></ul><p>y</p></div>"))
    b = skeleton(parse("<div><ul><li>2</li><li>3</li></ul><p>y</p><h2>n</h2></div>"))
    pairs = []
    assert match_trees(a, b, pairs) == 5  # root, div, ul, li, p
    assert [(x[0], y[0]) for x, y in sorted(pairs, key=lambda p: p[0][2])] == [
        (t, t) for t in ("#root", "div", "ul", "li", "p")]


def test_matching_against_the_plain_recurrence():
    import random
    made = random.Random(8)

    def tree(depth, count):
        count[0] += 1
        number = count[0]
        children = [tree(depth - 1, count) for _ in range(made.randint(0, 4))] if depth else []
        return [made.choice("pqr") if number > 1 else "root", "", number, children]

    def plain(x, y):
        if x[0] != y[0]:
            return 0
        table = [[0] * (len(y[3]) + 1) for _ in range(len(x[3]) + 1)]
        for i, m in enumerate(x[3]):
            for j, n in enumerate(y[3]):
                s = plain(m, n)
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + s)
        return table[-1][-1] + 1

    def parents(node):
        return {c[2]: node[2] for c in node[3]} | {k: v for c in node[3] for k, v in parents(c).items()}

    for _ in range(400):
        a, b, pairs = tree(4, [0]), tree(4, [0]), []
        assert match_trees(a, b, pairs) == plain(a, b) == len(pairs)
        up, over = parents(a), parents(b)
        partner = {x[2]: y[2] for x, y in pairs}
        assert all(x[0] == y[0] for x, y in pairs) and len(set(partner.values())) == len(pairs)
        assert all(partner[up[x]] == over[y] for x, y in partner.items() if x in up)
        assert [partner[x] for x in sorted(partner)] == sorted(partner.values())


def test_thousands_of_siblings_are_matched_quickly():
    import time

    def page(n, odd):
        inside = "".join(f'<div id="c{i}"><p>{i}</p>{"<ul><li>x</ul>" if i % odd == 0 else ""}</div>' for i in range(n))
        return skeleton(parse(f"<body>{inside}</body>"))
    begun = time.time()
    for a, b in ((page(10_000, 20_000), page(9_000, 20_000)), (page(4000, 7), page(4000, 5))):
        pairs = []
        assert match_trees(a, b, pairs) == len(pairs) > 8000
    assert time.time() - begun < 15


def test_whole_table_against_the_article_element(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r.page_id: r.text for r in text_digest(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x)))).strip()
                  for x in re.split("</?(?:p|h1)>", inside)]
        assert out[r.page_id] == "\n".join(b for b in blocks if b)
