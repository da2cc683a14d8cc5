import random

from clickloom.llm.page_difference import main_texts, page_lines, shared_lines


def test_article_without_template_parts():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">X</a></ul></nav>
    <div class="cookie-notice">We use <b>cookies</b></div><!-- <p>no</p> -->
    <article><h1>Head &amp; <i>tail</i></h1><p>One<br>two <span class="ad">buy</span> three
    <p>1 &lt; 2 &copy; &#x41;&#66; a < b</p><aside><p>aside</p></aside><p class="advert">gone<p>kept</p>
    <form><input name="q">Search</form><div><div>inner</div>after</div>
    <section id="comments"><p>nice</p></section><ul><li>x<li>y</ul></article>
    <div class="sidebar">side</div><footer>&copy; me</footer></body></html>"""
    article, loose, has = page_lines(page)
    assert has and loose == []
    assert article == ["Head & tail", "One two three", "1 < 2 © AB a < b", "kept", "inner", "after", "x", "y"]


def test_broken_pages():
    assert page_lines("") == ([], [], False)
    assert page_lines("plain text") == ([], ["plain text"], False)
    assert page_lines("<article><p>open")[0] == ["open"]
    assert page_lines("<nav><li>menu<article><p>text</article>")[0] == ["text"]
    assert page_lines('<p title="a>b">x</p><p title="broken>y</p>')[1][0] == "x"
    assert page_lines("<script>never closed <p>x</p>") == ([], [], False)
    assert page_lines("a<")[1] == ["a<"]


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randrange(9))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(9))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        shared = shared_lines(a, b)
        assert len(shared) == best[-1][-1]
        line = iter(b)
        assert all(any(x == y for y in line) for x in (a[k] for k in sorted(shared)))


def test_open_lines_shared_with_the_nearest_page_go(spark):
    page = "<div>Menu</div><div>{}</div><div>Copyright</div>"
    rows = [(1, "http://a.org/x/1", page.format("first"), 0), (2, "http://a.org/x/2", page.format("second"), 0),
            (3, "http://b.org/x/1", page.format("alone"), 0), (4, None, page.format("none"), 0),
            (5, "http://c.org/", None, 0), (6, "http://c.org/", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.page_id: r.text for r in main_texts(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {1: "first", 2: "second", 3: "Menu\nalone\nCopyright", 4: "Menu\nnone\nCopyright", 5: "", 6: ""}
    assert main_texts(df.limit(0)).count() == 0


def test_given_pages_keep_exactly_their_article(spark, sf_dir):
    import html
    import re
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = main_texts(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2)>", inner)
        wanted = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
        assert r.text == "\n".join(filter(None, wanted))
        assert r.n_chars == len(r.text)


def test_copies_keep_their_text_wherever_the_order_is_cut(spark):
    page = "<div>Menu</div><div>{}</div><div>Copyright</div>"
    rows = [(1, "http://a.org/x/1", page.format("first")), (2, "http://a.org/x/2?x=1", page.format("copied")),
            (3, "http://a.org/x/2?x=2", page.format("copied")), (3, "http://a.org/x/2?x=2", page.format("copied")),
            (9, "http://c.org/1", page.format("only")), (10, "http://c.org/1?a", page.format("only"))]
    rows += [(20 + k, f"http://b.org/{k:03}", page.format("many" if 5 < k < 40 else f"b{k}")) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    wanted = {1: "first", 2: "copied", 3: "copied", 9: "Menu\nonly\nCopyright", 10: "Menu\nonly\nCopyright"}
    wanted.update({20 + k: "many" if 5 < k < 40 else f"b{k}" for k in range(60)})
    old = spark.conf.get("spark.sql.adaptive.enabled")
    for cuts in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", cuts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            got = main_texts(df).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.enabled", old)
        assert len(got) == len(rows)
        assert {r.page_id: r.text for r in got} == wanted


def test_open_lines_of_pages_with_an_article_are_aligned(spark):
    page = "<div>Menu</div><p>{0} body</p><article>teaser {0}</article><p>{0} end</p><div>Copyright</div>"
    rows = [(k, f"http://a.org/{k}", page.format(k)) for k in (1, 2)]
    got = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"{k} body\nteaser {k}\n{k} end" for k in (1, 2)}
