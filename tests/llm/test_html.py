from tallyloom.llm.html_text import extract, main_text

LONG = "A sentence of the article, long enough, with commas, to count as text."


def test_parts_that_go():
    page = f"""<html><head><title>no</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body>
    <header><a href=/>no</a></header><nav><ul><li>no</li></ul></nav><div class="cookie-notice">no, really no, no</div>
    <!-- no --><div class="ad">no</div><main><h1>Title &amp; more</h1><p>{LONG}<p>Second&nbsp; one<br>x, {LONG}
    <div class="sidebar"><p>{LONG} no</p></div><ul><li>item</ul><form><p>no</p></form></main>
    <section id="comments"><p>{LONG} no</p></section><footer>no</footer>"""
    assert main_text(page) == f"Title & more {LONG} Second one x, {LONG} item"


def test_best_container_without_marks():
    page = f"<body><div><a href=x>one</a> <a href=y>two</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=z>{LONG}</a></div>"
    assert main_text(page) == f"{LONG} {LONG}"


def test_odd_input():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<!-- never closed") == ""
    assert main_text("plain &lt;text&gt;") == "plain <text>"
    assert main_text("<p>a < b <b>bo</b>ld &#233;&euro;</p>") == "a < b bold é€"
    assert main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert len(main_text("<article>" + f"<p>{LONG}" * 20_000)) == 20_000 * (len(LONG) + 1) - 1
    assert main_text("<div " + "x='" * 2000 + ">t") is not None


def test_column(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", "old"), (None, None, None, None), (1, "u", "<p>a", "old")],
                               "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in extract(df).collect()]
    assert got == [(1, "u", "a", 1), (None, None, "", 0), (1, "u", "a", 1)]
    assert extract(df.limit(0)).count() == 0


def test_the_article_keeps_its_linked_lists_formulas_and_byline():
    page = f"""<article><h1>Title</h1><p class="byline">By A. Writer</p><p>{LONG}</p><ul><li><a href=a>First source</a></li>
    <li><a href=b>Second source</a></li></ul><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>
    <noscript><p>Shown without scripts.</p></noscript><section class="legal"><p>{LONG}</p></section>
    <ul class="menu"><li><a href=c>no</a></li></ul></article><nav><ul><li><a href=d>no</a></li></ul></nav>"""
    want = f"Title By A. Writer {LONG} First source Second source {LONG} x=2 Shown without scripts. {LONG}"
    assert main_text(page) == want


def test_time_is_proportional_to_nesting_and_tags():
    import time

    def took(page):
        t = time.process_time()
        main_text(page)
        return time.process_time() - t

    for make in (lambda n: "<div>" * n + f"<p>{LONG}", lambda n: "<div>" * n + "</section>" * n + LONG,
                 lambda n: "<b hidden>x" * n, lambda n: "<div>" * n + "<p>a" * n, lambda n: "<li><div>" * n + "</ul>" * n,
                 lambda n: "<td><div>" * n + "<tr>" * n, lambda n: "<div>" * n + "<header>" * n):
        small, large = (min(took(make(n)) for _ in range(2)) for n in (5_000, 50_000))
        assert large < 25 * small + 0.2
    assert main_text("<div>" * 100_000 + LONG) == LONG
