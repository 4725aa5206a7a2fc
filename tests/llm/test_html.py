from textflow.llm.html_extract import GOOD, extract, label_blocks
from textflow.llm.queries import REGISTRY

LONG = ("The river was high and the people of the town had gone to the bridge "
        "to see what it would do to the old mill. ") * 2


def _text(html):
    return "\n".join(b.text for b in label_blocks(html) if b.label == GOOD)


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>
    <script>var t="</p><p>no";</script></head><body>
    <header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies and that is a long notice of it
    with the and of to in a that for it was on are as with be by</div>
    <article><header><h1>Tom &amp; Caf&eacute; &#39;x&#x27;</h1></header>
    <p>{LONG}<p>Short.<p>a<br>b&nbsp; c</p>
    <form><input><p>{LONG}</p></form><aside>{LONG}</aside>
    <div class="ad">Buy</div><p hidden>secret</p>
    <section id="comments"><p>{LONG}</p></section></article>
    <div id="sidebar"><p>{LONG}</p></div><footer>&copy; {LONG}</footer>"""
    assert _text(page) == "\n".join([
        "Tom & Café 'x'", " ".join(LONG.split()), "Short.", "a b c"])


def test_rules_without_an_article_element():
    junk = "alpha beta gamma delta " * 8
    page = (f"<div>Start</div><div><a href=1>{LONG}</a></div><h2>Title</h2>"
            f"<p>{LONG}</p><p>Short one.</p><p>{LONG}</p><p>{junk}</p>"
            "<div>Short tail</div>")
    body = " ".join(LONG.split())
    assert _text(page) == "\n".join(["Title", body, "Short one.", body])


def test_broken_markup_and_nothing():
    assert _text("") == "" and _text("<p><b>x</i></p") is not None
    assert _text("<article><p>5 &lt; 6 and <b>7 > 3</article>"
                 ) == "5 < 6 and 7 > 3"


def test_edge_rows_and_clashing_columns(spark):
    rows = [(1, None, "n"), (2, "", "n"), (None, f"<p>{LONG}</p>", "n"),
            (3, "<article>" + "<p>word of the day</p>" * 20_000, "n"),
            (3, "<article>x</article>", "n"), (3, "<article>x</article>", "n")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract(df).collect()
    assert len(got) == 6 and all(r.row.text == "n" for r in got)
    by = {(r.row.page_id, r.row.html): r for r in got}
    assert by[1, None].text == "" and by[1, None].n_chars == 0
    assert by[3, rows[3][1]].text.count("\n") == 19_999
    assert by[3, "<article>x</article>"].text == "x"
    assert extract(df.filter("page_id < 0")).count() == 0


def test_registered_query_gives_the_articles(spark):
    import html
    import re
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(
        f"{sf}/pages.parquet").collect()}
    got = REGISTRY["op6_html_extract"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        a = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html,
                      re.S)[1]
        parts = [" ".join(html.unescape(re.sub(
            r"<[^>]*>", "", p.replace("<br>", " "))).split())
            for p in re.split(r"</?(?:p|h1|div)[^>]*>", a)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
