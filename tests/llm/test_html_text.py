import re

from ratelens.llm import html_text, queries

LONG = "These are the words of a paragraph that is long enough to look like content. " * 3


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
      <header><h1>Site</h1><nav><a href=/a>Menu</a></nav></header>
      <div class="cookie-notice">We use cookies, {LONG}</div><div id="ad-top">Buy {LONG}</div>
      <main><article><header><h1>T&eacute;tle &amp; more</h1></header>
      <p>{LONG}</p><p>short</p><p>a<br>b  <b>bold</b>\n c&nbsp;d</p>
      <form><label>Name</label><input></form><script>var x = "</p>";</script>
      <section class="comments"><p>{LONG}</p></section></article></main>
      <aside>{LONG}</aside><footer>&copy; {LONG}</footer></body></html>"""
    assert html_text.extract(page) == "\n".join(
        ["Tétle & more", LONG.strip(), "short", "a b bold c d"])


def test_page_without_an_article_element():
    page = (f'<body><div class=menu><a href=1>a</a></div><div><p>{LONG}</p><p>short</p></div>'
            '<div><a href=x>more</a> <a href=y>links</a> <a href=z>here</a></div></body>')
    assert html_text.extract(page) == f"{LONG.strip()}\nshort"


def test_comments_and_hidden_parts_of_an_article():
    page = (f'<main><div class="post-header"><h1>Title</h1></div><p>{LONG}</p>'
            f'<article class="comment"><p>{LONG}</p></article><p style="display: none">x</p>'
            f'<p hidden>y</p><div role="complementary">{LONG}</div><nav>z</nav></main>')
    assert html_text.extract(page) == f"Title\n{LONG.strip()}"


def test_names_are_hints_not_verdicts():
    text = f"{LONG.strip()}\n{LONG.strip()}"
    paragraphs = f"<p>{LONG}</p><p>{LONG}</p>"
    assert html_text.extract(f'<body><div class="content with-sidebar">{paragraphs}</div></body>') == text
    assert html_text.extract(f'<div id="main" class="post no-comments">{paragraphs}</div>') == text
    assert html_text.extract(f"<body><form action=/x>{paragraphs}<input></form></body>") == text
    assert html_text.extract(f"<form><nav>Menu</nav><article>{paragraphs}</article></form>") == text
    assert html_text.extract(f'<article><p>{LONG}</p><section id="related-work"><p>{LONG}</p></section></article>') == text


def test_boxes_that_names_and_contents_speak_against():
    article = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    text = f"{LONG.strip()}\n{LONG.strip()}"
    for box in ('<div class="sidebar">{}</div>', '<div class="promo-box"><p>{}</p></div>', '<section id=comments>{}</section>',
                '<div class="related"><a href=x>{}</a></div>', "<form><label>{}</label></form>",
                '<div class="cookie-notice">{}</div>', '<div role="alert">{}</div>'):
        own = box.format("Some words of a box, not long.")
        assert html_text.extract(f"<body>{own}{article}{own}</body>") == text
        inside = article.replace("</article>", f"{own}</article>")
        assert html_text.extract(f"<body>{inside}</body>") == text
    # however long they are, comments are no article
    comments = f'<div class="comments">{f"<p>{LONG}</p>" * 9}</div>'
    assert html_text.extract(f"<div><p>{LONG}</p></div>{comments}") == LONG.strip()


def test_the_ratio_decides_without_an_article_element():
    body = f"<div><h1>A title</h1><p>{LONG}</p><p>short one</p></div>"
    text = f"A title\n{LONG.strip()}\nshort one"
    assert html_text.extract(f"<body><div>Buy one, get one now</div>{body}<div><a href=1>more</a></div></body>") == text
    parts = f"<div><div><h2>Start</h2><p>{LONG}</p></div>{body}</div>"
    assert html_text.extract(f"<body>{parts}<div>Bye</div></body>") == f"Start\n{LONG.strip()}\n{text}"


def test_given_pages_without_names(sf_dir):
    import pyarrow.parquet as pq
    exact = total = 0
    for page in pq.read_table(f"{sf_dir}/pages.parquet", columns=["html"]).column(0).to_pylist():
        bare = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", re.sub(r'\s(?:class|id|role)="[^"]*"', "", page))
        want, got = html_text.extract(page), html_text.extract(bare)
        exact += got == want
        total += 1
        assert set(want.split("\n")) <= set(got.split("\n"))  # nothing is lost
    assert exact >= 0.95 * total


def test_a_very_long_page():
    many = 20000
    page = "<body><nav>x</nav><div>" + f"<p>{LONG}</p>" * many + "</div></body>"
    assert html_text.extract(page).count("\n") == many - 1


def test_odd_markup():
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<p>") == ""
    assert html_text.extract("just text") == "just text"
    assert html_text.extract("<article><p><b>one<br><p>two</p></article></div></p>") == "one\ntwo"
    assert html_text.extract(f'<div class="ad">x<article><p>{LONG}</article>') == LONG.strip()
    assert html_text.extract("<article>&lt;b&gt; &#233; &bogus;</article>") == "<b> é &bogus;"


def test_given_pages_keep_their_article(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op7_html_text(spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    from html import unescape
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        want = [" ".join(unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        assert r["text"] == "\n".join(x for x in want if x)
        assert r["n_chars"] == len(r["text"])


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>hi", "x"), (3, "u", "<p>hi", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extract_text(df)
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in out.collect()) == [
        (1, "", 0), (2, "", 0), (3, "hi", 2), (3, "hi", 2)]
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert html_text.extract_text(df.limit(0)).count() == 0
