import html
import re

from pixelflow.llm import host_paths as H

SCHEMA = "page_id bigint, url string, html string"


def article(page):
    """The article of the test pages, by plain string work."""
    x = page[page.find("<article>") + 9:]
    end = x.find("</article>")
    x = re.sub(r"<[^>]*$", "", x[:end] if end >= 0 else x)
    parts = [re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", y) for y in re.split(r"</?(?:p|h1)>", x)]
    return "\n\n".join(z for z in (" ".join(html.unescape(y).split()) for y in parts) if z)


def test_pages_of_the_table(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = H.extract(p, ("page_id", "url", "html")).collect()
    assert len(rows) == p.count()
    assert all(r.text == article(r.html) for r in rows)


def own(page):
    p = H.Page(page)
    return p.text((p.name(p.container()[0]),))


def test_parts_that_are_not_the_article():
    body = "<p>First of all &amp; good.</p><p>Second   one<br>goes on.</p>"
    extra = ("<nav><a href=/>Home</a></nav><header>Site</header><aside>More</aside><form>Mail <input></form><div class='ad'>Buy</div>"
             "<div class='cookie-notice'>Cookies</div><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->"
             "<div id=comments><p>Nice page</p></div><section class='sidebar'>Links</section><div style='display: none'>x</div>")
    want = "T\n\nFirst of all & good.\n\nSecond one goes on."
    assert own(f"<html><body>{extra}<article><h1>T</h1>{body}{extra}</article><footer>F</footer></body></html>") == want
    assert own(f"<body>{extra}<div class=content><h1>T</h1>{body}{extra}</div><footer>F</footer>") == want
    assert own("<main><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table><pre>x\n y</pre></main>") == "a\n\nb\n\n1 2\n\n3\n\nx y"


def test_class_words_do_not_drop_the_article():
    body = "<h1>T</h1><p>First of all, good news came.</p><p>Second one goes on for a while.</p>"
    want = "T\n\nFirst of all, good news came.\n\nSecond one goes on for a while."
    side = "<div class='sidebar'><p>More to read</p></div><div id=comments><p>Nice page</p></div>"
    for start, end in (("<article class='post has-comments'>", "</article>"), ("<div class='content with-sidebar'>", "</div>"),
                       ("<main class=no-sidebar>", "</main>"), ("<div class=elementor-widget-container>", "</div>"),
                       ("<article class='post related share'>", "</article>"), ("<div class='story widget'>", "</div>"),
                       ("<div id=social-story><div class=in>", "</div></div>")):
        assert own(f"<body>{side}{start}{body}{end}{side}</body>") == want, start
        assert own(f"<body>{start}{body}{side}{end}</body>") == want, start
    assert own("<p>See the <a class=related-link href=x>other page</a> and <span class=share>this</span> too.</p><p><a class=share>Share</a></p>"
               ) == "See the other page and this too."
    long = "<div class=comments>" + "<p>A reader has much to say about this.</p>" * 20 + "</div>"
    assert own(f"<body><div class=post>{body}</div>{long}</body>") == want
    assert own(f"<body><article class=post>{body}</article>{long.replace('<p>', '<article class=comment><p>')}</body>") == want


def test_headline_and_lead_beside_the_body(spark):
    lead, para = "What the story says in short, for a start.", "The long text of the story goes here, with all it has to say. "
    menu = "<div class=top><a href=/>Home</a> <a href=/a>All news</a> <a href=/b>Old news</a></div>"
    low = "<div class=low><p>\u00a9 2024 Example. All rights reserved.</p></div>"
    text = f"<div class=text><p>{para * 4}</p><p>{para * 4}</p></div>"
    body = "\n\n".join([(para * 4).strip()] * 2)
    for parts, head in ((f"<h1>A headline</h1>{text}", "A headline"), (f"<div class=lead><p>{lead}</p></div>{text}", lead),
                        (f"<h1>A headline</h1><div class=lead>{lead}</div><div class=entry>{text}</div>", f"A headline\n\n{lead}"),
                        (f"<div class=head><h1>A headline</h1></div><div class=a><p>{lead}</p><div class=b>{text}</div></div>",
                         f"A headline\n\n{lead}"), (f"<div class=list><a href=/c>{lead}</a></div>{text}", None)):
        page = f"<body>{menu}<div class=post>{parts}</div>{low}</body>"
        assert own(page) == (f"{head}\n\n{body}" if head else body), parts
    pages = [(i, f"https://host.example/{i}", f"<body>{menu}<div class=post><h1>No {i}</h1>{text}</div>{low}</body>") for i in range(4)]
    assert all(r.text == f"No {r.page_id}\n\n{body}" for r in H.extract(spark.createDataFrame(pages, SCHEMA)).collect())


def test_odd_pages():
    for page, want in (("", ""), ("<", "<"), ("<p title='x>y'>t</p>", "t"), ("plain <b>bold</b> &lt;x&gt;", "plain bold <x>"),
                       ("<article>cut off <b>he", "cut off he"), ("<article>cut off</artic", "cut off"), ("<!-- never closed <p>x", ""),
                       ("<script>never closed <p>x", ""), ("</p></div>x", "x"), ("<P>A</P><DIV>B</DIV>", "A\n\nB"), ("a &am", "a &am")):
        assert own(page) == want, page
    assert own("<div>" * 20000 + "deep") == "deep"
    assert own("<p>" + "word " * 50000).count("word") == 50000


def test_the_host_votes(spark):
    good = "<body><div class='box1'>{0}</div><div class='story-{1}'><p>{2}</p></div></body>"
    rows = [(i, f"https://Host.example/{i}", good.format("menu of links", i, "The long text of the story goes here. " * 5)) for i in range(5)]
    # on its own this page would name the other box
    rows.append((9, "https://host.example/9", good.format("A very long box that is not the story at all, " * 9, 9, "Short story.")))
    rows += [(10, None, "<body><p>no url</p>"), (11, "nonsense", None), (11, "nonsense", None), (None, "https://x.example", "<p>x</p>")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r._host for r in H.winners(H.votes(df)).collect()} == {"host.example", "", "x.example"}
    got = [(r.page_id, r.text) for r in H.extract(df).collect()]
    assert len(got) == len(rows)
    assert dict(got)[9] == "Short story." and dict(got)[10] == "no url" and dict(got)[11] == "" and dict(got)[None] == "x"
    assert H.extract(df.limit(0)).count() == 0
    extra = df.selectExpr("*", "1 as text", "2 as path", "3 as _host", "4 as _path", "5 as length")
    assert sorted(map(str, H.extract(extra).collect())) == sorted(map(str, H.extract(df).collect()))
