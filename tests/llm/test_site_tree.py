import html
import math
import re
from collections import Counter

from campuslens.llm import site_tree as S
from campuslens.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">Cookies!</div><main><article><header><h1>Title &amp; more</h1></header>
<p>First <b>bold</b>   text<br>next&nbsp;line &lt;tag&gt; &#x41;&#66; &copy;
<p class=lead>Second, without end<div>Third</div>tail
<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>
<form><p>Send</p><input value="v"></form><div id="ad-1">Buy</div>
<section class="comments"><article><p>Reader says</p></article></section></article>
<aside>Side</aside></main><div>Outside</div><footer>&copy; me</footer></body></html>"""


def texts(page):
    """What a page keeps when the tree knows no other page."""
    return [b.text for b in S.parse(page)[0] if b.state != S.DROP and sum(S.weights(b)) >= S.LEAST]


def test_markup_rules():
    assert texts(PAGE) == ["Title & more", "First bold text next line <tag> AB ©", "Second, without end", "Third", "tail",
                           "one", "two", "a", "b"]


def test_broken_pages():
    assert texts("<p>One<p>Two<!-- open") == ["One", "Two"]
    assert texts("<article><p>Cut &am") == ["Cut &am"]
    assert texts("</p></div>plain < text & more <") == ["plain < text & more <"]
    assert texts("<article><script>never closed <p>x") == [] and texts("") == [] and texts("<") == ["<"]
    assert texts("<article><p>a</p></article><p>b</p><article><p>c</p></article>") == ["a", "c"]


def test_names_and_forms_around_the_content():
    story = "<article><h1>Title</h1><p>Long story</p><div class=share>Share it</div></article>"
    for wrap in ("<div class='content has-sidebar'>{}</div>", "<div id='login-page'>{}</div>", "<div class=banner-layout>{}</div>",
                 "<form action=x>{}</form>", "<form><div class=social-post>{}</div></form>", "<div role=form>{}</div>"):
        for around in ("{}", "<main>{}</main>"):
            page = around.format(wrap.format(story) + "<div class=sidebar>Links</div>") + "<div>Outside</div>"
            assert texts(page) == ["Title", "Long story"], page
    assert texts(f"<form>{story}<div class=comments><article>Reader says a lot more than the story</article></div></form>") == [
        "Title", "Long story"]
    assert texts("<div class=social-post><article>One</article></div><div class=social-post><article>Two</article></div>") == [
        "One", "Two"]
    assert texts("<div class=no-sidebar><main>Text</main></div>") == ["Text"]
    assert texts("<div id=login-page><p>All the text of a page</p></div><div class=ad>Buy</div>") == [
        "All the text of a page"]
    assert texts("<article><div class=social-post>All the text</div></article>") == ["All the text"]
    assert texts("<article><p>Said <span class=ad>buy</span> once</p></article>") == ["Said once"]


def test_text_of_main_around_an_article():
    assert texts("<main><h1>Title</h1><article><p>Story</p></article><p>After</p></main><p>Outside</p>") == [
        "Title", "Story", "After"]
    assert texts("<main><p>The text of the page</p><article>Teaser</article><div class=related>More</div></main>") == [
        "The text of the page", "Teaser"]


def test_entropy_decides_where_markup_does_not(spark):
    rows = [(i, f"http://Site.example/{i}",
             f"<body><div class=top>Welcome to the site</div><div class=x><p>Story {i} begins here</p><p>and ends {i * 7}</p></div>"
             f"<div class=low>All rights reserved</div></body>", "q") for i in range(40)]
    rows += [(100 + i, "http://one.example/", "<div>Lonely page</div>", "q") for i in range(3)]
    rows += [(200, None, None, None), (201, "http://[bad", "", "q"), (None, "x", "<article>" + "<p>long text</p>" * 20000, "q")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = {r["page_id"]: r for r in S.main_text(pages).collect()}
    assert len(got) == 46
    for i in range(40):
        assert got[i]["text"] == f"Story {i} begins here\nand ends {i * 7}"
    assert all(got[100 + i]["text"] == "Lonely page" for i in range(3))
    assert (got[200]["text"], got[200]["n_chars"], got[201]["text"]) == ("", 0, "")
    assert got[None]["n_chars"] == 20000 * 10 - 1
    assert S.main_text(pages.limit(0)).count() == 0


def test_attributes_are_read_as_html_reads_them():
    assert texts("<article><div title='the hidden valley'><p>In the valley</p></div><p hidden>no</p></article>") == ["In the valley"]
    assert texts("<article><p data-x=it's>Hello world. It isn't lost.</p></article>") == ["Hello world. It isn't lost."]
    assert texts("<article><p title='a > b' class=\"x\">One</p><p a=\"1\"b='2'>Two</p></article>") == ["One", "Two"]
    assert texts("<article><p HIDDEN=''>no</p><p title=x hidden>no</p><p data-hidden>yes</p></article>") == ["yes"]


def test_names_that_say_noise_in_part_exclude_nothing():
    page = ("<article><h2 id='comments-on-war'>On war</h2><p id='ad-astra'>To the stars</p><div class='social history'>Ages</div>"
            "<div class='ad'>Buy</div><div class='ad-box top-ads'>Buy</div><section class='comments-area'>Says one</section></article>")
    assert texts(page) == ["On war", "To the stars", "Ages"]
    weak = {b.text: b.weak for b in S.parse(page)[0]}
    assert weak["On war"] and weak["Ages"] and not weak["Buy"]
    wrapped = S.parse("<div class='content has-sidebar'><article><p>Free of it</p></article></div>")[0]
    assert [b.weak for b in wrapped] == [False]


def brute_importances(pages):
    """Of every block, by the definition, host by host."""
    hosts = {}
    for url, page in pages:
        blocks, children = S.parse(page)
        live = [b for b in blocks if b.state != S.DROP]
        article = "\n".join(b.text for b in live if b.depth == 2)
        hosts.setdefault(S.host_of(url), {})[page] = (live, children, article)
    out = {}
    for host, own in hosts.items():
        for page, (live, _, _) in own.items():
            for b in live:
                of = lambda x, p, art: art if x.depth == 2 else p
                having = {of(x, p, art) for p, (xs, _, art) in own.items() for x in xs if x.path == b.path}
                same = {of(x, p, art) for p, (xs, _, art) in own.items() for x in xs
                        if (x.path, x.text) == (b.path, b.text)}
                shown = [c[b.parent] for _, c, _ in own.values() if b.parent in c]
                shape = 1.0
                if len(shown) > 1:
                    shape = -sum(n / len(shown) * math.log(n / len(shown)) for n in Counter(shown).values()) / math.log(len(shown))
                text = 1 - math.log(len(same)) / math.log(len(having) + S.PRIOR)
                out[host, b.path, b.text] = (1 - S.GAMMA) * shape + S.GAMMA * text
    return out


def test_importances_by_their_definition(spark):
    given = [(r["url"], r["html"]) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(40).collect()]
    made = [(f"http://a.example/{i}", f"<body><div class=m>Menu {i % 3}</div><article><h1>T{i % 5}</h1><p>Body {i % 5}</p>"
                                      f"<p>Thanks for reading</p>{'<ul><li>x</ul>' * (i % 2)}</article></body>") for i in range(30)]
    rows = given + made + made[:4]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    got = {(r["host"], r["path"], r["feature"]): r["importance"] for r in S.importances(S.hashed(pages)).collect()}
    want = {(h, S._long(p), S._long(t)): v for (h, p, t), v in brute_importances(rows).items()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_the_tree_decides_inside_articles(spark):
    page = ("<body><nav>Menu {i}</nav><article><h1>Title {i}</h1><p>Story {i}</p><p>Thanks for reading us</p>"
            "<div class='related stories'>{more}</div></article></body>")
    rows = [(i, f"http://a.example/{i}", page.format(i=i, more="See all stories" if i % 2 else f"Also {i}")) for i in range(60)]
    rows += [(100 + i, f"http://a.example/c{i}", rows[7][2].replace("Menu 7", f"Menu c{i}")) for i in range(50)]  # copies
    got = {r["page_id"]: r["text"] for r in
           S.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert got[4] == "Title 4\nStory 4\nAlso 4" and got[5] == "Title 5\nStory 5"
    assert all(got[100 + i] == got[7] == "Title 7\nStory 7" for i in range(50))


def test_deep_pages(spark):
    deep = "<div>" * 3000 + "<p>Deep</p>" + "</div>" * 3000
    assert texts(deep) == ["Deep"]


def test_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op7_main_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]]["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert r["text"] == want and r["n_chars"] == len(want) and r["url"] == pages[r["page_id"]]["url"]
