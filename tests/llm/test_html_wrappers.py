import pytest

from tracewell.llm import html_wrappers as h


def text_of(*pages, which=0):
    wrapper = None
    for p in pages:
        wrapper = h.merge(wrapper, h.fold(h.Page(p).root))
    return h.main_text(pages[which], wrapper, len(pages))


ARTICLE = "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><header>Site</header><div class='cookie-notice'>We use cookies</div><div class=ad>Buy</div><article><h1>Head</h1><p><b>One &amp; two&nbsp;three<br>four <a href=x>link</a>.<p>Next</p><script>var a='</p>';</script><form>mail</form><div class=comments><p>Reader</p></div></article><aside>Side</aside><footer>&copy; me</footer></body></html>"


def test_article_without_the_rest():
    assert text_of(ARTICLE) == "Head\nOne & two three four link.\nNext"


@pytest.mark.parametrize("page", [
    "<div id=content><h2>Head</h2><p>Body <i>text</i></p><ul><li>a<li>b</ul></div>",
    "<div class='main'><h2>Head</h2><p>Body text</p><ul><li>a</li><li>b</li></ul></div><div id='comments'>no</div>",
    "<table><tr><td>Head<tr><td>Body text<tr><td>a<tr><td>b</table>",
])
def test_other_layouts(page):
    assert text_of(page) == "Head\nBody text\na\nb"


def test_text_that_a_hosts_pages_share_is_template():
    pages = [f"<body><div class=top>Welcome</div><div class=c><p>Story {k}</p><p>More {k}</p></div><ul><li><a href=1>x{k}</a><li><a href=2>y{k}</a></ul></body>" for k in range(5)]
    assert text_of(*pages, which=3) == "Story 3\nMore 3"


def test_wrapper_is_a_union_free_expression():
    wrapper = h.merge(h.fold(h.Page("<p>a</p><p>b</p><hr><div>x</div>").root), h.fold(h.Page("<p>c</p><table><tr><td>1</td></tr></table><div>y</div>").root))
    assert h.expression(wrapper) == "(<p>#text</p>)+(<table><tr><td>#text</td></tr></table>)?<div>#text</div>"
    again = h.merge(wrapper, h.fold(h.Page("<p>c</p><div>z</div>").root))
    assert h.expression(again) == h.expression(wrapper)


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("   \n", ""), ("plain < 5 & more", "plain < 5 & more"), ("<div>" * 4000 + "deep" + "</div>" * 10, "deep"), ("<!-- open <p>x", ""), ("<p>a</b></p></div>b", "a\nb"), ("<script>x", ""), ('<p title="a>b">c', "c"), ("<p class='x>y", "y"), ("a" * 200_000, "a" * 200_000)])
def test_odd_pages(spark, page, text):
    df = spark.createDataFrame([(1, None, page, "w", 1)], "page_id bigint, url string, html string, wrapper string, pages int")
    (r,) = h.extracted(df).collect()
    assert (r.page_id, r.url, r.text, r.n_chars) == (1, None, text, len(text))


def test_hosts_have_their_own_wrappers(spark):
    rows = [(k, f"http://u@{'A' if k % 2 else 'b'}.net:80/{k}?q", f"<div>{'Shared' if k % 2 else k}</div><p>own {k}</p>") for k in range(12)] + [(3, "http://a.net/3", "<div>Shared</div><p>own 3</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = sorted((r.page_id, r.text) for r in h.extracted(df).collect())
    assert got == sorted((k, f"own {k}" if k % 2 else f"{k}\nown {k}") for k, _, _ in rows)
    assert {(r.host, r.pages) for r in h.infer(df).collect()} == {("a.net", 7), ("b.net", 6)}
    assert h.extracted(df.limit(0)).collect() == []


def test_copies_do_not_outvote_their_own_text(spark):
    copy, other = "<div id=content><h2>T</h2><p>Body</p></div>", "<div id=content><h2>T</h2><p>Else {}</p></div>"
    rows = [(k, "http://c.net/", copy) for k in range(3)] + [(10 + k, "http://d.net/", copy) for k in range(5)] + [(20 + k, "http://d.net/", other.format(k)) for k in range(3)]
    got = {r.page_id: r.text for r in h.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {k: "T\nBody" for k in range(3)} | {10 + k: "Body" for k in range(5)} | {20 + k: f"Else {k}" for k in range(3)}


def test_only_shared_text_is_template():
    one_offs = ["<div class=a>First</div>", "<table><tr><td>Second</table>", "<section>Third</section>"]
    assert [text_of(*one_offs, which=k) for k in range(3)] == ["First", "Second", "Third"]
    mostly = [f"<div>{'Welcome' if k else 'Own'}</div><p>Story {k}</p>" for k in range(6)]
    assert text_of(*mostly) == "Own\nStory 0" and text_of(*mostly, which=2) == "Story 2"
    alike = [f"<!-- {k} --><div><h2>T</h2><p>Body</p></div>" for k in range(3)]
    assert text_of(*alike) == "T\nBody"


def test_deep_pages_keep_their_article_and_lose_their_menus(spark):
    deep = "<div id=page><article><p>Start</p>" + "<div>" * 3000 + "deep<nav>menu</nav><div class=comments>reader</div>" + "</div>" * 3000 + "<p>End</p></article><p>Side</p></div>"
    rows = [(k, "http://e.net/", deep.replace("deep", f"deep {k}")) for k in range(3)]
    got = {r.page_id: r.text for r in h.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    assert got == {k: f"Start\ndeep {k}\nEnd" for k in range(3)}
    wrapper = h.merge(h.fold(h.Page(ARTICLE).root), h.fold(h.Page("<p>a<p>b<hr><div>x</div>").root))
    assert h.unpacked(h.packed(wrapper)) == wrapper


def test_slots_decide_inside_an_article_too():
    box = "<div class=x1>Join our club</div>"
    links = "<ul><li><a href=1>more {0}</a><li><a href=2>and {0}</a></ul>"
    pages = [f"<article><h1>Head {k}</h1>{box}<p>Story {k} with a <a href=1>link</a></p>{links.format(k)}</article>" for k in range(4)]
    assert text_of(*pages, which=2) == "Head 2\nStory 2 with a link"
    own = pages[:3] + [f"<article><h1>Head 3</h1><div class=x1>Own box</div><p>Story 3</p></article>"]
    assert text_of(*own, which=3) == "Head 3\nOwn box\nStory 3"
    assert text_of(pages[0]) == "Head 0\nJoin our club\nStory 0 with a link\nmore 0\nand 0"
    alike = [f"<!-- {k} --><article><p>Same</p></article>" for k in range(3)]
    assert text_of(*alike) == "Same"


def test_repeated_sequences_and_wide_lists_stay_small():
    page = "<article>" + "".join(f"<h2>Head {k}</h2><p>Text {k}</p>" for k in range(10_000)) + "</article>"
    wrapper = h.merge(h.fold(h.Page(page).root), h.fold(h.Page("<article><h2>One</h2><p>Only</p></article>").root))
    assert h.expression(wrapper) == "<article>(<h2>#text</h2><p>#text</p>)+</article>"
    assert h.main_text(page, wrapper, 2).count("\n") == 19_999
    mixed = "<article>" + "".join(f"<{x}>t{k}</{x}>" for k in range(300) for x in ("p", "ul", "pre")[k % 7 % 3 : k % 5 % 3 + 1]) + "</article>"
    wrapper = h.merge(h.merge(None, h.fold(h.Page(mixed).root)), h.fold(h.Page("<article><p>a</p><h2>b</h2></article>").root))
    assert len(h.packed(wrapper)) < 1000
    assert h.main_text("<article><p>a</p><h2>b</h2></article>", wrapper, 2) == "a\nb"
    assert h.main_text(mixed, wrapper, 2).split() == [f"t{k}" for k in range(300) for _ in ("p", "ul", "pre")[k % 7 % 3 : k % 5 % 3 + 1]]


def test_own_ids_and_classes_do_not_let_a_wrapper_grow():
    def page(k):
        return f"<div id=post-{k}-{'ab' * k}><article class='post p{k}'><h1>Head {k}</h1><p>Story {k}</p></article></div>"

    wrapper = None
    for k in range(300):
        wrapper = h.merge(wrapper, h.fold(h.Page(page(k)).root))
    assert len(h.packed(wrapper)) < 400
    slugs = None
    for k in range(500):
        slugs = h.merge(slugs, h.fold(h.Page(f"<div class=own{'ab' * k}>Menu {k}</div><article>Story {k}</article>").root))
    assert len(h.packed(slugs)) < 20_000
    assert h.main_text("<div class=ownab>Menu 1</div><article>Story 1</article>", slugs, 500) == "Story 1"


def test_text_comes_through_the_wrapper():
    page = "<article><h1>Head</h1><p>Body</p></article>"
    assert text_of(page) == "Head\nBody"
    assert h.main_text(page, h.merge(None, h.fold(h.Page("").root)), 1) == ""


def test_attributes_are_matched_whole():
    assert text_of("<article><p data-id='comments'>Stays</p><p id=comments>Goes</p><p aria-role=x class = 'Comment'>Goes too</p></article>") == "Stays"


def test_near_copies_of_an_article_keep_their_text():
    pages = [f"<!-- {k} --><article><h1>Same head</h1><p>The same long story</p><div class=x1>{'Own' if k else 'Else'}</div></article>" for k in range(4)]
    assert text_of(*pages, which=2) == "Same head\nThe same long story\nOwn"


def test_unclosed_tags_take_linear_time():
    import time

    began = time.perf_counter()
    for page in ("<a" * 200_000, "<a '\">" * 30_000, "<script>" + "</script" * 50_000, "<svg>" * 20_000, "<!-" * 100_000):
        h.Page(page)
    assert time.perf_counter() - began < 20


def test_articles_against_an_independent_reader(spark):
    """The standard library's parser over the given pages: text of the article, a line a block."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.skip, self.inside = [""], [], 0

        def handle_starttag(self, tag, attrs):
            kinds = dict(attrs).get("class") or ""
            if tag == "article":
                self.inside += 1
            if self.skip or tag in ("nav", "aside", "form", "script", "style") or any(k in ("comments", "ad", "cookie") for k in kinds.split()):
                self.skip += [tag] if tag not in ("br", "input", "img", "hr") else []
            if tag == "br":
                self.out[-1] += " "
            elif tag not in ("b", "i", "a", "em", "strong", "span"):
                self.out.append("")

        def handle_endtag(self, tag):
            if tag == "article":
                self.inside -= 1
            if self.skip and tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            if tag not in ("b", "i", "a", "em", "strong", "span", "br"):
                self.out.append("")

        def handle_data(self, data):
            if self.inside and not self.skip:
                self.out[-1] += data

    def plain(source):
        r = Reader()
        r.feed(source or "")
        r.close()
        return "\n".join(t for t in (" ".join(x.split()) for x in r.out) if t)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in h.extracted(pages).collect()}
    assert len(want) > 100 and got == want


def test_shared_headings_and_quotations_of_articles_stay():
    pages = [f"<article><h1>Title {k}</h1><h2>Summary</h2><p>Story number {k} is told here.</p><blockquote>Shared quotation of a classic.</blockquote><p>End of {k}.</p></article>" for k in range(5)]
    assert text_of(*pages, which=3) == "Title 3\nSummary\nStory number 3 is told here.\nShared quotation of a classic.\nEnd of 3."


def test_names_count_whole():
    kept = [("p", "social-policy"), ("div", "side-effects"), ("p", "search-history"), ("div", "related-work"), ("p", "promo-1"), ("section", "comment-theory")]
    gone = [("div", "cookie-banner"), ("div", "site-footer"), ("section", "comment-list"), ("div", "related-posts"), ("ul", "share-buttons"), ("div", "ad"), ("div", "ad-slot")]
    body = "".join(f"<{n} class={c}>Text of {c}</{n}>" for n, c in kept + gone)
    pages = [f"<article><h1>T {k}</h1><p>Own words {k}.</p>{body.replace('Text of', f'Text {k} of')}</article>" for k in range(4)]
    assert text_of(*pages, which=1) == "\n".join(["T 1", "Own words 1.", *[f"Text 1 of {c}" for _, c in kept]])


def test_tags_of_any_length_and_open_quotes():
    long = "data:x,>" * 20_000
    assert text_of(f'<article><p>One</p><img src="{long}"><p title="{long}">Two</p></article>') == "One\nTwo"
    open_quote = '<article><p>One</p><a href="x>two</a>' + "<b c='d>three</b> " * 5000 + "</article>"
    assert text_of(open_quote).startswith("One\ntwo")
