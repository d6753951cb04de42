"""Main text of pages: against a plain parser on the given pages, and on pages of other forms."""
from html.parser import HTMLParser

import pytest
from pyspark.sql import types as T

from promolens.llm import queries
from promolens.llm.wrappers import (aligned, common, expression, main_text, merged, page_tree, wrapper_expressions,
                                    written_out)

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("HTML", T.StringType()),
                       T.StructField("host", T.LongType()), T.StructField("a.b", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, "dots") for i, u, h in rows], SCHEMA)


def extracted(spark, rows):
    return {r.page_id: r.text for r in main_text(frame(spark, rows)).collect()}


class Article(HTMLParser):
    """The blocks of the article of a well-formed page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.text = False, [], ""

    def block(self):
        if self.inside and self.text.split():
            self.blocks.append(" ".join(self.text.split()))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "h1", "p"):
            self.block()
        self.inside = self.inside or tag == "article"
        self.text += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        if tag in ("article", "h1", "p"):
            self.block()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        self.text += data if self.inside else ""


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_a_plain_parser_on_the_given_pages(spark, sf):
    folder = f"/root/testdata/{sf}"
    out = queries.op13_html_wrappers(spark, folder)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in out.collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        parser = Article()
        parser.feed(p.html)
        text = "\n".join(parser.blocks)
        assert found[p.page_id] == (p.url, text, len(text)) and text


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, text", [
    ("<article>A&amp;B&nbsp;<b>c</b>d<br>e <p>f<p>g\n h</article>", "A&B cd e\nf\ng h"),
    ("<main><nav>menu</nav><h1>T</h1><div>x<div>y</div>z</div></main><p>out</p>", "T\nx\ny\nz"),
    ("<header>h</header><p>text</p><aside>s</aside><footer>f</footer><form>name <input></form>", "text"),
    ("<article><p>a<script>if (1<2) '</p>'</script>b<style>p{}</style></p><!-- <p>no</p> --></article>", "a b"),
    ("<article><p>a</p><section class='comments'><p>me too</p></section><div id=sidebarLeft>s</div></article>", "a"),
    ("<div class='page with-sidebar'><article><p>a</p></article><div class=sidebar>s</div></div>", "a"),
    ("<article><p>one<div class=\"ad-slot\">buy</div><p>two</article><div class='cookie-notice'>ok</div>", "one\ntwo"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>unclosed", "a\nb\nc\nd\nunclosed"),
    ("<article><p>5 < 6 &lt;b&gt; &#233;&eacute; <3</p></article>", "5 < 6 <b> éé <3"),
    ("<div><p hidden>no</p><p aria-hidden='true'>no</p><div role=navigation>no</div><p>yes</p></div>", "yes"),
    ("<article><p title=\"a>b\">x</p><p title='un>closed>y</p></article>", "x\nclosed>y"),
    ("<p>a <span class=ad>buy <i>now</i></span> b</p>", "a\nb"),
    ("<svg><text>no</text></svg><template><p>no</p></template><noscript>no</noscript>plain", "plain"),
    ("<nav>only a menu</nav>", ""),
])
def test_pages_of_other_forms(body, text):
    from promolens.llm.wrappers import text_blocks
    html = page(body)
    assert "\n".join(t for _, t, _ in text_blocks(html, expression(page_tree(html)))) == text


def test_wrapper_has_optional_and_repeated_groups():
    a, b, c = (expression(page_tree(f"<div>{x}</div>")) for x in (
        "<h1>t</h1><p>1</p>", "<h1>t</h1><h2>s</h2><p>1</p><p>2</p><h2>s</h2><p>1</p>", "<h1>t</h1><img><ul><li>x</ul>"))
    both = merged(a, b)
    assert written_out(both) == "<div><h1>#</h1>(<p>#</p>)?(<h2>#</h2>(<p>#</p>)+)*</div>"
    assert written_out(b) == "<div><h1>#</h1>(<h2>#</h2>(<p>#</p>)+)+</div>"
    assert "(<ul><li>#</li></ul>)?" in written_out(merged(both, c))
    assert merged(b, b) == b


def test_a_single_stretch_becomes_the_group_of_the_other_side():
    once = expression(page_tree("<dl><dt>a</dt><dd>b</dd></dl>"))
    often = expression(page_tree("<dl>" + "<dt>a</dt><dd>b</dd>" * 3 + "</dl>"))
    assert written_out(merged(once, often)) == "<dl>(<dt>#</dt><dd>#</dd>)+</dl>"
    assert merged(once, often) == merged(often, once)


def test_longest_common_subsequence_also_of_long_sequences():
    assert common(tuple("abcbd"), tuple("bcd")) == [(1, 0), (2, 1), (4, 2)]
    long = tuple(str(i) for i in range(1200))
    assert len(common(("x", *long), long[::-1][:1] + long)) >= 1000
    assert aligned([], []) == []


def test_template_text_and_menus_go_by_the_host(spark):
    def one(i, host, own):
        return (i, f"http://{host}/{i}", page(
            f"<div><a href=/>Home {i}</a></div><div class=c><h2>Title {own}</h2><p>Text {own}</p></div>"
            "<div class=z>All rights kept</div>"))
    rows = [one(i, "big.example", i) for i in range(40)] + [one(100 + i, "copies.example", 7) for i in range(20)]
    rows += [one(200, "small.example", 1), (201, None, page("<p>no host</p>")), (202, "HTTP://Big.example/q", page(""))]
    found = extracted(spark, rows)
    assert all(found[i] == f"Title {i}\nText {i}" for i in range(40))
    # equal pages tell nothing about the template, nor does a single one
    assert all(found[100 + i] == "Title 7\nText 7\nAll rights kept" for i in range(20))
    assert found[200] == "Title 1\nText 1\nAll rights kept" and found[201] == "no host" and found[202] == ""


def test_awkward_and_empty_tables(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = page("<article>" + "".join(f"<p>paragraph {i} " + "word " * 40 + "</p>" for i in range(12_000)) + "</article>")
    rows = [(1, None, None), (2, "", ""), (3, "x", "   "), (None, "http://h/", page("<p>a</p>")),
            (4, "http://h/", "<p"), (4, "http://h/", "<p"), (5, "http://h/", page(deep)), (6, "http://h/", long),
            (7, "http://h/", "plain & simple"), (8, "http://h/", "<article><p>" + "<b" * 5000)]
    out = main_text(frame(spark, rows)).collect()
    by_id = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    assert by_id[1].text == "" and by_id[1].n_chars == 0 and by_id[5].text == "deep"
    assert by_id[6].text.count("\n") == 11_999 and by_id[6].n_chars > 2_000_000
    assert by_id[7].text == "plain & simple" and by_id[None].text == "a"
    assert main_text(frame(spark, [])).collect() == []
    assert {r.host for r in wrapper_expressions(frame(spark, rows)).collect()} == {"h", ""}
