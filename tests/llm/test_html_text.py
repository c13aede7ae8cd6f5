"""The extraction beside a plain parser, its scan beside all regions, and pages of many shapes."""

from html.parser import HTMLParser

import pytest
from hypothesis import given
from hypothesis import strategies as st
from letbook.llm import html_text as T
from letbook.llm.queries import op12_html

BLOCKS = {"p", "h1", "h2", "article", "div", "section", "ul", "li"}


class Plain(HTMLParser):
    """Blocks inside article elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in BLOCKS:
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def plain(page):
    parser = Plain()
    parser.feed(page or "")
    parser.close()
    return "\n".join(x for x in (" ".join(b.split()) for b in parser.blocks) if x)


def test_table(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op12_html(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for row in got:
        page = pages[row["page_id"]]
        assert row["text"] == plain(page["html"]) and row["n_chars"] == len(row["text"]) and row["url"] == page["url"]
        assert row["text"]


WORDS = " ".join(f"word{i}" for i in range(30))
AROUND = (
    '<header><a href="/">Site name</a></header><nav><ul><li><a href="/x">Menu</a></ul></nav>'
    '<div class="cookie-notice">We use cookies <button>OK</button></div><form action="/s"><input name=q>Search here</form>'
    "<script>var a = '<p>no text</p>';</script><style>p{}</style><noscript>Enable scripts</noscript>"
)
AFTER = (
    '<aside>Of the side</aside><div id="comments"><h3>Comments</h3><p>' + WORDS + '</p></div><section class="related-posts"><p>More</p></section>'
    '<div class="ad">Buy this</div><footer>&copy; us</footer>'
)


@pytest.mark.parametrize(
    "content",
    [
        "<article>%s</article>",
        "<main><article>%s</article></main>",
        "<main>%s</main>",
        '<div class="content">%s</div>',
        '<div id="page-wrapper"><div class="post">%s</div></div>',
        "<table><tr><td>%s</td></tr></table>",
    ],
)
def test_only_the_article(content):
    body = f"<h1>A &amp; title</h1>\n<p>First <b>bold</b>\n\n words&nbsp;of it.<p>{WORDS}<ul><li>One<li>Two</ul><div class='ad'>Ad</div><p>End.</p>"
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body class='has-sidebar'>{AROUND}{content % body}{AFTER}</body></html>"
    assert T.main_text(page, T.Weights()) == f"A & title\nFirst bold words of it.\n{WORDS}\nOne\nTwo\nEnd."


def test_regions_without_a_mark_follow_the_tags():
    weights = T.Weights({"p": 90, "h1": 20}, {"a": 300, "li": 300, "ul": 60, "div": 60})
    links = "<ul>" + "".join(f"<li><a href=/{i}>Go to {i}</a></li>" for i in range(20)) + "</ul>"
    page = f"<body>{links}<h1>Head line</h1><p>{WORDS}</p><p>{WORDS}</p>{links}</body>"
    assert T.main_text(page, weights) == f"Head line\n{WORDS}\n{WORDS}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("no markup at all", "no markup at all"),
        ("<article>never closed &lt;p&gt; &#233;&hellip; &unknown; &am", "never closed <p> é… &unknown; &am"),
        ("<article>a < b > c<p title=O'Brien>Area</p><p title=\"x > y\">more</p>", "a < b > c\nArea\nmore"),
        ("<article>x<!-- <p>no</p> -->y<br>z<!-- open <p>no</p>", "xy z"),
        ("<article>kept<script>if (a</script>er<SCRIPT>x</Script >end<style>open", "kepterend"),
        ("<article>cut in a tag <p cla", "cut in a tag"),
        ("<article><p>a</b></i></div>b</p></article>", "ab"),
        ("<head><title>T</title><body><p>no end of head</p>", "no end of head"),
        ("<article><header><h1>Title</h1><p>By someone</p></header><p>Text</p><footer>About</footer></article>", "Title\nText"),
        ('<article class="comment">Reader</article><article>Text of it</article>', "Text of it"),
        ('<article><p>A</p><div hidden>no</div><p style="display: none">no</p><span role="navigation">no</span><p>B</p></article>', "A\nB"),
    ],
)
def test_cases(page, text):
    assert T.main_text(page, T.Weights()) == text


def test_hostile_pages_take_no_time():
    for page in ("<b>" * 100_000 + "x" + "</i>" * 100_000, "<a " * 100_000, '<a x="' * 50_000 + ">", "<!--" * 100_000, "<script>" * 50_000, "<div><p>" * 50_000 + "y", "</" * 100_000):
        T.main_text(page, T.Weights())


@given(st.lists(st.integers(-5, 5), max_size=12))
def test_scan(values):
    low, high = T.best_region([float(v) for v in values])
    sums = [sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)]
    assert sum(values[low:high]) == max([0, *sums])


def test_fit_reads_the_labels(spark):
    rows = [(f"<body><ul><li><a>m</a></ul><article><h1>t</h1><p>{WORDS}</p></article></body>",)] * 30 + [(None,), ("<p>no mark</p>",)]
    weights = T.fit(spark.createDataFrame(rows, "html string"))
    assert weights.tag("p") > weights.tag("section") > weights.tag("li") and weights.inside["p"] == 30
    assert weights.factor == T.USUAL
    nothing = T.fit(spark.createDataFrame([("<p>x</p>",)], "html string"))
    assert nothing.inside == {} and 0 > nothing.tag("p") > nothing.tag("li")


def test_rows(spark, tmp_path):
    rows = [(1, None, None, 5, 6), (1, None, None, 5, 6), (None, "u", "<article>x " + "y " * 200_000 + "</article>", 7, 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r["page_id"], r["text"][:3], r["n_chars"]) for r in op12_html(spark, str(tmp_path)).collect()}
    assert got == {(1, "", 0), (None, "x y", 400_001)}
    pages.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/empty/pages.parquet")
    assert op12_html(spark, f"{tmp_path}/empty").columns == ["page_id", "url", "text", "n_chars"]
    assert op12_html(spark, f"{tmp_path}/empty").count() == 0
