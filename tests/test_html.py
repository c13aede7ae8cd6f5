import html as stdlib_html
import random


from pyspark.sql import functions as F

from dom import parse
from letbook.fixed import ROOM_DOMAIN
from letbook.functions import html as H
from letbook.operators import extract


def card(
    n=1,
    cls="listing-result",
    title="Room",
    href="/flatshare/detail.pl?flatshare_id=1",
    price="<strong>£750</strong> pcm",
    room="Double",
):
    return (
        f'<li class="{cls}"><h2 class="listing-card__title">{title}</h2>'
        f'<a class="listing-card__link" href="{href}">see</a>'
        f'<p class="listing-card__price">{price}</p>'
        f'<p class="listing-card__location">Area {n}</p>'
        f'<span class="listing-card__room">{room}</span>'
        f'<span class="listing-card__availability">Now</span></li>'
    )


def brute_cards(html):
    out = []
    for li in parse(html).find_all("li", "listing-result"):
        def text(tag, token, joiner=""):
            node = li.find(tag, token)
            return node.text(joiner) if node else None

        link = li.find("a", "listing-card__link")
        href = link.attrs.get("href") if link else None
        url = None if href is None else href if href.startswith("http") else ROOM_DOMAIN + href
        out.append(
            (
                url,
                text("h2", "listing-card__title"),
                text("p", "listing-card__price", " "),
                text("p", "listing-card__location"),
                text("span", "listing-card__room"),
                text("span", "listing-card__availability"),
            )
        )
    return out


def spark_cards(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page int, html string")
    got = extract.cards(rows, ["page"]).orderBy("page", "pos").collect()
    out = [[] for _ in pages]
    for r in got:
        out[r.page].append((r.url, r.title, r.price_text, r.location, r.room_type, r.available))
    return out


def test_cards_match_a_parser(spark):
    pages = [
        "",
        "<p>nothing</p>",
        "<ul>" + card() + "</ul>",
        "<ul>" + card(1) + "<li class='listing-result-ad'>ad</li>" + card(2) + "</ul>",
        card(cls="panel listing-result featured"),
        card(cls="my-listing-result") + card(cls="listing-result2"),
        card().replace('class="listing-result"', "class=listing-result"),
        card().replace('"', "'"),
        card().replace("<li ", "<LI ").replace("</li>", "</LI>").replace("<h2", "<H2").replace("</h2>", "</H2>"),
        card(title="  Two <b> bold </b> &amp; &lt;i&gt; &pound;5 &#8364;&#x20AC; &nope; "),
        card(href="/flatshare/detail.pl?a=1&amp;flatshare_id=77"),
        card(href="https://other.test/x?flatshare_id=5"),
        card(href=""),
        card().replace('href="/flatshare/detail.pl?flatshare_id=1"', ""),
        card(room="<span>Double</span> room <span>x<span>y</span></span> end"),
        card().replace('<span class="listing-card__room">Double</span>', ""),
        card().replace("Now", ""),
        card(price="<!-- £1 --> £2<br>pw"),
        "<!-- " + card(1) + " -->" + card(2),
        "<script>var s = '" + card(1) + "';</script>" + card(2) + "<style>li{}</style>",
        card(1) + '<p class="listing-card__price">after</p>',
        '<li class="listing-result">no parts</li><h2 class="listing-card__title">outside</h2>',
        '<li class="listing-result"><ul><li>inner</li><li>two</li></ul><h2 class="listing-card__title">T</h2></li>',
        '<li class="listing-result" data-class="x"><h2 data-class="listing-card__title">no</h2>'
        '<h2 class="listing-card__title">yes</h2></li>',
        "<ul>" + "".join(card(i, title=f"T{i}") for i in range(51)) + "</ul>",
        card(title="x" * 60_000 + " <b>" + "y " * 30_000 + "</b>"),
    ]
    for page, mine, theirs in zip(pages, spark_cards(spark, pages), [brute_cards(p) for p in pages]):
        assert mine == theirs, page[:300]


def test_random_cards_match_a_parser(spark):
    rng = random.Random(5)
    words = ["Room", "&amp;", "£9", "<b>x</b>", " ", "<br>", "&#163;", "<span>s</span>", "<em> e </em>", "é"]
    pages = []
    for _ in range(120):
        parts = []
        for n in range(rng.randint(0, 5)):
            bit = lambda: "".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
            one = card(n, rng.choice(["listing-result", "a listing-result", "listing-result-x"]), bit(), "/r?flatshare_id=%d" % n, bit(), bit())
            if rng.random() < 0.3:
                one = one.replace("<h2", "<!-- c --><h2")
            parts.append(one)
        pages.append("<ul>" + rng.choice(["", "\n", "<li>x</li>"]).join(parts) + "</ul>")
    for page, mine, theirs in zip(pages, spark_cards(spark, pages), [brute_cards(p) for p in pages]):
        assert mine == theirs, page


def test_listing_id_of_card(spark):
    pages = [
        card(href="/d?flatshare_id=12&amp;x=1"),
        card(href="/d?flatshare_id="),
        card(href="/d"),
        card(href="/d?flatshare_id=a%2Fb"),
        card().replace('href="/flatshare/detail.pl?flatshare_id=1"', ""),
    ]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").coalesce(1)
    assert [r.flatshare_id for r in extract.cards(rows, []).collect()] == ["12", None, None, "a/b", None]


def test_outer_cards_keep_empty_pages(spark):
    rows = spark.createDataFrame([(0, card(1) + card(2)), (1, "<p>"), (2, None)], "page int, html string")
    got = extract.cards(rows, ["page"], outer=True).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, r.n_items) for r in got] == [(0, 0, 2), (0, 1, 2), (1, None, 0), (2, None, 0)]


def test_card_count(apply):
    assert apply([card() * 49, card() * 50, "", None, "<!--" + card() + "-->"], extract.card_count) == [49, 50, 0, 0, 0]


def test_unescape_like_the_standard_library(apply):
    texts = ["a&amp;lt;b", "&lt;&gt;&quot;&eacute;&hellip;", "&#65;&#x1F600;&#38;amp;", "no & entity;", "&pound;5&", ""]
    assert apply(texts, H.unescape) == [stdlib_html.unescape(t) for t in texts]


def test_result_total(apply):
    def nav(inner, attrs='class="navcurrent"'):
        return f"<div><p {attrs}>{inner}</p></div>"

    pages = [
        nav("<strong>1-50</strong> of <strong>1,234</strong> results"),
        nav("<strong>1-50</strong> of <strong> 99 </strong>", "class='x navcurrent y' id=n"),
        nav("<strong>1-50</strong> of <strong>many</strong>"),
        nav("<strong>50</strong>"),
        nav("<strong>1</strong><strong>2</strong>", 'class="navcurrents"'),
        nav("<strong>1</strong><strong></strong>"),
        nav("<strong class='a'>1</strong><strong class='b'><em>7</em>,000</strong>"),
        "<p>none</p>",
        None,
    ]
    assert apply(pages, H.result_total) == [1234, 99, None, None, None, None, 7000, None, None]


def test_links(apply):
    html = (
        '<a class="propertyCard-link" href="/properties/1#/?channel=RES">a</a>'
        '<a class="x propertyCard-link y" href="/properties/1">b</a>'
        "<a href='/properties/2' class='propertyCard-link'>c</a>"
        '<a class="propertyCard-link" href="/other/3">d</a>'
        '<a class="propertyCard-link">e</a>'
        '<a class="other" href="/properties/4">f</a>'
        '<script>"/properties/5"</script>'
    )
    dom = [extract.SALE_DOMAIN + f"/properties/{n}" for n in (1, 2)]
    assert apply([html, "", None], extract.links_by_anchor) == [dom, [], None]
    raw = [extract.SALE_DOMAIN + f"/properties/{n}" for n in (1, 2, 4, 5)]
    assert apply([html, ""], extract.links_by_pattern) == [raw, []]


def test_no_python_in_extraction(spark):
    rows = spark.createDataFrame([("k", 0, None, card())], "key string, page_idx int, fetched_at timestamp, html string")
    plan = extract.room_cards(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "")


def test_any_depth_and_quotes(spark):
    """Elements nested eight deep, `>` in attributes, elements that are not closed."""
    for depth in range(1, 9):
        room = "<span>" * depth + "x" + "</span>" * depth
        got = spark_cards(spark, [f"<ul>{card(room=room)}{card(n=2)}</ul>"])[0]
        assert [c[4] for c in got] == ["x", "Double"], depth
    page = (
        '<ul><li title="a > b" class="listing-result"><h2 class="listing-card__title" data-x=\'1 > 0\'>T &apos;&check;&#146;</h2>'
        '<a title="c > d" class="listing-card__link" href="/x?a=1&copy=2&amp;b=3">see</a>'
        '<p class="listing-card__price">&pound750 <b title="p > q">pcm</b></li></ul>'
    )
    got = spark_cards(spark, [page])[0]
    assert got == [(f"{ROOM_DOMAIN}/x?a=1&copy=2&b=3", "T '✓’", "£750 pcm", None, None, None)]


def test_entities_as_the_standard_library_has_them(spark, apply):
    values = ["&amp;lt; &lt &ltx &notit; &notin; &NotEqualTilde; &#x41;&#65 &#0; &#x110000; &#99999999999; &#xD800; &#x80; &# &x; & &a"]
    values += ["&eacute;&Eacute&eacut &thetasym; &ThickSpace;&fjlig; &#13; plain", "no entity", ""]
    got = apply(values, lambda c: H.unescape(c))
    assert got == [stdlib_html.unescape(v) for v in values]


def test_quotes_that_open_no_value(spark):
    """An apostrophe inside an unquoted value, or anywhere but after an equals sign, is a character like any other."""
    pages = [
        "<li class=listing-result title=O'Brien><a class=listing-card__link data-o=it's href=/r?flatshare_id=7&q=O'B>x</a>"
        "<p class=listing-card__location title=O'Brien>Area</p></li>",
        """<li data-x="a 'b > c" class='listing-result'><a href='/r?flatshare_id=8' class="listing-card__link" x='"'>x</a>"""
        """<p title = "it's > that" class = listing-card__location>Near 'it'</p></li>""",
        """<li ' class="listing-result"><a " href="/r?flatshare_id=9" class="listing-card__link">x</a></li>""",
    ]
    given = spark.createDataFrame([(i, 0, None, p) for i, p in enumerate(pages)], "key int, page_idx int, fetched_at timestamp, html string")
    got = [(r.flatshare_id, r.location) for r in extract.room_cards(given).orderBy("postcode").collect()]
    assert got == [("7", "Area"), ("8", "Near 'it'"), ("9", None)]
    link = """<a class=propertyCard-link title=O'Brien href=/properties/5#x>p</a><a href="/properties/6" class='propertyCard-link'>q</a>"""
    rows = spark.createDataFrame([(link,)], "html string").select(extract.links_by_anchor(F.col("html")).alias("links"))
    assert [u.rsplit("/", 1)[1] for u in rows.first().links] == ["5", "6"]


def test_card_lists_are_the_cards(spark):
    """Pages that carry their cards as one JSON text give the rows that reading the markup gives."""
    pages = [f"<ul>{card()}{card(n=2, room='A &quot;q&quot; \\ é')}</ul>", "<ul><li class='listing-result'></li></ul>", "<p>none</p>", "", None]
    given = spark.createDataFrame(list(enumerate(pages)), "key int, html string")
    listed = given.select("key", extract.card_list(F.col("html"), extract.ROOM_LAYOUT).alias("c"))
    listed = listed.select("key", F.coalesce(F.size("c"), F.lit(0)).alias("n_items"), F.to_json("c").alias("cards"))
    got = extract.listed_cards(listed, "cards", extract.ROOM_LAYOUT)
    want = extract.cards(given, ["key"], outer=True)
    assert got.columns == want.columns
    order = lambda rows: sorted((tuple(r) for r in rows.collect()), key=str)
    assert order(got) == order(want)
