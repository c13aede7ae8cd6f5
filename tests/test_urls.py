from urllib.parse import parse_qs, urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from letbook.fixed import ROOM_DOMAIN
from letbook.functions import urls as U


def expected(url, name="id"):
    return parse_qs(urlparse(url).query).get(name, [None])[0]


def test_query_param(apply):
    urls = [
        "https://x.test/a?id=17&b=2",
        "/a?b=2&id=17#id=9",
        "/a?id=&id=18",
        "/a?id=",
        "/a?xid=3",
        "/a?id=a%20b%26c+d",
        "/a?b=1?id=3&id=4",
        "/a",
        "/a#?id=5",
        "",
    ]
    assert apply(urls, lambda c: U.query_param(c, "id")) == [expected(u) for u in urls]
    assert apply([None, "/a?id=%zz"], lambda c: U.query_param(c, "id")) == [None, "%zz"]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("id=&?#ab%20+", max_size=25), min_size=5, max_size=40))
def test_query_param_like_the_standard_library(apply, tails):
    urls = ["https://x.test/p" + t for t in tails]
    got = apply(urls, lambda c: U.query_param(c, "id"))
    for url, value in zip(urls, got):
        want = expected(url)
        if want is None or ("%" not in url and "�" not in want):
            assert value == want, url


def test_absolute(apply):
    assert apply(["http://a/b", "/c", "", None], lambda c: U.absolute(c, "D")) == ["http://a/b", "D/c", "D", None]


def test_without_fragment(apply):
    hrefs = ["/properties/1#/?x#y", "/properties/2", "#a"]
    assert apply(hrefs, lambda c: U.without_fragment(c, "D")) == ["D/properties/1", "D/properties/2", "D"]


def test_location_id(apply):
    assert apply(["12", "7.0", "x", None], U.location_id) == ["OUTCODE^12", "OUTCODE^7", None, None]


def test_room_search_url(spark):
    row = spark.range(1).select(U.room_search_url(F.lit("SW1 A"), F.lit(50)).alias("u")).first()
    assert row.u == (
        f"{ROOM_DOMAIN}/flatshare/search.pl?action=search&flatshare_type=offered&search=SW1+A&max_per_page=50&offset=50"
    )
