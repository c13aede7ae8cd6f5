"""Whole runs against the same run written out in plain Python on parsed pages."""

import datetime as dt
import json
import random
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from dom import parse
from letbook.fixed import ROOM_DOMAIN, SALE_DOMAIN
from letbook.operators import paging
from letbook.plans.rooms import room_run, room_stream
from letbook.plans.sales import collected_links, sale_run, urls_to_fetch
from letbook.schemas import PAGES, ROOM_LISTINGS
from letbook.sources.ledgers import read_ledger
from letbook.sources.pages import stream_pages
from test_html import card
from test_model import FULL, changed, page
from test_paging import walk

AT = dt.datetime(2024, 5, 1)
RULES = paging.SeriesRules(3, empty_first_ends=True, missing_later_ends=False)


def room_pages(seed):
    rng = random.Random(seed)
    out = []
    for k in range(40):
        n_pages = 1 if k % 4 == 0 else 5
        for p in range(n_pages):
            status = rng.choice([200] * 10 + [0, 503])
            n = rng.choice([0, 1] + [3] * 10)
            cards = []
            for c in range(n):
                no = rng.randrange(12)
                href = rng.choice([f"/r?flatshare_id={no}", f"/r?flatshare_id={no}&amp;x={c}", f"/r?x={no}"])
                cards.append(card(c, title=f"K{k} {no} {c}", href=href))
            html = f"<ul>{''.join(cards)}</ul>" if n or rng.random() < 0.5 else "<p>none</p>"
            at = AT + dt.timedelta(minutes=k, seconds=p)
            out.append((f"P{k}", "search", None, p, p * 3, status, html, at))
    return out


def brute_run(pages):
    """The same run on parsed pages: rows, outcome per location, repeats, cards with a new URL."""
    rows, outcomes, dropped, total = [], {}, 0, 0
    for key in {p[0] for p in pages}:
        series = {}
        for _, _, _, idx, _, status, html, at in (p for p in pages if p[0] == key):
            lis = parse(html).find_all("li", "listing-result") if status == 200 else None
            series[idx] = (status, lis, at)
        steps = [(i, len(lis or []), lis is not None, status) for i, (status, lis, _) in series.items()]
        seen, _ = walk(steps, RULES)
        status = next((series[i][0] for i in reversed(seen) if series[i][0]), 200)
        outcomes[key] = "completed" if series[0][1] is not None and status == 200 else "failed"

        by_url = {}
        for i in seen:
            _, lis, at = series[i]
            for li in lis or []:
                href = li.find("a", "listing-card__link").attrs["href"]
                by_url.setdefault(ROOM_DOMAIN + href, (li.find("h2").text(), at))
        by_id = {}
        for url, (title, at) in by_url.items():
            number = parse_qs(urlparse(url).query).get("flatshare_id")
            if number:
                by_id.setdefault(number[0], []).append((key, url, title, status, at))
        rows += [found[0] for found in by_id.values()]
        dropped += sum(len(found) - 1 for found in by_id.values())
        total += len(by_url)
    return sorted(rows), outcomes, dropped, total


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_room_run(spark, seed):
    pages = room_pages(seed)
    given = spark.createDataFrame(pages, PAGES).repartition(5)
    run = room_run(given, "r1", F.lit(AT), rules=RULES)
    rows, outcomes, dropped, total = brute_run(pages)
    got = sorted((r.postcode, r.url, r.title, r.status, r.scraped_at) for r in run.rows.collect())
    assert got == rows and len(rows) > 20
    assert {r.key: r.status for r in run.events.collect()} == outcomes
    failed = sum(v == "failed" for v in outcomes.values())
    assert tuple(run.summary.first()) == (len(outcomes), total, dropped, failed)


def test_room_stream(spark, tmp_path):
    """Two days of pages: what the first wrote is not written again, ledgers add up."""
    inbox, rows_path, ledger_path, checkpoint = (str(tmp_path / p) for p in ("in", "rows", "ledger", "cp"))
    one = [("P1", "search", None, 0, 0, 200, card(href="/r?flatshare_id=1") + card(href="/r?flatshare_id=2"), AT)]
    two = [
        ("P1", "search", None, 0, 0, 200, card(href="/r?flatshare_id=2&amp;x=9") + card(href="/r?flatshare_id=3"), AT),
        ("P2", "search", None, 0, 0, 200, card(href="/r?flatshare_id=2"), AT),
        ("P3", "search", None, 0, 0, 503, None, AT),
    ]
    for day, pages in (("d1", one), ("d2", two)):
        spark.createDataFrame(pages, PAGES).coalesce(1).write.mode("append").parquet(inbox)
        room_stream(stream_pages(spark, inbox), rows_path, ledger_path, checkpoint, day, F.lit(AT))
    rows = spark.read.schema(ROOM_LISTINGS).parquet(rows_path).collect()
    assert sorted((r.postcode, r.url.rsplit("/", 1)[1]) for r in rows) == [
        ("P1", "r?flatshare_id=1"), ("P1", "r?flatshare_id=2"), ("P1", "r?flatshare_id=3"), ("P2", "r?flatshare_id=2"),
    ]
    events = read_ledger(spark, ledger_path).collect()
    assert sorted((r.key, r.run_id, r.status) for r in events) == [
        ("P1", "d1", "completed"), ("P1", "d2", "completed"), ("P2", "d2", "completed"), ("P3", "d2", "failed"),
    ]


def test_sale_links(spark):
    def html(numbers):
        return "".join(f'<a class="propertyCard-link" href="/properties/{n}#x">p</a>' for n in numbers)

    full = list(range(24))
    pages = [
        ("a", 0, 200, html(full)), ("a", 1, 200, html([24, 24, 25])), ("a", 2, 200, html([99])),
        ("b", 0, 0, None), ("b", 0, 200, html([1, 2])),
        ("c", 0, 200, ""), ("c", 1, 200, html([7])),
        ("d", 0, 200, html(range(100, 124))), ("d", 1, 503, None), ("d", 2, 200, html([98])),
    ]
    given = spark.createDataFrame(
        [(k, "search", None, p, p * 24, s, h, AT) for k, p, s, h in pages], PAGES
    )
    links = collected_links(given)
    got = {}
    for r in links.collect():
        got.setdefault(r.key, set()).add(int(r.url.rsplit("/", 1)[1]))
    assert got == {"a": set(range(26)), "b": {1, 2}, "c": {7}, "d": set(range(100, 124))}
    known = spark.createDataFrame([(f"{SALE_DOMAIN}/properties/1",), ("old",)], "url string")
    assert urls_to_fetch(links, known).count() == 26 + 24 + 1


def test_sale_run_takes_the_attempt_that_counts(spark):
    good = page(json.dumps(FULL))
    other = page(json.dumps(changed("propertyData.bedrooms", 9)))
    details = spark.createDataFrame(
        [
            ("u1", 1, 200, good), ("u2", 1, 503, None), ("u2", 2, 200, other), ("u3", 1, 0, None), ("u3", 2, 404, "x"),
            ("u4", 1, 200, "<html>"),
        ],
        "url string, pass_no int, http_status int, html string",
    ).withColumn("fetched_at", F.lit(AT))
    got = {r.url: r for r in sale_run(details).collect()}
    assert {u: (r.status, r.bedrooms) for u, r in got.items()} == {
        "u1": ("200", 3), "u2": ("200", 9), "u3": ("404", None), "u4": ("200", None),
    }
    assert got["u3"].address == "" and got["u1"].address == "1 High St" and got["u1"].scraped_at == AT


def test_a_page_fetched_again_counts_once(spark):
    """Cards come from the chosen fetch of a page only: one with items, then the latest."""
    def fetch(titles, minute):
        cards = "".join(card(i, title=t, href=f"/r?flatshare_id={t}") for i, t in enumerate(titles))
        return ("P", "search", None, 0, 0, 200, f"<ul>{cards}</ul>", AT + dt.timedelta(minutes=minute))

    pages = spark.createDataFrame([fetch(["1", "2"], 0), fetch(["3"], 1)], PAGES)
    run = room_run(pages, "r", F.lit(AT), rules=RULES)
    assert [r["title"] for r in run.rows.collect()] == ["3"]
    assert run.summary.first()["total_rows"] == 1


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_room_stream_does_not_depend_on_batches(spark, tmp_path, files):
    """A location's pages in files of their own, in any order, give what one run over all of them gives."""
    inbox, rows_path, ledger_path, checkpoint = (str(tmp_path / p) for p in ("in", "rows", "ledger", "cp"))

    def page(key, idx, titles, status=200):
        cards = "".join(card(i, title=t, href=f"/r?flatshare_id={t}") for i, t in enumerate(titles))
        return (key, "search", None, idx, 0, status, f"<ul>{cards}</ul>" if status == 200 else None, AT)

    n = paging.ROOM_SERIES.page_size
    pages = [
        page("P1", 2, ["beyond"]),
        page("P1", 0, [f"a{i}" for i in range(n)]),
        page("P1", 1, ["short"]),
        page("P2", 1, [], 503),
        page("P2", 0, [f"b{i}" for i in range(n)]),
    ]
    for p in pages:
        spark.createDataFrame([p], PAGES).coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):  # the second finds nothing new and changes nothing
        room_stream(stream_pages(spark, inbox, files), rows_path, ledger_path, checkpoint, "r", F.lit(AT))
    run = room_run(spark.createDataFrame(pages, PAGES), "r", F.lit(AT))
    facts = lambda rows: sorted((r.postcode, r.url, r.status) for r in rows)
    assert facts(spark.read.schema(ROOM_LISTINGS).parquet(rows_path).collect()) == facts(run.rows.collect())
    events = sorted((r.key, r.status) for r in read_ledger(spark, ledger_path).collect())
    assert events == [("P1", "completed"), ("P2", "failed")]
