import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from letbook.operators import paging

SCHEMA = "key string, page_idx int, n_items int, has_html boolean, http_status int"


def walk(pages, rules):
    """Page by page, as a collector goes: which pages it sees and which give items."""
    seen, kept = [], []
    for idx, n, html, _ in sorted(pages):
        n = n if html else 0
        seen.append(idx)
        if n:
            kept.append(idx)
        if n == rules.page_size or (n > rules.page_size):
            continue
        if idx == 0:
            if n or rules.empty_first_ends:
                break
        elif html or rules.missing_later_ends:
            break
    return seen, kept


RULES = {
    "rooms": paging.ROOM_SERIES,
    "sales": paging.SALE_SERIES,
    "first": paging.SALE_SERIES_FIRST_ONLY,
}


@pytest.mark.parametrize("name", RULES)
def test_series_like_walking_them(spark, name):
    rules, rng = RULES[name], random.Random(name)
    full = rules.page_size
    series = {}
    for k in range(150):
        n_pages = rng.choice([0, 1, 2, 3, 6]) if k else 400
        series[f"k{k}"] = [
            (i, rng.choice([0, 1, full - 1, full, full, full, full]) if k else full, rng.random() < 0.8, rng.choice([200, 200, 0, 404]))
            for i in range(n_pages)
        ]
    rows = spark.createDataFrame([(k, *p) for k, ps in series.items() for p in ps], SCHEMA)
    got = paging.visited(rows, rules, ["key"])
    want_seen = {(k, i) for k, ps in series.items() for i in walk(ps, rules)[0]}
    want_kept = {(k, i) for k, ps in series.items() for i in walk(ps, rules)[1]}
    assert sorted((r.key, r.page_idx) for r in got.collect()) == sorted(want_seen)
    kept = paging.truncate(rows, rules, ["key"]).collect()
    assert sorted((r.key, r.page_idx) for r in kept) == sorted(want_kept)
    assert set(kept[0].asDict()) == set(rows.columns)


@pytest.mark.parametrize(
    "items, kept",
    [([49], [0]), ([50, 0], [0]), ([50, 51, 49, 50], [0, 1, 2]), ([0, 50], []), ([50, 50], [0, 1])],
)
def test_room_boundaries(spark, items, kept):
    rows = spark.createDataFrame([("k", i, n, True, 200) for i, n in enumerate(items)], SCHEMA)
    got = paging.truncate(rows, paging.ROOM_SERIES, ["key"]).orderBy("page_idx").collect()
    assert [r.page_idx for r in got] == kept


def test_null_key_is_a_key(spark):
    rows = spark.createDataFrame([(None, 0, 50, True, 200), (None, 1, 3, True, 200), (None, 2, 3, True, 200)], SCHEMA)
    assert paging.truncate(rows, paging.ROOM_SERIES, ["key"]).count() == 2


def test_page_count(apply):
    totals = [0, None, 1, 50, 51, 100, 1234, -5]
    assert apply(totals, paging.page_count, "bigint") == [30, 30, 1, 1, 2, 2, 25, 1]


def test_page_plan(spark):
    rows = spark.createDataFrame([("a", 101), ("b", None)], "key string, total int")
    plan = paging.room_page_plan(rows, F.col("total"))
    got = [(r.page_idx, r.offset) for r in plan.where("key = 'a'").orderBy("page_idx").collect()]
    assert got == [(0, 0), (1, 50), (2, 100)]
    assert plan.where("key = 'b'").count() == 30
    sales = paging.sale_page_plan(rows).where("key = 'a'")
    assert sales.count() == 50 and sales.agg(F.max("offset")).first()[0] == 49 * 24


def test_last_status(spark):
    rows = spark.createDataFrame(
        [
            ("a", 0, 50, True, 200), ("a", 1, 0, False, 503), ("a", 2, 0, False, 0),
            ("b", 0, 0, False, 0),
            ("c", 0, 0, False, 404),
            ("d", 0, 5, True, 200), ("d", 1, 0, False, None),
        ],
        SCHEMA,
    )
    got = {r.key: (r.status, r.first_html) for r in paging.last_status(rows, ["key"]).collect()}
    assert got == {"a": (503, True), "b": (200, False), "c": (404, False), "d": (200, True)}
    items = rows.select("key", "page_idx")
    tagged = paging.tag_status(items, rows, ["key"]).collect()
    assert len(tagged) == 7 and all(r.status == got[r.key][0] for r in tagged)


def test_settle_fetches(spark):
    at = dt.datetime(2024, 5, 1)
    rows = spark.createDataFrame(
        [("a", 0, 0, at.replace(hour=9)), ("a", 0, 5, at.replace(hour=1)), ("a", 0, 7, at), ("b", 0, 0, at)],
        "key string, page_idx int, n_items int, fetched_at timestamp",
    )
    got = {(r.key, r.page_idx): r.n_items for r in paging.settle_fetches(rows, ["key"]).collect()}
    assert got == {("a", 0): 5, ("b", 0): 0}
