"""Ledger and retry operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from letbook.operators import ledger, retry
from letbook.schemas import LEDGER

SOURCE = "s"
T1, T2, T3 = (dt.datetime(2024, 5, d) for d in (1, 2, 3))


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([(k, i) for i, k in enumerate("DCBA")], "key string, position int")


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [
            ("s", "A", "failed", "r1", T1), ("s", "A", "completed", "r2", T2),
            ("s", "B", "completed", "r1", T1), ("s", "B", "failed", "r2", T3),
            ("s", "C", "failed", "r1", T1), ("s", "C", "failed", "r1", T1),
        ],
        LEDGER,
    )


def keys(rows):
    return sorted(r.key for r in rows.collect())


def test_states(events):
    assert {r.key: r.status for r in ledger.current(events).collect()} == {"A": "completed", "B": "failed", "C": "failed"}
    assert [r.key for r in ledger.sorted_completed(events).collect()] == ["A", "B"]
    assert keys(ledger.failed(events)) == ["B", "C"]


def test_remaining(places, events):
    left = ledger.remaining(places, ledger.completed(events))
    assert [r.key for r in left.orderBy("position").collect()] == ["D", "C"]
    assert keys(ledger.remaining(places, ledger.completed(events.limit(0)))) == list("ABCD")


def test_limit_comes_before_done(places, events):
    first = ledger.first_items(places, 3)
    assert keys(ledger.remaining(first, ledger.completed(events))) == ["C", "D"]
    assert ledger.first_items(places, 0).count() == ledger.first_items(places, None).count() == 4


def test_work_list(places, events):
    assert keys(ledger.work_list(places, events, SOURCE)) == ["C", "D"]
    assert keys(ledger.work_list(places, events, SOURCE, retry_failed=True)) == ["B", "C"]
    none_failed = events.where("status = 'completed'")
    assert keys(ledger.work_list(places, none_failed, SOURCE, retry_failed=True)) == ["C", "D"]


def test_sources_are_apart(spark, places, events):
    other = spark.createDataFrame([("other", k, "completed", "r1", T3) for k in "ABCD"], LEDGER)
    both = events.unionByName(other)
    assert keys(ledger.work_list(places, both, SOURCE)) == ["C", "D"]
    assert keys(ledger.work_list(places, both, SOURCE, retry_failed=True)) == ["B", "C"]
    assert keys(ledger.work_list(places, both, "other")) == []
    assert [tuple(r) for r in ledger.sorted_completed(both).collect()] == [
        *[("other", k) for k in "ABCD"], ("s", "A"), ("s", "B"),
    ]
    named = places.withColumn("source", F.lit("s"))
    assert keys(ledger.remaining(named, ledger.completed(both))) == ["C", "D"]


def test_attempts_of_one_pass(spark):
    rows = [("u", 1, "503", 1), ("u", 1, "404", 3), ("u", 1, "429", 2)]
    for order in (rows, rows[::-1]):
        got = retry.resolve_attempts(spark.createDataFrame(order, "url string, pass_no int, http_status string, attempt int"))
        assert got.first().http_status == "404"


def test_outcomes(spark):
    pages = spark.createDataFrame(
        [
            ("ok", 0, 50, True, 200), ("ok", 1, 2, True, 200),
            ("empty", 0, 0, True, 200),
            ("dead", 0, 0, False, 0),
            ("gone", 0, 0, False, 404),
            ("late", 0, 50, True, 200), ("late", 1, 0, False, 503),
        ],
        "key string, page_idx int, n_items int, has_html boolean, http_status int",
    )
    got = {r.key: r.status for r in ledger.room_outcomes(pages, ["key"]).collect()}
    assert got == {"ok": "completed", "empty": "completed", "dead": "failed", "gone": "failed", "late": "failed"}
    assert {r.status for r in ledger.sale_outcomes(pages, ["key"]).collect()} == {"completed"}
    event = ledger.to_events(ledger.room_outcomes(pages, ["key"]), "s", "key", "r1", F.lit(T1))
    assert event.schema.simpleString() == spark.createDataFrame([], LEDGER).schema.simpleString()


@pytest.fixture(scope="module")
def attempts(spark):
    return spark.createDataFrame(
        [
            ("u1", 1, "200"),
            ("u2", 1, "fail"), ("u2", 2, "200"),
            ("u3", 1, "503"), ("u3", 2, "429"), ("u3", 3, "404"),
            ("u4", 1, "500"), ("u4", 2, None), ("u4", 3, "200"),
            ("u5", 1, "0"), ("u5", 2, "404"),
        ],
        "url string, pass_no int, http_status string",
    )


def urls(rows):
    return sorted(r.url for r in rows.collect())


def test_retry_sets(attempts):
    first, second, third = (set(urls(retry.retry_set(attempts, n))) for n in (1, 2, 3))
    assert first == {"u2", "u3", "u4", "u5"} and second == {"u3", "u4", "u5"} and third == {"u3"}
    assert third <= second <= first
    assert urls(retry.final_failures(attempts)) == ["u3"]


def test_number_statuses(spark):
    rows = spark.createDataFrame([("u1", 1, 200), ("u2", 1, 404), ("u3", 1, None)], "url string, pass_no int, http_status bigint")
    assert urls(retry.retry_set(rows, 1)) == ["u2", "u3"]


def test_resolve(attempts):
    got = {r.url: (r.pass_no, r.http_status) for r in retry.resolve_attempts(attempts).collect()}
    assert got == {"u1": (1, "200"), "u2": (2, "200"), "u3": (3, "404"), "u4": (3, "200"), "u5": (2, "404")}


def test_failure_classes(attempts, apply):
    statuses = ["200", "429", "503", "404", "500", "fail", "0", None]
    assert apply(statuses, retry.failure_class) == [
        "ok", "throttled", "throttled", "http_error", "http_error", "network", "network", "network",
    ]
    got = retry.failure_classes(attempts).agg(F.sum("attempts")).first()[0]
    assert got == attempts.count()


def test_run_summary(attempts):
    assert tuple(retry.run_summary(attempts, ["url"]).first()) == (5, 11, 6, 1)
    assert tuple(retry.run_summary(attempts.limit(0), ["url"]).first()) == (0, 0, 0, 0)
