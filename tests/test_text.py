import datetime as dt

import pytest
from pyspark.sql import functions as F

from letbook.functions import text as T


def test_strip_takes_every_blank(apply):
    assert apply(["\t a b  \r\n", "", None], T.strip) == ["a b", "", None]


def test_clean_key(apply):
    assert apply([" ab10 ", "\tsw1a\n", None], T.clean_key) == ["AB10", "SW1A", None]


@pytest.mark.parametrize(
    "text, value",
    [
        ("£750 pcm", 750),
        ("£1,250.50 pcm", 1250),
        ("from £90 - £120 pw", 90),
        ("£ 90 or £95", 95),
        ("POA", None),
        ("£,", None),
        ("", None),
        (None, None),
        ("£99999999999999999999", None),
    ],
)
def test_money(apply, text, value):
    assert apply([text], T.money) == [value]


def test_to_number(apply):
    given = ["12", " 12.5 ", "-1", "1e3", "12d", "2F", "studio", "", "NaN", None]
    assert apply(given, T.to_number) == [12.0, 12.5, -1.0, 1000.0, None, None, None, None, None, None]


def test_to_status(apply):
    assert apply(["200", "404", "fail", "0", "-1", "", None], T.to_status) == [
        200, 404, None, None, None, None, None,
    ]
    assert apply([200, 0, None], T.to_status, "int") == [200, None, None]


def test_is_success(apply):
    assert apply(["200", "503", "fail", None], T.is_success) == [True, False, False, False]
    assert apply([200, 0], T.is_success, "bigint") == [True, False]


def test_to_time(apply):
    assert apply(["2024-05-01 10:00:00", "2024-13-45", "soon", "", None], T.to_time) == [
        dt.datetime(2024, 5, 1, 10), None, None, None, None,
    ]


def test_digits_int(apply):
    given = ["250000", "250000.0", "-1", "", " 7", "1e3", None]
    assert apply(given, T.digits_int) == [250000, None, None, None, None, None, None]


def test_bedroom_count(apply):
    assert apply(["3", "3.0", "2.9", "studio", "", None], T.bedroom_count) == [3, 3, 2, None, None, None]


def test_first_truthy(spark):
    rows = spark.createDataFrame([(None, "b"), ("", "b"), ("a", "b"), ("", "")], "x string, y string")
    out = rows.select(T.first_truthy(F.col("x"), F.col("y")).alias("r")).collect()
    assert [r.r for r in out] == ["b", "b", "a", None]


def test_postcode_of(spark):
    rows = spark.createDataFrame(
        [
            ("AB1 2CD", "X", "Y"),
            ("", "AB1", "2CD"),
            (None, "AB1", None),
            (None, None, "2CD"),
            (None, None, None),
            ("", "", ""),
        ],
        "p string, o string, i string",
    )
    out = rows.select(T.postcode_of(F.col("p"), F.col("o"), F.col("i")).alias("r")).collect()
    assert [r.r for r in out] == ["AB1 2CD", "AB1 2CD", "AB1", "2CD", None, None]


def test_display(apply):
    assert apply([0, 59, 61, 7200, 360000, None], T.minutes_seconds, "int") == [
        "00:00", "00:59", "01:01", "120:00", "6000:00", None,
    ]
    assert apply([1234567, 12], T.grouped_number, "int") == ["1,234,567", "12"]


def test_labels(apply):
    moment = dt.datetime(2024, 5, 1, 10, 0, 0, 123000)
    assert apply([moment], T.day_label, "timestamp") == ["2024-05-01"]
    assert apply([moment], T.epoch_label, "timestamp") == [
        int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    ]
