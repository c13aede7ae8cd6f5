import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from letbook.operators import health, running

SCHEMA = "worker string, url string, latency_s double, http_status string, finished_at timestamp"
START = dt.datetime(2024, 5, 1)


def log_rows(n=1500, seed=3):
    """One worker has most rows; times repeat and some are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        worker = rng.choice(["hot"] * 8 + ["b", None])
        at = None if rng.random() < 0.01 else START + dt.timedelta(seconds=rng.randrange(0, 40_000, 7))
        status = rng.choice(["200"] * 30 + ["503", "fail", None])
        rows.append((worker, f"u{i:05}", rng.randrange(1, 200) / 256, status, at))
    return rows


def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[4] is not None, r[4] or START, r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("slice_s, hot_rows", [(60, 1), (600, 500), (10**6, 1), (600, 10**6)])
def test_error_rate_and_rolling_mean(spark, slice_s, hot_rows):
    rows = log_rows()
    log = spark.createDataFrame(rows, SCHEMA)
    counted = health.error_rate(
        log, ["worker"], ["finished_at", "url"], running.time_bucket("finished_at", slice_s), hot_rows
    )
    got = {r.url: r for r in health.rolling_latency(counted, ["worker"], size=30, block_rows=100).collect()}
    assert len(got) == len(rows)
    for series in groups(rows).values():
        errors = 0
        for i, r in enumerate(series):
            errors += r[3] != "200"
            recent = [x[2] for x in series[max(0, i - 29) : i + 1]]
            mine = got[r[1]]
            assert (mine.done, mine.total, mine.errors) == (i + 1, len(series), errors)
            assert mine.error_rate == errors / (i + 1)
            began = [x[4] - dt.timedelta(seconds=x[2] or 0) for x in series if x[4]]
            assert mine.started == min(began, default=None)
            assert mine.mean_latency == pytest.approx(sum(recent) / len(recent), abs=1e-6)


def test_window_as_long_as_a_block(spark):
    rows = [("a", f"u{i:03}", float(i), "200", START + dt.timedelta(seconds=i)) for i in range(95)]
    log = spark.createDataFrame(rows, SCHEMA)
    for size, block in ((10, 10), (300, 1000), (1, 5)):
        got = health.rolling_latency(log, ["worker"], ["finished_at", "url"], size=size, block_rows=block)
        for r in got.collect():
            i = int(r.url[1:])
            recent = range(max(0, i - size + 1), i + 1)
            assert r.mean_latency == pytest.approx(sum(recent) / len(recent))


def test_no_drift_and_no_spreading(spark):
    """A huge value, a NaN, an infinite value and a NULL: means are right, whatever the block size."""
    latency = [0.1] * 1000
    latency[5], latency[40], latency[41], latency[42] = 1e9, float("nan"), None, float("inf")
    rows = [("a", f"u{i:04}", v, "200", START + dt.timedelta(seconds=i)) for i, v in enumerate(latency)]
    log = spark.createDataFrame(rows, SCHEMA)
    means = []
    for block in (500, 100_000):
        got = health.rolling_latency(log, ["worker"], ["finished_at", "url"], size=300, block_rows=block)
        means.append([r.mean_latency for r in got.orderBy("url").collect()])
    assert means[0] == means[1]
    assert means[0][999] == 0.1 and means[0][100] == pytest.approx((1e9 + 0.1 * 97) / 98)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_latencies_beyond_all_bounds(spark, hot_rows):
    """Finite but huge latencies end no job: they are no measurement and no start."""
    latency = [0.5] * 40
    latency[7], latency[8], latency[9] = 1e13, 1e300, -1e13
    latency[20:30] = [9e12] * 10
    rows = [("a", f"u{i:04}", v, "200", START + dt.timedelta(seconds=i)) for i, v in enumerate(latency)]
    log = spark.createDataFrame(rows, SCHEMA)
    counted = health.error_rate(log, ["worker"], ["finished_at", "url"], hot_rows=hot_rows)
    got = health.rolling_latency(counted, ["worker"], size=5, block_rows=10).orderBy("url").collect()
    assert all(r.started == START - dt.timedelta(seconds=0.5) for r in got)
    assert [r.mean_latency for r in got[:20]] == [0.5] * 20
    assert got[24].mean_latency == pytest.approx(9e12) and got[39].mean_latency == 0.5
    assert health.load_signal(log, keys=["worker"], order=["finished_at", "url"]).count() == 40
    assert health.progress(log, health.ROOM_ETA, ["worker"], ["finished_at", "url"]).where("eta_s is null").count() == 0


@pytest.mark.parametrize("times", ["one second", "none", "mixed"])
def test_a_hot_series_is_cut_evenly(spark, times, monkeypatch):
    """Whatever the times of a hot key are, no bucket holds much more than its share, and counts are right."""
    buckets = []
    real = running.keep

    def watched(rows, label):
        stored = real(rows, label)
        if label == "ranges":
            buckets.extend(r["count"] for r in stored.groupBy("_bucket").count().collect())
        return stored

    monkeypatch.setattr(running, "keep", watched)
    n = 4000
    at = F.when(F.lit(times == "none") | (F.lit(times == "mixed") & (F.col("id") % 2 == 0)), None).otherwise(F.lit(START))
    log = spark.range(n).select(
        F.lit("hot").alias("worker"), F.format_string("u%05d", "id").alias("url"), F.lit(0.25).alias("latency_s"),
        F.when(F.col("id") % 10 == 0, "503").otherwise("200").alias("http_status"), at.cast("timestamp").alias("finished_at"),
    )
    got = health.error_rate(log, ["worker"], ["finished_at", "url"], hot_rows=500).orderBy(F.col("finished_at").asc_nulls_first(), "url").collect()
    assert [r.done for r in got] == list(range(1, n + 1)) and got[-1].errors == n // 10
    assert len(buckets) > 6 and max(buckets) < 3 * n / len(buckets)


def test_default_latency(spark):
    log = spark.createDataFrame([("a", "u", None, "200", START)], SCHEMA)
    assert health.rolling_latency(log, ["worker"]).first().mean_latency == 0.25
    with_default = health.rolling_latency(log, ["worker"], default=health.FIRST_LOAD.default_latency)
    assert with_default.first().mean_latency == 0.22


ETA_CASES = [
    # rule, done, total, elapsed, seconds left
    (health.ROOM_ETA, 5, 10, 50.0, 0.0),
    (health.ROOM_ETA, 6, 10, 60.5, 40.0),
    (health.ROOM_ETA, 6, 60_000, 60.0, 599940.0),
    (health.URL_ETA, 9, 100, 9.0, 7200.0),
    (health.URL_ETA, 10, 100, 10.0, 90.0),
    (health.URL_ETA_DATED, 20, 100, 10.0, 7200.0),
    (health.URL_ETA_DATED, 21, 42, 10.0, 10.0),
    (health.URL_ETA_FIRST, 10, 100, 10.0, 7200.0),
    (health.URL_ETA_FIRST, 11, 22, 10.0, 10.0),
    (health.DETAIL_ETA, 499, 1000, 10.0, None),
    (health.DETAIL_ETA, 500, 1000, 10.0, 10.0),
    (health.DETAIL_ETA, 500, 10**6, 10**4 * 1.0, 7200.0),
    (health.DETAIL_ETA_DATED, 299, 600, 10.0, None),
    (health.DETAIL_ETA_DATED, 300, 600, 10.0, 10.0),
]


@pytest.mark.parametrize("rule, done, total, elapsed, left", ETA_CASES)
def test_eta(spark, rule, done, total, elapsed, left):
    row = spark.range(1).select(
        health.eta_seconds(rule, F.lit(done), F.lit(total), F.lit(elapsed)).alias("r")
    ).first()
    assert row.r == (None if left is None else pytest.approx(left))


def test_eta_without_a_total(spark):
    row = spark.range(1).select(health.eta_seconds(health.ROOM_ETA, F.lit(7), F.lit(0), F.lit(9.0)).alias("r")).first()
    assert row.r == 0.0


def test_progress(spark):
    rows = [("a", f"u{i:02}", 0.1, "200", START + dt.timedelta(seconds=10 * i)) for i in range(20)]
    got = health.progress(spark.createDataFrame(rows, SCHEMA), health.ROOM_ETA, ["worker"], ["finished_at", "url"])
    last = {r.url: r for r in got.collect()}
    assert (last["u09"].fraction, last["u09"].elapsed_s, last["u09"].eta_text) == (0.5, 90.1, "01:30")
    assert last["u19"].eta_s == 0.0
    detail = health.progress(spark.createDataFrame(rows, SCHEMA), health.DETAIL_ETA, ["worker"], ["finished_at", "url"])
    assert {r.eta_text for r in detail.collect()} == {"--:--"}


@pytest.mark.parametrize(
    "latency, errors, signal",
    [(0.1, 0, "raise"), (0.25, 0, "hold"), (0.5, 0, "lower"), (0.1, 2, "hold"), (0.1, 3, "lower")],
)
def test_load_signal(spark, latency, errors, signal):
    rows = [
        ("a", f"u{i:03}", latency, "503" if i < errors else "200", START + dt.timedelta(seconds=i)) for i in range(150)
    ]
    rule = health.LoadRule(100, 0.25, 0.18, 0.01, 0.30, 0.015)
    got = health.load_signal(spark.createDataFrame(rows, SCHEMA), rule, ["worker"], ["finished_at", "url"], size=30)
    by_done = {r.done: r.signal for r in got.collect()}
    assert by_done[99] == "warmup" and by_done[150] == signal


def test_work_chunks(spark):
    rows = spark.range(1000).withColumnRenamed("id", "key")
    by_place = health.work_chunks(rows, 8, "key", position="key").groupBy("chunk").count().collect()
    assert sorted((r.chunk, r["count"]) for r in by_place) == [(c, 125) for c in range(8)]
    by_key = health.work_chunks(rows, 8, "key").groupBy("chunk").count().collect()
    assert len(by_key) == 8 and sum(r["count"] for r in by_key) == 1000
    assert health.spread_work(rows, 5).rdd.getNumPartitions() == 5
