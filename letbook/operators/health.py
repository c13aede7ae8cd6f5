"""Crawl health from the fetch log: latency, errors, progress, load signal, work split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import ETA_CAP_SECONDS, LATENCY_WINDOW
from letbook.functions.text import is_success, minutes_seconds
from letbook.operators.running import BLOCK_ROWS, rolling_mean, running
from letbook.operators.skew import HOT_ROWS

#: About thirty years.
LONGEST = 1_000_000_000
SERIES = ["worker", "pass_no"]
ORDER = ["finished_at", "url"]


@dataclass(frozen=True)
class EtaRule:
    """From which completion on time left is estimated, what is said before, the largest estimate."""

    from_done: int
    early: int | None
    cap: int | None
    whole: bool = False


# How the collectors estimate, each in its own way
ROOM_ETA = EtaRule(6, 0, None, whole=True)
URL_ETA = EtaRule(10, 99999, ETA_CAP_SECONDS)
URL_ETA_DATED = EtaRule(21, 99999, ETA_CAP_SECONDS)
URL_ETA_FIRST = EtaRule(11, 99999, ETA_CAP_SECONDS)
DETAIL_ETA = EtaRule(500, None, ETA_CAP_SECONDS)
DETAIL_ETA_DATED = EtaRule(300, None, ETA_CAP_SECONDS)


@dataclass(frozen=True)
class LoadRule:
    """Warm-up length, default latency, and when to raise or lower the load."""

    warmup: int
    default_latency: float
    raise_below: float
    raise_errors: float
    lower_above: float
    lower_errors: float


# Thresholds of the streaming, the dated and the first collector
STREAMED_LOAD = LoadRule(500, 0.25, 0.18, 0.01, 0.30, 0.015)
DATED_LOAD = LoadRule(300, 0.25, 0.18, 0.008, 0.28, 0.015)
FIRST_LOAD = LoadRule(500, 0.22, 0.18, 0.008, 0.28, 0.015)


def _began(log: DataFrame, order: list[str]) -> Column | None:
    """When a fetch began: its latency before it was finished, where the log has latencies.

    A latency that is no number, or of more than `LONGEST` seconds, says nothing of it.
    """
    if "latency_s" not in log.columns:
        return None
    latency = F.col("latency_s").cast("double")
    usable = ~F.isnan(latency) & (F.abs(latency) <= LONGEST)
    taken = F.coalesce(F.when(usable, F.round(latency * 1_000_000)), F.lit(0.0)).cast("bigint")
    micros = F.unix_micros(F.col(order[0]).cast("timestamp")) - taken
    return F.timestamp_micros(micros)


def error_rate(
    log: DataFrame,
    keys: list[str] = SERIES,
    order: list[str] = ORDER,
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The log with `done`, `total`, `started`, `errors` so far and their share."""
    failed = F.when(is_success(F.col("http_status")), 0).otherwise(1).cast("bigint")
    counted = running(log, keys, order, {"errors": failed}, bucket, hot_rows, _began(log, order))
    return counted.withColumn("error_rate", F.col("errors") / F.greatest(F.lit(1), F.col("done")))


def rolling_latency(
    log: DataFrame,
    keys: list[str] = SERIES,
    order: list[str] = ORDER,
    size: int = LATENCY_WINDOW,
    default: float = STREAMED_LOAD.default_latency,
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The log with the mean latency of the last completions of its series."""
    numbered = (
        log if "done" in log.columns else running(log, keys, order, {}, bucket, hot_rows, _began(log, order))
    )
    return rolling_mean(numbered, keys, "done", "latency_s", size, "mean_latency", default, block_rows)


def eta_seconds(rule: EtaRule, done: Column, total: Column, elapsed: Column) -> Column:
    share = F.when(total > 0, done / total).otherwise(F.lit(1.0))
    left = elapsed / F.greatest(share, F.lit(1e-9)) - elapsed
    eta = F.when(done >= rule.from_done, left).otherwise(F.lit(rule.early).cast("double"))
    eta = F.when(eta < 0, F.lit(0.0)).otherwise(eta)
    if rule.cap is not None:
        eta = F.when(eta > rule.cap, F.lit(float(rule.cap))).otherwise(eta)
    return F.floor(eta).cast("double") if rule.whole else eta


def progress(
    log: DataFrame,
    rule: EtaRule,
    keys: list[str] = SERIES,
    order: list[str] = ORDER,
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The log with its share done, time since the first fetch of the series began, and time left."""
    numbered = (
        log if "done" in log.columns else running(log, keys, order, {}, bucket, hot_rows, _began(log, order))
    )

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    elapsed = (micros(order[0]) - micros("started")) / 1_000_000
    share = F.when(F.col("total") > 0, F.col("done") / F.col("total")).otherwise(F.lit(1.0))
    timed = numbered.withColumn("elapsed_s", elapsed).withColumn("fraction", share)
    eta = eta_seconds(rule, F.col("done"), F.col("total"), F.col("elapsed_s"))
    shown = F.coalesce(minutes_seconds(F.col("eta_s")), F.lit("--:--"))
    return timed.withColumn("eta_s", eta).withColumn("eta_text", shown)


def load_signal(
    log: DataFrame,
    rule: LoadRule = STREAMED_LOAD,
    keys: list[str] = SERIES,
    order: list[str] = ORDER,
    size: int = LATENCY_WINDOW,
) -> DataFrame:
    """The log with what its latency and errors call for: warmup, raise, lower or hold."""
    measured = rolling_latency(
        error_rate(log, keys, order), keys, order, size, rule.default_latency
    )
    mean, errors = F.col("mean_latency"), F.col("error_rate")
    signal = (
        F.when(F.col("done") < rule.warmup, "warmup")
        .when((mean < rule.raise_below) & (errors < rule.raise_errors), "raise")
        .when((mean > rule.lower_above) | (errors > rule.lower_errors), "lower")
        .otherwise("hold")
    )
    return measured.withColumn("signal", signal)


def work_chunks(rows: DataFrame, chunks: int, key: str, position: str | None = None) -> DataFrame:
    """Rows with the chunk they belong to: by their position where they have one, else by key."""
    number = F.col(position) if position else F.xxhash64(key)
    return rows.withColumn("chunk", F.pmod(number, F.lit(chunks)).cast("int"))


def spread_work(rows: DataFrame, chunks: int) -> DataFrame:
    """Rows dealt out evenly over this many tasks."""
    return rows.repartition(chunks)
