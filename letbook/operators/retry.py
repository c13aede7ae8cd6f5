"""Several passes over failing URLs, as questions on a table of attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import MAX_PASSES, THROTTLE_STATUSES
from letbook.functions.text import is_success, to_status
from letbook.operators.dedup import first_per_key


def retry_sets(attempts: DataFrame, passes: int = MAX_PASSES) -> DataFrame:
    """(url, after_pass): URLs to fetch again after each pass but the last: tried in it, without success."""
    tried = attempts.where(F.col("pass_no") < passes)
    by_url = tried.groupBy("url", F.col("pass_no").alias("after_pass")).agg(
        F.bool_or(is_success(F.col("http_status"))).alias("ok")
    )
    return by_url.where(~F.col("ok")).select("url", "after_pass")


def retry_set(attempts: DataFrame, pass_no: int) -> DataFrame:
    """URLs to fetch again after this pass."""
    return retry_sets(attempts.where(F.col("pass_no") == pass_no), pass_no + 1).select("url")


def final_failures(attempts: DataFrame, passes: int = MAX_PASSES) -> DataFrame:
    """URLs that went through all passes without any success."""
    by_url = attempts.groupBy("url").agg(
        F.max("pass_no").alias("last_pass"),
        F.bool_or(is_success(F.col("http_status"))).alias("ok"),
    )
    return by_url.where((F.col("last_pass") == passes) & ~F.col("ok")).select("url")


def resolve_attempts(
    attempts: DataFrame, keys: tuple[str, ...] = ("url",), tie: tuple[str | Column, ...] = ()
) -> DataFrame:
    """The attempt that counts for each URL: a success before a failure, then the latest pass.

    Attempts of one pass are told apart by `tie`, by their `attempt` number where there is one, and at
    last by all their values, so the choice is the same in every run.
    """
    again = [F.desc_nulls_last("attempt")] if "attempt" in attempts.columns else []
    order = [F.desc(is_success(F.col("http_status"))), F.desc("pass_no"), *tie, *again, F.xxhash64(*attempts.columns)]
    return first_per_key(attempts, list(keys), order)


def failure_class(status: Column) -> Column:
    """ok, throttled, http_error, or network where no answer came."""
    code = to_status(status)
    return (
        F.when(code == 200, "ok")
        .when(code.isin(*THROTTLE_STATUSES), "throttled")
        .when(code.isNotNull(), "http_error")
        .otherwise("network")
    )


def failure_classes(attempts: DataFrame) -> DataFrame:
    """How many attempts of each pass ended how."""
    return (
        attempts.groupBy("pass_no", failure_class(F.col("http_status")).alias("failure_class"))
        .agg(F.count(F.lit(1)).alias("attempts"))
    )


def run_summary(attempts: DataFrame, keys: list[str], passes: int = MAX_PASSES) -> DataFrame:
    """Keys processed, rows got, rows dropped as repeats, keys failed for good."""
    ok = is_success(F.col("http_status"))
    per_key = attempts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("pass_no").alias("last_pass"), F.bool_or(ok).alias("ok")
    )
    lost = ~F.col("ok") & (F.col("last_pass") == passes)
    return per_key.agg(
        F.count(F.lit(1)).alias("processed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped"),
        F.count_if(lost).alias("failed"),
    )
