"""Sale listings: links from search pages, rows from detail pages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook.fixed import MAX_PASSES, SALE_VIEW
from letbook.functions.text import is_success
from letbook.operators.dedup import distinct_urls
from letbook.operators.extract import detail_rows, links_by_anchor
from letbook.operators.ledger import sale_outcomes, to_events
from letbook.operators.paging import SALE_SERIES, SeriesRules, settle_fetches, truncate
from letbook.operators.retry import resolve_attempts
from letbook.session import keep
from letbook.sources.ledgers import append_ledger, read_or_empty
from letbook.sources.pages import has_html, settle_pages
from letbook.sources.shards import canonical_sale


def collected_links(
    pages: DataFrame, links: Column | None = None, rules: SeriesRules = SALE_SERIES
) -> DataFrame:
    """Links per location on the pages up to the end of its series; the markup is read once."""
    return _links_of(_settled(pages, links), rules)


def _settled(pages: DataFrame, links: Column | None) -> DataFrame:
    """One fetch per location and page, with its links, stored."""
    found = links_by_anchor(F.col("html")) if links is None else links
    per_page = settle_pages(pages).select(
        "key",
        "page_idx",
        "fetched_at",
        has_html().alias("has_html"),
        F.coalesce(found, F.array().cast("array<string>")).alias("links"),
    )
    kept = keep(per_page.withColumn("n_items", F.size("links")), "links")
    return settle_fetches(kept, ["key"])


def _links_of(fetches: DataFrame, rules: SeriesRules) -> DataFrame:
    return truncate(fetches, rules, ["key"]).select("key", F.explode("links").alias("url"))


@dataclass(frozen=True)
class SaleCollection:
    """What a run over search pages gives: links per location, URLs not collected before, ledger events."""

    links: DataFrame
    fresh: DataFrame
    events: DataFrame


def collect_sales(
    pages: DataFrame,
    known: DataFrame,
    run_id: str,
    at: Column,
    links: Column | None = None,
    rules: SeriesRules = SALE_SERIES,
) -> SaleCollection:
    """Links of the run's locations, the URLs among them that are new, and a completed event per location."""
    fetches = _settled(pages, links)
    found = _links_of(fetches, rules)
    return SaleCollection(
        links=found,
        fresh=distinct_urls(found).join(known.select("url").distinct(), "url", "left_anti"),
        events=to_events(sale_outcomes(fetches, ["key"]), SALE_VIEW, "key", run_id, at),
    )


def collected_urls(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """(url, run_id): URLs that runs have collected, each by the first that met it; none where nothing is yet."""
    rows = read_or_empty(spark, path, "url string, run_id string")
    return rows if but is None else rows.where(F.col("run_id") != but)


def write_collection(spark: SparkSession, pages: DataFrame, urls_path: str, ledger_path: str, run_id: str, at: Column, **how) -> SaleCollection:
    """A run's new URLs and events appended. The run written again replaces its URLs with the same ones."""
    run = collect_sales(pages, collected_urls(spark, urls_path, but=run_id), run_id, at, **how)
    run.fresh.write.mode("overwrite").parquet(f"{urls_path}/run_id={run_id}")
    append_ledger(run.events, ledger_path)
    return run


def urls_to_fetch(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct URLs of all locations, with those collected before."""
    return distinct_urls(links) if known is None else distinct_urls(links, known)


def sale_attempts(
    details: DataFrame, form: str = "braces", strict_price: bool = True
) -> DataFrame:
    """One typed row per fetch of a detail page, failures included."""
    columns = ("url", "http_status", *[c for c in ("pass_no", "attempt") if c in details.columns])
    return detail_rows(details, form, strict_price, keep=columns)


def sale_run(details: DataFrame, form: str = "braces", strict_price: bool = True) -> DataFrame:
    """The shard row of each URL: of several passes the one that counts."""
    attempts = sale_attempts(details, form, strict_price)
    if "pass_no" in attempts.columns:
        return resolved(attempts)
    return canonical_sale(attempts, stamp=F.col("scraped_at"))


def retry_run(
    urls: DataFrame,
    fetch: Callable[[DataFrame, int], DataFrame],
    path: str,
    passes: int = MAX_PASSES,
    last: int | None = None,
    form: str = "braces",
    strict_price: bool = True,
) -> DataFrame:
    """Detail rows of URLs over several passes, each over what failed in the one before; all attempts, stored.

    `fetch` gives the detail pages of URLs in a pass. Every pass is stored before the next one starts from its
    failures, so a run that was stopped (or told to stop after pass `last`) goes on after the last whole pass and
    ends with the same table. It ends early when nothing is left to try.
    """
    spark = urls.sparkSession
    todo = urls.select("url").distinct()
    stop = passes if last is None else min(last, passes)
    for pass_no in range(1, stop + 1):
        folder = f"{path}/attempts/pass_no={pass_no}"
        done = read_or_empty(spark, f"{path}/passes", "pass_no int").where(F.col("pass_no") == pass_no)
        if done.isEmpty():
            details = fetch(todo, pass_no).drop("pass_no")
            sale_attempts(details, form, strict_price).write.mode("overwrite").parquet(folder)
            spark.range(1).select(F.lit(pass_no).alias("pass_no")).write.mode("overwrite").parquet(f"{path}/passes/pass={pass_no}")
        tried = spark.read.parquet(folder)
        ok = tried.groupBy("url").agg(F.bool_or(is_success(F.col("http_status"))).alias("ok"))
        todo = ok.where(~F.col("ok")).select("url")
        if todo.isEmpty():
            break
    return spark.read.parquet(f"{path}/attempts")


def resolved(attempts: DataFrame) -> DataFrame:
    """The shard row of each URL: of all attempts the one that counts."""
    return canonical_sale(resolve_attempts(attempts, tie=(F.desc_nulls_last("scraped_at"),)), stamp=F.col("scraped_at"))
