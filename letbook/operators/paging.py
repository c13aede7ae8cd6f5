"""Search pages per location: how many to plan, where the series ends, its last status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import ROOM_FALLBACK_PAGES, ROOM_PAGE_SIZE, SALE_MAX_PAGES, SALE_PAGE_SIZE
from letbook.operators.dedup import first_per_key
from letbook.operators.skew import attach


@dataclass(frozen=True)
class SeriesRules:
    """When a location's pages end.

    A full page goes on and a short one ends the series, page included. The forms differ
    in what a first page without items means, and a later page without markup.
    """

    page_size: int
    empty_first_ends: bool
    missing_later_ends: bool


ROOM_SERIES = SeriesRules(ROOM_PAGE_SIZE, empty_first_ends=True, missing_later_ends=False)
SALE_SERIES = SeriesRules(SALE_PAGE_SIZE, empty_first_ends=False, missing_later_ends=True)
SALE_SERIES_FIRST_ONLY = SeriesRules(SALE_PAGE_SIZE, empty_first_ends=True, missing_later_ends=True)


def page_count(total: Column, page_size: int = ROOM_PAGE_SIZE, fallback: int = ROOM_FALLBACK_PAGES) -> Column:
    """Pages that hold `total` results, one at least; a fixed number when the total is unknown."""
    pages = F.greatest(F.lit(1), F.ceil(total / page_size).cast("int"))
    return F.when(total != 0, pages).otherwise(F.lit(fallback))


def page_plan(locations: DataFrame, pages: Column, page_size: int) -> DataFrame:
    """One row per location and page, with the offset of the page."""
    plan = locations.withColumn("page_idx", F.explode(F.sequence(F.lit(0), pages - 1)))
    return plan.withColumn("offset", F.col("page_idx") * page_size)


def room_page_plan(locations: DataFrame, total: Column) -> DataFrame:
    return page_plan(locations, page_count(total), ROOM_PAGE_SIZE)


def sale_page_plan(locations: DataFrame, max_pages: int = SALE_MAX_PAGES) -> DataFrame:
    return page_plan(locations, F.lit(max_pages), SALE_PAGE_SIZE)


def settle_fetches(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One row per location and page: of several fetches one with items, then the latest.

    Fetches of one time are told apart by all their values, so the choice is the same in every run.
    """
    order = [F.desc(F.col("n_items") > 0), F.desc_nulls_last("fetched_at"), F.xxhash64(*pages.columns)]
    return first_per_key(pages, [*keys, "page_idx"], order)


def _ends_series(rules: SeriesRules, n_items: Column, has_html: Column, page_idx: Column) -> Column:
    short = n_items < rules.page_size
    first = short if rules.empty_first_ends else short & (n_items > 0)
    later = short if rules.missing_later_ends else short & has_html
    return F.when(page_idx == 0, first).otherwise(later)


def series_facts(pages: DataFrame, rules: SeriesRules, keys: list[str]) -> DataFrame:
    """Per location: the page that ends its series (NULL when none does).

    `pages` has `page_idx`, `n_items` and `has_html`; items of a page without markup are 0.
    """
    n_items = F.when(F.col("has_html"), F.col("n_items")).otherwise(0)
    ends = _ends_series(rules, n_items, F.col("has_html"), F.col("page_idx"))
    return pages.groupBy(*keys).agg(F.min(F.when(ends, F.col("page_idx"))).alias("stop_idx"))


def visited(pages: DataFrame, rules: SeriesRules, keys: list[str]) -> DataFrame:
    """Pages up to and including the one that ends their location's series."""
    rows = attach(pages, series_facts(pages, rules, keys), keys)
    return rows.where(F.col("stop_idx").isNull() | (F.col("page_idx") <= F.col("stop_idx"))).drop("stop_idx")


def truncate(pages: DataFrame, rules: SeriesRules, keys: list[str]) -> DataFrame:
    """Visited pages that have items."""
    return visited(pages, rules, keys).where(F.col("has_html") & (F.col("n_items") > 0))


def last_status(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per location: the status of the last page that answered, 200 when none did, and
    whether the first page had markup."""
    answered = F.nullif(F.col("http_status"), F.lit(0))
    place = F.when(answered.isNotNull(), F.col("page_idx"))
    return pages.groupBy(*keys).agg(
        F.coalesce(F.max_by(answered, place), F.lit(200)).alias("status"),
        F.coalesce(F.max((F.col("page_idx") == 0) & F.col("has_html")), F.lit(False)).alias("first_html"),
    )


def tag_status(rows: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the last status of their location."""
    return attach(rows, last_status(pages, keys).drop("first_html"), keys)
