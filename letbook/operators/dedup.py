"""Removing repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

LISTING_KEYS = ["source", "flatshare_id", "postcode"]
ARRIVAL = ["fetched_at", "page_idx", "pos"]


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key.

    Spark limits each key to one row within every task before the shuffle
    (WindowGroupLimit), so copies of one row never meet in one place.
    """
    ranked = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def with_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in which no key is NULL or empty."""
    for key in keys:
        is_text = isinstance(rows.schema[key].dataType, StringType)
        rows = rows.where(F.col(key) != "" if is_text else F.col(key).isNotNull())
    return rows


def first_listing(
    cards: DataFrame, keys: list[str] = LISTING_KEYS, order: list[Column | str] = ARRIVAL
) -> DataFrame:
    """The first arrival of each listing under each postcode."""
    return first_per_key(with_keys(cards, keys), keys, order)


def repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows there are, how many distinct keys, how many rows repeat a key."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_dropped"),
    )


def first_url(rows: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Within each location, the first row of each URL; rows without a URL are dropped."""
    return first_per_key(with_keys(rows, ["url"]), [key, "url"], order)


def distinct_urls(*tables: DataFrame) -> DataFrame:
    """Distinct URLs over all tables."""
    urls = tables[0].select("url")
    for table in tables[1:]:
        urls = urls.union(table.select("url"))
    return urls.distinct()


def urls_per_key(links: DataFrame, key: str) -> DataFrame:
    """Distinct URLs per location, as a count; the set itself stays as rows."""
    return links.select(key, "url").distinct().groupBy(key).agg(F.count("url").alias("n_urls"))
