"""Counts and mean prices by area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_area(
    rows: DataFrame, price: str, count_name: str, area: str = "postcode", top: int | None = 20
) -> DataFrame:
    """Rows and mean price per area, the largest areas first.

    Rows without a price count but do not weigh on the mean; a missing area is an area.
    Areas with equal counts come in the order of their names.
    """
    report = rows.groupBy(area).agg(
        F.count(F.lit(1)).alias(count_name), F.avg(price).alias("avg_price")
    )
    ordered = report.orderBy(F.desc(count_name), F.asc_nulls_last(area))
    return ordered.limit(top) if top else ordered


def sale_by_postcode(rows: DataFrame, top: int | None = 20) -> DataFrame:
    return by_area(rows, "price", "listings", top=top)


def room_by_postcode(rows: DataFrame, top: int | None = 20) -> DataFrame:
    return by_area(rows, "price_norm", "rooms", top=top)


def selection_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("listings"))


def with_location(rows: DataFrame, locations: DataFrame, key: str, lookup: str) -> DataFrame:
    """Rows with the columns of their location.

    The master list is small, but that is left to Spark: it broadcasts the list when its
    size, known from the file or at run time, is below the configured threshold.
    """
    return rows.join(locations, rows[key] == locations[lookup], "left")
