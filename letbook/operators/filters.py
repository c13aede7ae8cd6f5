"""Filters, facets, tolerant projection and latest-first order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALE_COLUMNS = ("postcode", "price", "bedrooms", "property_type", "address", "url", "scraped_at")
ROOM_COLUMNS = ("postcode", "price_norm", "room_type", "location", "url", "scraped_at")


def by_prefix(rows: DataFrame, column: str, prefix: str | None) -> DataFrame:
    """Rows whose value starts with the upper-cased prefix, taken literally; no prefix, no filter."""
    return rows.where(F.col(column).startswith(prefix.upper())) if prefix else rows


def by_choice(rows: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Rows whose value was chosen; no choice, no filter."""
    return rows.where(F.col(column).isin(list(values))) if values else rows


def by_range(rows: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows within the given bounds, ends included; a bound of 0 counts as given."""
    if low is not None:
        rows = rows.where(F.col(column) >= F.lit(low))
    if high is not None:
        rows = rows.where(F.col(column) <= F.lit(high))
    return rows


@dataclass(frozen=True)
class Selection:
    """What a viewer asks for; every part is optional and all parts must hold."""

    postcode: str | None = None
    choices: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple] = field(default_factory=dict)

    def apply(self, rows: DataFrame) -> DataFrame:
        rows = by_prefix(rows, "postcode", self.postcode)
        for column, values in self.choices.items():
            rows = by_choice(rows, column, values)
        for column, (low, high) in self.ranges.items():
            rows = by_range(rows, column, low, high)
        return rows


def project(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in this order; those the table lacks are left out."""
    return rows.select(*[c for c in columns if c in rows.columns])


def facet(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values in order, without NULL."""
    return rows.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def latest_first(
    rows: DataFrame,
    columns: Sequence[str],
    time: str = "scraped_at",
    tie: str = "url",
    limit: int | None = None,
) -> DataFrame:
    """Newest rows first, rows without a time last, equal times by the tie column.

    With a limit this is a distributed top-k; without one, a range-partitioned sort.
    """
    ordered = project(rows, columns).orderBy(F.desc_nulls_last(time), F.asc_nulls_last(tie))
    return ordered.limit(limit) if limit else ordered
