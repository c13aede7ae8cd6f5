"""URL pieces and search URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letbook.fixed import (
    LOCATION_ID_PREFIX,
    ROOM_PAGE_SIZE,
    ROOM_SEARCH_URL,
    SALE_SEARCH_URL,
)


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter that is not blank, decoded; NULL when there is none.

    A value with a broken percent escape is kept as written.
    """
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    values = F.regexp_extract_all(query, F.lit(f"(?:^|&){name}=([^&]+)"), F.lit(1))
    raw = F.get(values, F.lit(0))
    return F.coalesce(F.try_url_decode(raw), F.translate(raw, "+", " "))


def absolute(href: Column, domain: str) -> Column:
    """Absolute links stay, others get the domain in front."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(domain), href))


def without_fragment(href: Column, domain: str) -> Column:
    """The domain and everything before the first `#`."""
    return F.concat(F.lit(domain), F.substring_index(href, "#", 1))


def location_id(code: Column) -> Column:
    return F.concat(F.lit(LOCATION_ID_PREFIX), code.try_cast("double").try_cast("int").cast("string"))


def sale_search_url(location: Column, index: Column, by_location: bool = True) -> Column:
    """Search page of a sale location; the newest collector leaves the location flag out."""
    flag = "&useLocationIdentifier=true" if by_location else ""
    return F.concat(
        F.lit(f"{SALE_SEARCH_URL}?locationIdentifier="),
        location,
        F.lit(f"&sortType=1{flag}&index="),
        index.cast("string"),
    )


def room_search_url(postcode: Column, offset: Column) -> Column:
    """Search page of a room postcode."""
    return F.concat(
        F.lit(f"{ROOM_SEARCH_URL}?action=search&flatshare_type=offered&search="),
        F.url_encode(postcode),
        F.lit(f"&max_per_page={ROOM_PAGE_SIZE}&offset="),
        offset.cast("string"),
    )
