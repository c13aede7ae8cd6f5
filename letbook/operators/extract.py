"""Typed rows out of fetched pages: cards, links, details."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import (
    CARD_CLASS,
    LINK_CLASS,
    LINK_PATH,
    LINK_PATTERN,
    ROOM_DOMAIN,
    ROOM_ID_PARAM,
    ROOM_SOURCE,
    SALE_DOMAIN,
)
from letbook.functions import html as H
from letbook.functions.model import model_fields, with_model
from letbook.functions.text import to_status
from letbook.functions.urls import absolute, query_param, without_fragment


@dataclass(frozen=True)
class Part:
    """A card field: the text of the first element with this tag and class."""

    name: str
    tag: str
    token: str | None = None
    joiner: str = ""


@dataclass(frozen=True)
class CardLayout:
    """How a search page marks up its cards."""

    tag: str
    token: str | None
    link_tag: str
    link_token: str | None
    parts: tuple[Part, ...]
    domain: str
    id_param: str


ROOM_LAYOUT = CardLayout(
    tag="li",
    token=CARD_CLASS,
    link_tag="a",
    link_token="listing-card__link",
    parts=(
        Part("title", "h2", "listing-card__title"),
        Part("price_text", "p", "listing-card__price", " "),
        Part("location", "p", "listing-card__location"),
        Part("room_type", "span", "listing-card__room"),
        Part("available", "span", "listing-card__availability"),
    ),
    domain=ROOM_DOMAIN,
    id_param=ROOM_ID_PARAM,
)


def card_count(html: Column, layout: CardLayout = ROOM_LAYOUT) -> Column:
    """Number of cards on a page; counting the opening tags is enough."""
    return F.coalesce(
        F.regexp_count(H.visible(html), F.lit(H.opening(layout.tag, layout.token))), F.lit(0)
    )


def cards(
    pages: DataFrame, keep: list[str], layout: CardLayout = ROOM_LAYOUT, outer: bool = False
) -> DataFrame:
    """One row per card: the `keep` columns of its page, its place, link, id and parts.

    A part the card lacks is NULL. With `outer`, a page without cards gives one row whose
    place is NULL, and `n_items` says how many cards the page has.
    """
    found = pages.select(
        *keep, H.blocks(H.visible(F.col("html")), layout.tag, layout.token).alias("_cards")
    )
    if outer:
        keep = [*keep, "n_items"]
        found = found.withColumn("n_items", F.coalesce(F.size("_cards"), F.lit(0)))
    # the outer form, as the inner one would cut the page a second time to skip empty arrays
    pieces = found.select(*keep, F.posexplode_outer("_cards").alias("pos", "_card"))
    if not outer:
        pieces = pieces.where(F.col("pos").isNotNull())
    card = F.col("_card")
    markup = pieces.select(
        *keep,
        "pos",
        H.attribute(H.opening_tag(card, layout.link_tag, layout.link_token), "href").alias("_href"),
        *[H.element_markup(card, p.tag, p.token).alias(f"_{p.name}") for p in layout.parts],
    ).withColumn("url", absolute(F.col("_href"), layout.domain))
    return markup.select(
        *keep,
        "pos",
        "url",
        query_param(F.col("url"), layout.id_param).alias(layout.id_param),
        *[H.inner_text(F.col(f"_{p.name}"), p.joiner).alias(p.name) for p in layout.parts],
    )


def card_list(html: Column, layout: CardLayout) -> Column:
    """The cards of a page as one array of what `cards` gives in rows; for pages that travel whole."""

    def fields(card: Column, pos: Column) -> Column:
        href = H.attribute(H.opening_tag(card, layout.link_tag, layout.link_token), "href")
        texts = [H.inner_text(H.element_markup(card, p.tag, p.token), p.joiner).alias(p.name) for p in layout.parts]
        url = absolute(href, layout.domain)
        return F.struct(pos.alias("pos"), url.alias("url"), query_param(url, layout.id_param).alias(layout.id_param), *texts)

    return F.transform(H.blocks(H.visible(html), layout.tag, layout.token), fields)


def listed_cards(rows: DataFrame, listed: str, layout: CardLayout) -> DataFrame:
    """The rows as `cards` gives them with `outer`, from pages whose card list is in a column as JSON."""
    names = ["url", layout.id_param, *[p.name for p in layout.parts]]
    shape = f"array<struct<pos: int, {', '.join(f'`{n}`: string' for n in names)}>>"
    keep = [c for c in rows.columns if c != listed]
    return rows.select(*keep, F.explode_outer(F.from_json(listed, shape)).alias("_card")).select(
        *keep, *[F.col("_card")[n].alias(n) for n in ("pos", *names)]
    )


def room_cards(pages: DataFrame) -> DataFrame:
    """Room cards of search pages, each with the postcode it was found under."""
    found = cards(pages, ["key", "page_idx", "fetched_at"])
    return found.withColumnRenamed("key", "postcode").withColumn("source", F.lit(ROOM_SOURCE))


def links_by_pattern(
    html: Column, pattern: str = LINK_PATTERN, domain: str = SALE_DOMAIN
) -> Column:
    """Distinct links of a page found anywhere in its markup."""
    found = F.array_distinct(F.regexp_extract_all(html, F.lit(f"({pattern})"), F.lit(1)))
    return F.transform(found, lambda link: F.concat(F.lit(domain), link))


def links_by_anchor(
    html: Column,
    token: str | None = LINK_CLASS,
    path: str = LINK_PATH,
    domain: str = SALE_DOMAIN,
) -> Column:
    """Distinct links of a page's card anchors, fragments cut."""
    anchors = F.regexp_extract_all(H.visible(html), F.lit(f"({H.opening('a', token)})"), F.lit(1))
    hrefs = F.filter(
        F.transform(anchors, lambda a: H.attribute(a, "href")), lambda href: href.contains(path)
    )
    return F.array_distinct(F.transform(hrefs, lambda href: without_fragment(href, domain)))


def page_links(pages: DataFrame, links: Column, keep: list[str]) -> DataFrame:
    """One row per link and page; the outer form keeps the links from being found twice."""
    return pages.select(*keep, F.explode_outer(links).alias("url")).where(F.col("url").isNotNull())


def detail_rows(
    pages: DataFrame,
    form: str = "braces",
    strict_price: bool = True,
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """One typed row per detail page; a page without a model has its fields NULL."""
    read = pages.select(
        *keep,
        F.col("http_status").alias("_status"),
        "fetched_at",
        F.when(F.col("http_status") == 200, F.col("html")).alias("_html"),
    )
    parsed = with_model(read, form, F.col("_html"), "_model")
    return parsed.select(
        *keep,
        *model_fields(F.col("_model"), strict_price),
        to_status(F.col("_status")).alias("status"),
        F.col("fetched_at").alias("scraped_at"),
    )
