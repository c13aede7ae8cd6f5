"""Every operator as a query over the star-schema tables; `oracle` has the SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook import schemas
from letbook.fixed import ROOM_SOURCE, ROOM_VIEW, SALE_VIEW
from letbook.functions import html as H
from letbook.functions import text as T
from letbook.functions import urls as U
from letbook.functions.model import first_filled, leaf, model_fields, page_variant, variant_fields, with_model
from letbook.operators import dedup, extract, filters, health, ledger, paging, reports, retry
from letbook.plans import rooms, sales
from letbook.plans.inputs import (
    SITE,
    attempts_src,
    card_pages_src,
    detail_src,
    fetch_src,
    locations_src,
    paging_src,
    room_src,
    sale_src,
    series_src,
    table,
)
from letbook.session import keep, work_folder
from letbook.sinks.tables import write_shards, write_snapshot, write_url_list
from letbook.sources import ledgers, lists, pages, shards
from letbook.sql import run_sql
from letbook.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ntz(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


# ---- reports and SQL ---------------------------------------------------------------------


@query
def sale_from_pages(spark, sf_dir):
    """From detail pages to the report by area."""
    rows = shards.type_sale(sales.sale_run(detail_src(spark, sf_dir)))
    return reports.sale_by_postcode(rows)


@query
def sale_by_postcode(spark, sf_dir):
    return reports.sale_by_postcode(sale_src(spark, sf_dir))


@query
def room_by_postcode(spark, sf_dir):
    return reports.room_by_postcode(shards.type_room(room_src(spark, sf_dir)))


@query
def selection_count(spark, sf_dir):
    chosen = filters.Selection(
        postcode="n1", choices={"property_type": ["BUILDING", "MACHINERY"]}, ranges={"bedrooms": (0, 3)}
    )
    return reports.selection_count(chosen.apply(sale_src(spark, sf_dir)))


@query
def sql_surface(spark, sf_dir):
    text = f"""
        SELECT r.postcode, COUNT(*) AS rooms, AVG(r.price_norm) AS avg_price
        FROM {ROOM_VIEW} r
        WHERE EXISTS (SELECT 1 FROM {SALE_VIEW} s WHERE s.postcode = replace(r.postcode, 'R', 'N'))
        GROUP BY r.postcode
        ORDER BY rooms DESC, r.postcode
        LIMIT 20;
    """
    tables = {
        SALE_VIEW: shards.type_sale(sale_src(spark, sf_dir)),
        ROOM_VIEW: shards.type_room(room_src(spark, sf_dir)),
    }
    return run_sql(spark, text, tables)


@query
def location_lookup(spark, sf_dir):
    """Customers counted by the location and region their number stands for."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = reports.with_location(
        reports.with_location(customer, nation, "c_nationkey", "n_nationkey"), region, "n_regionkey", "r_regionkey"
    )
    return placed.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.avg(F.floor("c_acctbal")).alias("avg_balance")
    )


# ---- loading -----------------------------------------------------------------------------


def _sale_variants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as shards with text status and times, suppliers with number status and none."""
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(f"{SITE}/c/"), F.col("c_custkey").cast("string")).alias("url"),
        F.col("c_name").alias("address"),
        F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
        .otherwise("")
        .alias("postcode"),
        F.floor("c_acctbal").cast("bigint").alias("price"),
        (F.col("c_custkey") % 5).alias("bedrooms"),
        F.col("c_mktsegment").alias("property_type"),
        F.lit("").alias("floor_area"),
        F.when(F.col("c_custkey") % 9 == 0, "fail").otherwise("200").alias("status"),
        F.timestamp_add("MINUTE", F.col("c_custkey").cast("int"), F.lit("2023-11-14 22:13:20").cast("timestamp")).alias(
            "scraped_at"
        ),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(f"{SITE}/s/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.col("s_name").alias("address"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("postcode"),
        F.floor("s_acctbal").cast("bigint").alias("price"),
        F.when(F.col("s_suppkey") % 9 != 0, 200).cast("bigint").alias("status"),
    )
    return customer, supplier


def _sale_shards(spark: SparkSession, sf_dir: str) -> str:
    """Both generations as shards of one folder, told apart by nothing but their footers."""
    folder = work_folder(spark, "sale-shards")
    for rows in _sale_variants(spark, sf_dir):
        write_shards(rows, folder)
    return folder


@query
def load_sale(spark, sf_dir):
    """Shards of two generations in one folder, as the loader types them."""
    rows = shards.load_sale(spark, _sale_shards(spark, sf_dir))
    return rows.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


def _stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded shards stored typed by day, read as a table that takes filters into the scan."""
    folder = work_folder(spark, "sales")
    day = F.coalesce("scraped_at", F.lit("2023-01-01 00:00:00").cast("timestamp"))
    write_snapshot(shards.load_sale(spark, _sale_shards(spark, sf_dir)), folder, "full", day, sort_by=["postcode"])
    return shards.read_typed(spark, folder, schemas.SALE_TABLE)


@query
def sale_view(spark, sf_dir):
    """From shards on disk to a viewer's rows: loaded, stored typed, filtered in the scan, latest first."""
    chosen = filters.Selection("n1", {"property_type": ["BUILDING", "MACHINERY"]}, {"bedrooms": (0, 3), "price": (0, None)})
    rows = chosen.apply(_stored_sales(spark, sf_dir).where("snapshot_date >= DATE '2023-11-15'"))
    shown = filters.latest_first(rows, filters.SALE_COLUMNS)
    return shown.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


@query
def scan_promote(spark, sf_dir):
    """Two generations written as files and scanned back as one table."""
    customer, supplier = _sale_variants(spark, sf_dir)
    streamed, dated = work_folder(spark, "streamed"), work_folder(spark, "dated")
    write_shards(customer, streamed)
    write_shards(supplier, dated)
    rows = shards.union_by_name(
        [
            shards.scan_promoted(spark, streamed),
            shards.scan_promoted(spark, dated),
            shards.scan_promoted(spark, f"{dated}/none"),
        ]
    )
    return rows.select("url", "postcode", "price", "bedrooms", "property_type", "status", _ntz("scraped_at"))


@query
def load_room(spark, sf_dir):
    """Shards of which every second row comes with the misspelled location column, as the loader types them."""
    rows = room_src(spark, sf_dir)
    no = F.element_at(F.split("title", " "), -1).cast("bigint")
    legacy = rows.where(no % 2 == 0).withColumnRenamed("location", "locatiom")
    folder = work_folder(spark, "room-shards")
    for part in (rows.where(no % 2 == 1), legacy):
        write_shards(part, folder)
    typed = shards.load_room(spark, folder)
    return typed.drop("status").withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


@query
def coerce_numeric(spark, sf_dir):
    no = F.col("o_orderkey")
    given = (
        F.when(no % 5 == 0, "n/a")
        .when(no % 5 == 1, "")
        .when(no % 5 == 2, "12d")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", T.to_number(given).alias("price"))


@query
def coerce_time(spark, sf_dir):
    no = F.col("o_orderkey")
    given = (
        F.when(no % 4 == 0, "2024-13-45")
        .when(no % 4 == 1, "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.to_time(given).cast("timestamp_ntz").alias("scraped_at")
    )


@query
def normalize_sale(spark, sf_dir):
    no = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(f"{SITE}/properties/"), no.cast("string")).alias("url"),
        F.when(no % 3 != 0, F.col("o_orderpriority")).alias("address"),
        F.when(no % 4 == 0, "").when(no % 4 == 1, "studio").otherwise((no % 9).cast("string")).alias("bedrooms"),
        F.when(no % 17 != 0, F.floor("o_totalprice")).cast("bigint").alias("price"),
        F.when(no % 5 == 0, "fail").otherwise("200").alias("status"),
        "o_orderdate",
    )
    return shards.canonical_sale(rows, stamp=F.col("o_orderdate"))


@query
def sale_rejects(spark, sf_dir):
    no = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        no.alias("listing_no"),
        F.when(no % 4 == 0, "").when(no % 4 == 1, "studio").otherwise((no % 9).cast("string")).alias("bedrooms"),
        F.when(no % 6 != 0, F.col("o_totalprice").cast("string")).otherwise("ask").alias("price"),
    )
    return shards.sale_rejects(rows).select("listing_no")


@query
def normalize_room(spark, sf_dir):
    rows = room_src(spark, sf_dir).withColumn("status", F.when(F.length("postcode") == 2, 200))
    return shards.canonical_room(rows, ROOM_SOURCE, stamp=F.col("scraped_at"))


# ---- filters and orders ------------------------------------------------------------------


@query
def filter_prefix(spark, sf_dir):
    return filters.by_prefix(table(spark, sf_dir, "part"), "p_type", "eco")


@query
def filter_in(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("p_type", F.nullif("p_type", F.lit("SMALL")))
    return filters.by_choice(rows, "p_type", ["ECONOMY", "SMALL", "LARGE"])


@query
def filter_range(spark, sf_dir):
    rows = filters.by_range(table(spark, sf_dir, "part"), "p_size", 0, 25)
    return filters.by_range(rows, "p_retailprice", low=905.0)


@query
def filter_combined(spark, sf_dir):
    chosen = filters.Selection(
        postcode="N2",
        choices={"property_type": ["BUILDING", "AUTOMOBILE"]},
        ranges={"bedrooms": (1, 4), "price": (50_000, None)},
    )
    return chosen.apply(sale_src(spark, sf_dir)).select("url", "postcode", "price", "bedrooms", "property_type")


@query
def project_tolerant(spark, sf_dir):
    return filters.project(table(spark, sf_dir, "part"), ["p_brand", "no_such_column", "p_partkey", "p_size"])


@query
def facets(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#2")))
    return filters.facet(rows, "p_brand")


@query
def latest_sale(spark, sf_dir):
    rows = sale_src(spark, sf_dir).withColumn(
        "scraped_at", F.when(F.col("listing_no") % 10 != 0, F.col("scraped_at"))
    )
    return filters.latest_first(rows, filters.SALE_COLUMNS)


@query
def latest_room(spark, sf_dir):
    rows = room_src(spark, sf_dir).withColumn("price_norm", T.money(F.col("price_text")))
    return filters.latest_first(rows, filters.ROOM_COLUMNS)


# ---- scalar functions --------------------------------------------------------------------


@query
def money_extract(spark, sf_dir):
    no = F.col("o_orderkey")
    whole = T.grouped_number(F.floor("o_totalprice").cast("bigint"))
    given = (
        F.when(no % 7 == 0, "POA")
        .when(no % 7 == 1, "£,")
        .when(no % 7 == 2, F.concat(F.lit("from £"), whole, F.lit(".50 - £9 pw")))
        .otherwise(F.concat(F.lit("£"), whole, F.lit(" pcm")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", T.money(given).alias("price_norm"))


@query
def url_param(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        U.query_param(url, "page").alias("page"),
        U.query_param(url, "utm_source").alias("source"),
        U.query_param(F.concat(F.lit("/x?ref=&ref=a%20b+"), F.col("page_id").cast("string")), "ref").alias("ref"),
    )


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.regexp_extract_all("html", F.lit(f"({H.opening('a')})"), F.lit(1))
    anchors = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(tags).alias("tag"))
    return anchors.select("page_id", "url", H.attribute(F.col("tag"), "href").alias("href"))


@query
def url_absolute(spark, sf_dir):
    hrefs = _hrefs(spark, sf_dir)
    both = hrefs.select("page_id", "href").union(hrefs.select("page_id", F.col("url").alias("href")))
    return both.select("page_id", U.absolute(F.col("href"), SITE).alias("link")).distinct()


@query
def url_fragment(spark, sf_dir):
    path = F.regexp_extract("url", "^https?://[^/]*(.*)$", 1)
    return table(spark, sf_dir, "pages").select("page_id", U.without_fragment(path, SITE).alias("link"))


@query
def json_path(spark, sf_dir):
    """Present, missing and nested-missing leaves."""
    schema = "k string, deep struct<leaf: string>"
    props = F.from_json("props", schema)
    return table(spark, sf_dir, "events").select(
        "event_id", props.k.alias("k"), props.deep.leaf.alias("leaf"), T.digits_int(props.k).alias("k_int")
    )


@query
def first_truthy(spark, sf_dir):
    no = F.col("o_orderkey")
    first = F.when(no % 3 == 0, F.col("o_orderstatus")).when(no % 3 == 1, "")
    second = F.when(no % 2 == 0, F.col("o_orderpriority")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.first_truthy(first, second).alias("value"))


@query
def first_in_array(spark, sf_dir):
    no = F.col("o_orderkey")

    def sizing(text: Column) -> Column:
        return F.struct(text.alias("display"))

    items = F.when(
        no % 5 != 0,
        F.array(
            sizing(F.when(no % 2 == 0, F.col("o_orderstatus")).otherwise("")),
            sizing(F.when(no % 3 == 0, F.col("o_orderpriority"))),
        ),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", first_filled(items, "display").alias("floor_area"))


@query
def digits_int(spark, sf_dir):
    no = F.col("o_orderkey")
    text = no.cast("string")
    price = (
        F.when(no % 4 == 0, F.concat(text, F.lit(".0"))).when(no % 4 == 1, F.concat(F.lit("-"), text)).otherwise(text)
    )
    beds = F.when(no % 4 == 0, "3.7").when(no % 4 == 1, "studio").otherwise((no % 9).cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.digits_int(price).alias("price"), T.bedroom_count(beds).alias("bedrooms")
    )


@query
def postcode_compose(spark, sf_dir):
    no = F.col("o_orderkey")
    whole = F.when(no % 4 == 0, F.concat(F.lit("AB1 "), (no % 10).cast("string"))).when(no % 4 == 1, "")
    outcode = F.when(no % 3 != 0, "XY9")
    incode = F.when(no % 5 != 0, F.concat((no % 10).cast("string"), F.lit("ZZ")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.postcode_of(whole, outcode, incode).alias("postcode")
    )


@query
def result_total(spark, sf_dir):
    no = F.col("o_orderkey")
    total = T.grouped_number(F.floor("o_totalprice").cast("bigint"))
    html = F.when(no % 6 == 0, F.lit("<p>none</p>")).otherwise(
        F.concat(
            F.lit("<p>a</p><p class='navcurrent small'>Showing <strong>1-50</strong> of <strong><em> "),
            F.when(no % 6 == 1, "many").otherwise(total),
            F.lit("</em></strong> results</p>"),
        )
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", H.result_total(html).alias("total"))


@query
def location_list(spark, sf_dir):
    rows = locations_src(spark, sf_dir)
    twice = rows.unionByName(rows.withColumn("position", F.col("position") + 100))
    return lists.distinct_keys(twice, F.col("postcode"), F.col("position"))


@query
def location_csv(spark, sf_dir):
    """A location list written as CSV, a blank before its second header name, and read back."""
    folder = work_folder(spark, "locations")
    rows = locations_src(spark, sf_dir).select(F.col("outer_code").alias("OuterCode"), F.col("postcode").alias(" Postcode"))
    rows.write.option("header", True).csv(folder)
    return lists.location_list(spark, folder).select("key")


@query
def url_files(spark, sf_dir):
    """Failed URLs of two workers and a file of another name, read by the name pattern."""
    folder = work_folder(spark, "failed")
    failed = retry.final_failures(attempts_src(spark, sf_dir))
    part = F.length("url") % 3
    named = F.when(part == 0, "other").otherwise(F.concat(F.lit("failed_urls_worker"), part.cast("string")))
    for name in ("failed_urls_worker1", "failed_urls_worker2", "other"):
        write_url_list(failed.where(named == name), f"{folder}/worker={name}/{name}.txt")
    # each of the three is a folder of text parts, as Spark writes them
    return lists.read_url_list(spark, f"{folder}/*/failed_urls_worker*.txt", "*.txt")


@query
def ledger_state(spark, sf_dir):
    """Work states as JSON files over several lines, read as ledger events."""
    folder = work_folder(spark, "state")
    doc, good = F.col("doc_id"), F.col("quality") == 1
    states = table(spark, sf_dir, "labels").groupBy((doc % 16).alias("part")).agg(
        F.collect_list(F.when(good, doc.cast("string"))).alias("completed_postcodes"),
        F.collect_list(F.when(~good, doc.cast("string"))).alias("failed_postcodes"),
    )
    lines = F.replace(F.to_json(F.struct("completed_postcodes", "failed_postcodes")), F.lit(","), F.lit(",\n "))
    # a file per part, as a JSON file over several lines is one object
    states.repartition(16, "part").select("part", lines.alias("value")).write.partitionBy("part").text(folder)
    events = ledgers.state_events(spark, folder, "docs", "r0", F.lit("2024-05-01 00:00:00"))
    return events.select("source", "key", "status", "run_id")


@query
def location_ids(spark, sf_dir):
    return lists.location_ids(locations_src(spark, sf_dir), "outer_code").select("outer_code", "location_id")


@query
def search_urls(spark, sf_dir):
    plan = paging.sale_page_plan(lists.location_ids(locations_src(spark, sf_dir), "outer_code"))
    return plan.select(
        "outer_code",
        "page_idx",
        U.sale_search_url(F.col("location_id"), F.col("offset")).alias("sale_url"),
        U.sale_search_url(F.col("location_id"), F.col("offset"), by_location=False).alias("sale_url_dated"),
        U.room_search_url(T.clean_key(F.col("postcode")), F.col("page_idx") * 50).alias("room_url"),
    )


# ---- extraction --------------------------------------------------------------------------

LIST_LAYOUT = extract.CardLayout(
    tag="li",
    token=None,
    link_tag="a",
    link_token=None,
    parts=(extract.Part("title", "a"), extract.Part("strong", "strong")),
    domain=SITE,
    id_param="id",
)


@query
def card_fields(spark, sf_dir):
    """List items of web pages as cards."""
    return extract.cards(pages.over_all_cores(table(spark, sf_dir, "pages")), ["page_id"], LIST_LAYOUT).select(
        "page_id", "pos", "url", "title", "strong"
    )


@query
def room_cards(spark, sf_dir):
    """Room cards with adverts, comments, nested lists and entities around them."""
    cards = extract.room_cards(card_pages_src(spark, sf_dir))
    return cards.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


@query
def links_regex(spark, sf_dir):
    links = extract.links_by_pattern(F.col("html"), "/[A-Za-z]+", SITE)
    return extract.page_links(pages.over_all_cores(table(spark, sf_dir, "pages")), links, ["page_id"])


def _anchor_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = extract.links_by_anchor(F.col("html"), token=None, path="/", domain=SITE)
    return extract.page_links(pages.over_all_cores(table(spark, sf_dir, "pages")), links, ["page_id"])


@query
def links_anchor(spark, sf_dir):
    return _anchor_links(spark, sf_dir)


@query
def distinct_urls(spark, sf_dir):
    known = table(spark, sf_dir, "pages").select(F.concat(F.lit(f"{SITE}/"), F.col("page_id").cast("string")).alias("url"))
    return dedup.distinct_urls(_anchor_links(spark, sf_dir), known)


@query
def urls_per_key(spark, sf_dir):
    return dedup.urls_per_key(_anchor_links(spark, sf_dir), "page_id")


@query
def page_model_regex(spark, sf_dir):
    read = with_model(detail_src(spark, sf_dir), "pattern")
    return read.select("listing_no", *model_fields(F.col("model"), strict_price=False))


@query
def page_model_variant(spark, sf_dir):
    """The same fields out of a model whose shape is not given."""
    read = detail_src(spark, sf_dir).select("listing_no", page_variant(F.col("html")).alias("model"))
    return read.select("listing_no", *variant_fields(F.col("model"), strict_price=False))


@query
def model_paths(spark, sf_dir):
    """Nested, missing and mistyped leaves of the page model."""
    model = F.col("model")
    read = detail_src(spark, sf_dir).select("listing_no", page_variant(F.col("html")).alias("model"))
    return read.select(
        "listing_no",
        leaf(model, "propertyData.address.outcode").alias("outcode"),
        leaf(model, "propertyData.sizings[1].display").alias("second_size"),
        leaf(model, "propertyData.address.country").alias("no_leaf"),
        leaf(model, "propertyData.bedrooms.number").alias("below_a_leaf"),
        leaf(model, "propertyData.address.displayAddress", "int").alias("mistyped"),
        leaf(model, "propertyData.bedrooms", "int").alias("bedrooms"),
        leaf(model, "analyticsInfo.analyticsProperty.price", "double").alias("price"),
    )


@query
def page_model_balanced(spark, sf_dir):
    read = with_model(detail_src(spark, sf_dir), "braces")
    return read.select("listing_no", *model_fields(F.col("model")))


@query
def detail_rows(spark, sf_dir):
    rows = extract.detail_rows(detail_src(spark, sf_dir))
    return rows.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


@query
def pages_ok(spark, sf_dir):
    no = F.col("page_id")
    fetched = table(spark, sf_dir, "pages").withColumn(
        "http_status", F.when(no % 5 == 0, 404).when(no % 5 != 1, 200)
    )
    return pages.settle_pages(fetched).select(
        "page_id", "http_status", pages.has_html().alias("has_html"), F.length("html").alias("n_chars")
    )


# ---- paging ------------------------------------------------------------------------------


@query
def page_plan(spark, sf_dir):
    """Pages and offsets for each nation's customers; some totals are unknown or 0."""
    nation = F.col("c_nationkey")
    totals = (
        table(spark, sf_dir, "customer")
        .groupBy(nation)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.when(nation % 5 == 0, 0).when(nation % 5 != 1, F.col("n")))
    )
    return paging.room_page_plan(totals, F.col("total")).select("c_nationkey", "page_idx", "offset")


SMALL_SERIES = replace(paging.ROOM_SERIES, page_size=5)


@query
def page_truncate(spark, sf_dir):
    kept = paging.truncate(paging_src(spark, sf_dir), SMALL_SERIES, ["o_custkey"])
    return kept.select("o_custkey", "page_idx", "n_items")


@query
def page_truncate_sales(spark, sf_dir):
    """The sale form, with pages that came back without markup."""
    src = paging_src(spark, sf_dir).withColumn("has_html", F.col("http_status") == 200)
    kept = paging.truncate(src, replace(paging.SALE_SERIES, page_size=5), ["o_custkey"])
    return kept.select("o_custkey", "page_idx", "n_items")


@query
def status_tag(spark, sf_dir):
    src = paging_src(spark, sf_dir)
    rows = src.select("o_custkey", "page_idx", "first_order")
    return paging.tag_status(rows, src, ["o_custkey"])


# ---- whole runs --------------------------------------------------------------------------


THREE_CARDS = replace(paging.ROOM_SERIES, page_size=3)


def _room_run(spark: SparkSession, sf_dir: str) -> rooms.RoomRun:
    return rooms.room_run(series_src(spark, sf_dir), "r1", F.lit("2024-05-01 00:00:00"), rules=THREE_CARDS)


@query
def room_run(spark, sf_dir):
    """Search pages to deduplicated shard rows: users as locations of several pages."""
    return _room_run(spark, sf_dir).rows.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


@query
def room_events(spark, sf_dir):
    """The same run's ledger events."""
    return _room_run(spark, sf_dir).events.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query
def room_summary(spark, sf_dir):
    """The same run's counts, observed while its rows and events are written."""
    folder = work_folder(spark, "room-run")
    return rooms.write_rooms(_room_run(spark, sf_dir), f"{folder}/rows", f"{folder}/ledger")


@query
def room_stream(spark, sf_dir):
    """The same pages as a stream, in three parts and with a restart after each: the run's outcome beside its rows."""
    folder = work_folder(spark, "room-stream")
    inbox = f"{folder}/inbox"
    made = series_src(spark, sf_dir).select(
        "key",
        F.lit("search").alias("kind"),
        F.lit(None).cast("string").alias("url"),
        "page_idx",
        (F.col("page_idx") * 3).alias("offset"),
        "http_status",
        "html",
        "fetched_at",
    )
    src = keep(made, "series")
    for part in range(3):  # a location's pages lie in all of them
        src.where(F.pmod("page_idx", F.lit(3)) == part).write.mode("append").parquet(inbox)
        rooms.collect_rooms(
            pages.stream_pages(spark, inbox),
            f"{folder}/rows",
            f"{folder}/ledger",
            f"{folder}/checkpoint",
            "r1",
            F.lit("2024-05-01 00:00:00"),
            rules=THREE_CARDS,
            complete=part == 2,
        )
    rows = spark.read.schema(schemas.ROOM_LISTINGS).parquet(f"{folder}/rows")
    events = ledgers.read_ledger(spark, f"{folder}/ledger").select(F.col("key").alias("postcode"), F.col("status").alias("outcome"))
    return events.join(rows.select("postcode", "title", "url", "status"), "postcode", "left")


@query
def sale_links_run(spark, sf_dir):
    """Search pages to the links of each location, up to the end of its pages."""
    no = F.col("page_id")
    fetched = table(spark, sf_dir, "pages").select(
        (no % 20).alias("key"),
        F.floor(no / 20).cast("int").alias("page_idx"),
        F.lit(200).alias("http_status"),
        "html",
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    links = extract.links_by_anchor(F.col("html"), token=None, path="/", domain=SITE)
    return sales.collected_links(fetched, links, replace(paging.SALE_SERIES, page_size=5))


def _sale_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as search pages of twenty locations."""
    no = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        (no % 20).cast("string").alias("key"),
        F.floor(no / 20).cast("int").alias("page_idx"),
        F.lit(200).alias("http_status"),
        "html",
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


def _sale_collection(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two runs: over the first ten locations, then over what the ledger says is left."""
    folder = work_folder(spark, "sale-collection")
    urls, events = f"{folder}/urls", f"{folder}/ledger"
    search = _sale_search(spark, sf_dir)
    places = spark.range(20).select(F.col("id").cast("string").alias("key"), F.col("id").alias("position"))
    how = {
        "links": extract.links_by_anchor(F.col("html"), token=None, path="/", domain=SITE),
        "rules": replace(paging.SALE_SERIES, page_size=5),
    }
    for run_id, limit in (("r1", 10), ("r2", None)):
        done = ledger.completed(ledgers.read_ledger(spark, events)).select("key")
        left = ledger.remaining(ledger.first_items(places, limit), done)
        at = F.lit("2024-05-01 00:00:00")
        sales.write_collection(spark, search.join(left, "key", "left_semi"), urls, events, run_id, at, **how)
    return sales.collected_urls(spark, urls), ledgers.read_ledger(spark, events)


@query
def sale_collection(spark, sf_dir):
    """URLs that two runs collected, each with the run that met it first."""
    return _sale_collection(spark, sf_dir)[0]


@query
def sale_collection_events(spark, sf_dir):
    """Locations that the two runs completed."""
    return _sale_collection(spark, sf_dir)[1].drop("updated_at")


def _retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages fetched in up to three passes, the run stopped after the second and called again."""
    folder = work_folder(spark, "sale-retry")
    details = detail_src(spark, sf_dir)
    no = F.col("listing_no")

    def fetch(urls: DataFrame, pass_no: int) -> DataFrame:
        status = F.when(no % (19 * 2 ** (pass_no - 1)) == 0, 503).otherwise(200)
        return details.join(urls, "url", "left_semi").withColumn("http_status", status)

    urls = sale_src(spark, sf_dir).select("url")
    sales.retry_run(urls, fetch, folder, last=2)
    return sales.retry_run(urls, fetch, folder)


@query
def sale_retry_run(spark, sf_dir):
    """The row that counts of every URL after all passes."""
    rows = sales.resolved(_retried(spark, sf_dir))
    return rows.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


@query
def sale_retry_failures(spark, sf_dir):
    """URLs that failed in all three passes."""
    return retry.final_failures(_retried(spark, sf_dir))


# ---- duplicates --------------------------------------------------------------------------


@query
def dedup_listing(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem")
    return dedup.first_listing(rows, keys, [c for c in rows.columns if c not in keys])


@query
def dedup_counts(spark, sf_dir):
    return dedup.repeats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedup_url(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn(
        "url", F.when(F.col("o_orderkey") % 8 != 0, F.date_format("o_orderdate", "yyyy-MM"))
    )
    return dedup.first_url(rows, "o_custkey", ["o_orderkey"])


# ---- ledger and retry --------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(doc.cast("string").alias("key"), doc.alias("position"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the labelled documents: quality decides the first, toxicity the second."""
    labels = table(spark, sf_dir, "labels")

    def run(rows: DataFrame, done: Column, run_id: str, at: str) -> DataFrame:
        outcome = rows.withColumn("status", F.when(done, "completed").otherwise("failed"))
        return ledger.to_events(outcome, "docs", "doc_id", run_id, F.lit(at))

    again = labels.where(F.col("doc_id") % 3 == 0)
    own = run(labels, F.col("quality") == 1, "r1", "1970-01-01 00:16:40").unionByName(
        run(again, F.col("toxic") == 0, "r2", "1970-01-01 00:33:20")
    )
    # another source that shares keys
    even = labels.where(F.col("doc_id") % 2 == 0).withColumn("status", F.lit("completed"))
    return own.unionByName(ledger.to_events(even, "other", "doc_id", "r1", F.lit("1970-01-01 00:50:00")))


@query
def remaining_work(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"))
    return ledger.remaining(_documents(spark, sf_dir), done)


@query
def work_limit(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"))
    return ledger.remaining(ledger.first_items(_documents(spark, sf_dir), 200), done)


@query
def ledger_read(spark, sf_dir):
    """Events appended run by run, read back; a ledger that is not there is empty."""
    folder = work_folder(spark, "ledger")
    events = _events(spark, sf_dir)
    for run_id in ("r1", "r2"):
        ledgers.append_ledger(events.where(F.col("run_id") == run_id), folder)
    both = ledgers.read_ledger(spark, folder).unionByName(ledgers.read_ledger(spark, f"{folder}-none"))
    return both.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query
def ledger_update(spark, sf_dir):
    now = ledger.current(_events(spark, sf_dir))
    return now.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query
def ledger_completed(spark, sf_dir):
    return ledger.sorted_completed(_events(spark, sf_dir))


@query
def retry_mode(spark, sf_dir):
    return ledger.work_list(_documents(spark, sf_dir), _events(spark, sf_dir), "docs", retry_failed=True)


@query
def work_list_plain(spark, sf_dir):
    return ledger.work_list(_documents(spark, sf_dir), _events(spark, sf_dir), "docs")


@query
def room_outcomes(spark, sf_dir):
    src = paging_src(spark, sf_dir).withColumn("has_html", F.col("http_status") == 200)
    return ledger.room_outcomes(paging.visited(src, SMALL_SERIES, ["o_custkey"]), ["o_custkey"])


@query
def retry_set(spark, sf_dir):
    return retry.retry_sets(attempts_src(spark, sf_dir))


@query
def final_failures(spark, sf_dir):
    return retry.final_failures(attempts_src(spark, sf_dir))


@query
def resolve_attempts(spark, sf_dir):
    return retry.resolve_attempts(attempts_src(spark, sf_dir))


@query
def failure_classes(spark, sf_dir):
    return retry.failure_classes(attempts_src(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return retry.run_summary(attempts_src(spark, sf_dir), ["url"])


@query
def url_list(spark, sf_dir):
    """Failed URLs written one per line, and lines with blanks, read back as a list."""
    folder = work_folder(spark, "urls")
    write_url_list(retry.final_failures(attempts_src(spark, sf_dir)), folder)
    lines = spark.read.text(folder)
    padded = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit(" \t"), F.col("event_type"), F.lit("  ")))
        .otherwise("  ")
        .alias("value")
    )
    return lists.url_list(lines.unionByName(padded))


# ---- crawl health ------------------------------------------------------------------------

_BY_WORKER = ["worker"]
_BY_TIME = ["finished_at", "event_id"]


@query
def rolling_latency(spark, sf_dir):
    log = health.rolling_latency(fetch_src(spark, sf_dir), _BY_WORKER, _BY_TIME)
    return log.select("event_id", "mean_latency")


@query
def error_rate(spark, sf_dir):
    log = health.error_rate(fetch_src(spark, sf_dir), _BY_WORKER, _BY_TIME)
    return log.select("event_id", "done", "errors", "error_rate")


def _progress(rule: health.EtaRule, spark: SparkSession, sf_dir: str) -> DataFrame:
    log = health.progress(fetch_src(spark, sf_dir), rule, _BY_WORKER, _BY_TIME)
    return log.select(
        "event_id",
        "done",
        "total",
        "fraction",
        "elapsed_s",
        "eta_s",
        "eta_text",
    )


@query
def progress_eta(spark, sf_dir):
    return _progress(health.DETAIL_ETA_DATED, spark, sf_dir)


@query
def progress_eta_urls(spark, sf_dir):
    return _progress(health.URL_ETA, spark, sf_dir)


@query
def progress_eta_rooms(spark, sf_dir):
    return _progress(health.ROOM_ETA, spark, sf_dir)


@query
def load_signal(spark, sf_dir):
    log = health.load_signal(fetch_src(spark, sf_dir), health.STREAMED_LOAD, _BY_WORKER, _BY_TIME)
    return log.select("event_id", "done", "signal")


@query
def work_chunks(spark, sf_dir):
    return health.work_chunks(table(spark, sf_dir, "orders"), 8, "o_orderkey", position="o_orderkey").select(
        "o_orderkey", "chunk"
    )


# ---- sinks and streams -------------------------------------------------------------------


@query
def shard_sink(spark, sf_dir):
    """Rows per file of written shards: the total and the number of files over the limit."""
    folder = work_folder(spark, "shards")
    write_shards(sale_src(spark, sf_dir), folder)
    per_file = (
        spark.read.parquet(folder)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("listing_no").alias("s"))
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.sum("s").alias("sum_no"), F.count_if(F.col("n") > 5000).alias("over_limit")
    )


@query
def snapshot_sink(spark, sf_dir):
    """Two runs appended to a dated table, counted by day and run."""
    folder = work_folder(spark, "snapshot")
    rows = sale_src(spark, sf_dir)
    at = F.date_trunc("year", "scraped_at")
    write_snapshot(rows, folder, "full", at)
    write_snapshot(rows.where(F.col("price").isNull()), folder, "retry", at)
    return (
        spark.read.schema("listing_no bigint, snapshot_date string, run_id string")
        .parquet(folder)
        .groupBy("snapshot_date", "run_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("listing_no").alias("sum_no"))
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_shards(spark, sf_dir):
    folder = work_folder(spark, "stream")
    jobs.shard_stream(_event_stream(spark, sf_dir), f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_id")
    )


@query
def stream_dedup(spark, sf_dir):
    folder = work_folder(spark, "dedup")
    keys = ["event_type", "user_id"]
    stream = _event_stream(spark, sf_dir)
    jobs.dedup_exact(stream, f"{folder}/rows", f"{folder}/checkpoint", keys, ["ts", "event_id"])
    rows = spark.read.schema(stream.schema).parquet(f"{folder}/rows")
    return rows.select("event_type", "user_id", "event_id")


@query
def stream_dedup_state(spark, sf_dir):
    """The same keys from the state store, hot keys thinned out in slices first."""
    folder = work_folder(spark, "dedup-state")
    keys = ["event_type", "user_id"]
    stream = _event_stream(spark, sf_dir)
    unique = jobs.dedup_stateful(stream, keys, delay=None, spread_by=["event_id"])
    jobs.shard_stream(unique.select(*keys), f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows")


@query
def stream_resume(spark, sf_dir):
    """Half of the input, a stop, the other half under the same checkpoint."""
    folder = work_folder(spark, "resume")
    rows = table(spark, sf_dir, "orders")
    inbox = f"{folder}/inbox"
    for parity in (0, 1):
        rows.where(F.col("o_orderkey") % 2 == parity).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(inbox)
        jobs.collect_with_ledger(
            stream,
            f"{folder}/rows",
            f"{folder}/ledger",
            f"{folder}/checkpoint",
            lambda batch: batch.select("o_orderkey", "o_orderstatus"),
            lambda batch: batch.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")),
        )
    kept = spark.read.schema("o_orderkey bigint, o_orderstatus string").parquet(f"{folder}/rows")
    logged = spark.read.schema("o_orderstatus string, n_rows bigint").parquet(f"{folder}/ledger")
    counts = kept.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")
    )
    totals = logged.groupBy("o_orderstatus").agg(F.sum("n_rows").alias("n_logged"))
    return counts.join(totals, "o_orderstatus")
