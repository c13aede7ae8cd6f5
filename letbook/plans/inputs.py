"""Listing-shaped inputs, derived in Spark from the star-schema tables.

Each has a twin of the same name in `oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from letbook.operators.running import running
from letbook.sources.pages import over_all_cores

SITE = "https://example.test"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sale_src(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Orders as sale listings; every 17th has no price."""
    orders = table(spark, sf_dir, "orders")
    if spread:
        orders = over_all_cores(orders)
    customer = table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.concat(F.lit(f"{SITE}/properties/"), key.cast("string")).alias("url"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("postcode"),
        F.when(key % 17 != 0, F.floor("o_totalprice")).cast("bigint").alias("price"),
        (key % 6).cast("int").alias("bedrooms"),
        F.col("c_mktsegment").alias("property_type"),
        F.col("c_name").alias("address"),
        F.col("o_orderdate").alias("scraped_at"),
        key.alias("listing_no"),
    )


def room_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rooms; every 13th has no price in figures."""
    pounds = F.concat(F.lit("£"), F.floor("value").cast("string"), F.lit(" pcm"))
    return table(spark, sf_dir, "events").select(
        F.lit("rooms").alias("source"),
        F.concat(F.lit("R"), (F.col("user_id") % 40).cast("string")).alias("postcode"),
        F.concat(F.lit("Room "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit(f"{SITE}/rooms/"), F.col("event_id").cast("string")).alias("url"),
        F.when(F.col("event_id") % 13 == 0, "POA").otherwise(pounds).alias("price_text"),
        F.concat(F.lit("Area "), (F.col("user_id") % 40).cast("string")).alias("location"),
        F.col("event_type").alias("room_type"),
        F.when(F.col("event_id") % 5 != 0, "Available now").alias("available"),
        F.col("ts").alias("scraped_at"),
    )


def _model_json(rows: DataFrame) -> DataFrame:
    """Sale rows with the JSON model their detail page embeds.

    Price comes as a number, as text, as a fraction or not at all; the postcode as a whole or
    in parts; floor areas with an empty one first.
    """
    no = F.col("listing_no")
    whole = F.col("price").cast("string")
    price = (
        F.when(F.col("price").isNull(), F.lit("null"))
        .when(no % 5 == 0, F.concat(F.lit('"'), whole, F.lit('"')))
        .when(no % 5 == 1, F.concat(whole, F.lit(".0")))
        .otherwise(whole)
    )
    whole_code = F.when(no % 3 == 0, F.concat(F.lit('"'), F.col("postcode"), F.lit('"'))).otherwise(F.lit('""'))
    area = F.when(no % 4 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit('[{"display":""},{"display":"'), (no % 90).cast("string"), F.lit(' sq m"}]'))
    )
    model = F.concat(
        F.lit('{"propertyData":{"address":{"displayAddress":"'),
        F.col("address"),
        F.lit('","outcode":"'),
        F.col("postcode"),
        F.lit('","incode":"'),
        (no % 7).cast("string"),
        F.lit('XX"},"bedrooms":'),
        F.col("bedrooms").cast("string"),
        F.lit(',"propertySubType":'),
        F.when(no % 2 == 0, F.lit("null")).otherwise(F.lit('"Flat"')),
        F.lit(',"propertyType":"'),
        F.col("property_type"),
        F.lit('","sizings":'),
        area,
        F.lit('},"analyticsInfo":{"analyticsProperty":{"postcode":'),
        whole_code,
        F.lit(',"price":'),
        price,
        F.lit("}}}"),
    )
    return rows.withColumn("model", model)


def detail_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale rows as detail pages; every 19th fetch failed and every 23rd page has no model."""
    no = F.col("listing_no")
    html = F.concat(
        F.lit("<html><head><title>"),
        F.col("address"),
        F.lit("</title>\n<script>window.other = {};</script>"),
        F.when(
            no % 23 != 0,
            F.concat(F.lit("<script>window.PAGE_MODEL = "), F.col("model"), F.lit(";</script>")),
        ).otherwise(F.lit("")),
        F.lit("</head><body><p>{text}</p></body></html>"),
    )
    return _model_json(sale_src(spark, sf_dir, spread=True)).select(
        "url",
        "listing_no",
        F.when(no % 19 == 0, 503).otherwise(200).alias("http_status"),
        html.alias("html"),
        F.col("scraped_at").cast("timestamp").alias("fetched_at"),
    )


def card_pages_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a search page with one card, a look-alike advert and a card in a comment."""
    no = F.col("event_id").cast("string")
    price = F.when(
        F.col("event_id") % 13 != 0,
        F.concat(
            F.lit('<p class="listing-card__price"><strong>&pound;'),
            F.floor("value").cast("string"),
            F.lit("</strong> <abbr>pcm</abbr></p>"),
        ),
    ).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<ul><li class="listing-result-ad"><a class="listing-card__link" href="/ad">Ad</a></li>'),
        F.lit("<!-- <li class='listing-result'>old</li> -->"),
        F.lit('<li data-n="1" class="panel listing-result"><h2 class="listing-card__title"> Room &amp; bath '),
        no,
        F.lit('</h2><a href="/flatshare/detail.pl?flatshare_id='),
        no,
        F.lit('&amp;search=x" class="listing-card__link main">More</a>'),
        price,
        F.lit('<ul><li class="tag">tag</li></ul><p class="listing-card__location">'),
        F.col("event_type"),
        F.lit('<br> area</p><span class="listing-card__room"><span>Double</span> room</span></li></ul>'),
        F.lit('<span class="listing-card__availability">Now</span>'),
    )
    return over_all_cores(table(spark, sf_dir, "events")).select(
        F.concat(F.lit("R"), (F.col("user_id") % 40).cast("string")).alias("key"),
        F.lit(0).alias("page_idx"),
        F.col("ts").alias("fetched_at"),
        html.alias("html"),
    )


def paging_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as result pages of five; every 7th order is no item, so pages run short."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    numbered = running(orders, ["o_custkey"], ["o_orderkey"], {})
    return (
        numbered.withColumn("page_idx", F.floor((F.col("done") - 1) / 5).cast("int"))
        .groupBy("o_custkey", "page_idx")
        .agg(F.count_if(F.col("o_orderkey") % 7 != 0).alias("n_items"), F.min("o_orderkey").alias("first_order"))
        .withColumn(
            "http_status",
            F.when(F.col("first_order") % 11 == 0, 503)
            .when(F.col("first_order") % 13 == 0, 0)
            .otherwise(200),
        )
        .withColumn("has_html", F.lit(True))
    )


def attempts_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user and day as passes over URLs, three events to a URL."""
    events = table(spark, sf_dir, "events").select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd")
        ).alias("series"),
        "ts",
        "event_id",
        "event_type",
        "value",
    )
    order = Window.partitionBy("series").orderBy("ts", "event_id")
    numbered = events.withColumn("place", F.row_number().over(order) - 1)
    ok = F.col("event_type") != "error"
    code = (
        F.when(ok, "200").when(F.col("event_id") % 3 == 0, "429").when(F.col("event_id") % 3 == 1, "404")
    ).otherwise("fail")
    return numbered.select(
        F.concat_ws("-", "series", F.floor(F.col("place") / 3).cast("string")).alias("url"),
        (F.col("place") % 3 + 1).cast("int").alias("pass_no"),
        code.alias("http_status"),
        "ts",
        "event_id",
        "value",
    )


def fetch_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a fetch log, one worker per event type; every 70th fetch failed, every 90th has no latency."""
    no = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("worker"),
        no,
        F.when(no % 90 != 0, F.col("value") / 1000).alias("latency_s"),
        F.when(no % 70 == 0, 503).otherwise(200).alias("http_status"),
        F.col("ts").alias("finished_at"),
    )


def locations_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a location list."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("outer_code"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("postcode"),
        F.col("n_nationkey").cast("bigint").alias("position"),
        "n_regionkey",
    )


def series_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as search pages of three cards, some short, failed or fetched twice.

    Every ninth event gives no card, so pages run short; ids and URLs come back within a user. A page whose first
    event is a multiple of 11 failed, of 13 got no answer; of 5, it was fetched before, without success.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    numbered = running(events, ["user_id"], ["ts", "event_id"], {})
    no = F.col("event_id")
    price = F.when(
        no % 13 != 0,
        F.concat(F.lit('<p class="listing-card__price">&pound;'), F.floor("value").cast("string"), F.lit(" <abbr>pcm</abbr></p>")),
    ).otherwise(F.lit(""))
    card = F.concat(
        F.lit('<li class="listing-result"><h2 class="listing-card__title">Room '),
        no.cast("string"),
        F.lit('</h2><a class="listing-card__link" href="/flatshare/detail.pl?flatshare_id='),
        (no % 6).cast("string"),
        F.lit("&amp;search="),
        (F.floor(no / 6) % 2).cast("string"),
        F.lit('">More</a>'),
        price,
        F.lit('<p class="listing-card__location">'),
        F.col("event_type"),
        F.lit("</p></li>"),
    )
    cards = F.array_sort(F.collect_list(F.when(no % 9 != 0, F.struct("done", card.alias("card")))))
    found = (
        numbered.withColumn("page_idx", F.floor((F.col("done") - 1) / 3).cast("int"))
        .groupBy(F.col("user_id").cast("string").alias("key"), "page_idx", "total")
        .agg(cards.alias("cards"), F.min("event_id").alias("first"), F.max("ts").cast("timestamp").alias("fetched_at"))
    )
    html = F.concat(
        F.lit('<p class="navcurrent">Showing <strong>1-3</strong> of <strong>'),
        F.col("total").cast("string"),
        F.lit("</strong></p><ul>"),
        F.array_join(F.transform("cards", lambda c: c["card"]), ""),
        F.lit("</ul>"),
    )
    status = F.when(F.col("first") % 11 == 0, 503).when(F.col("first") % 13 == 0, 0).otherwise(200)
    fetched = found.select("key", "page_idx", status.alias("http_status"), html.alias("html"), "fetched_at", "first")
    before = fetched.where("first % 5 = 0").withColumns(
        {"http_status": F.lit(503), "html": F.lit(None).cast("string"), "fetched_at": F.col("fetched_at") - F.expr("INTERVAL 1 MINUTE")}
    )
    return fetched.unionByName(before).drop("first")
