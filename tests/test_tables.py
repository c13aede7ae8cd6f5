"""Filters, reports, duplicates, skewed joins, SQL."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from letbook import sql
from letbook.fixed import ROOM_VIEW, SALE_VIEW
from letbook.operators import dedup, filters, reports, skew

AT = dt.datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            ("AB1", 100.0, 0.0, "Flat", "u1", AT),
            ("AB1", None, 2.0, "House", "u2", None),
            ("ab1", 300.0, None, None, "u3", AT.replace(day=2)),
            (None, 50.0, 3.0, "Flat", "u4", AT),
            ("A.1", 0.0, 1.0, "Flat", "u5", None),
        ],
        "postcode string, price double, bedrooms double, property_type string, url string, scraped_at timestamp",
    )


def urls(rows):
    return sorted(r.url for r in rows.collect())


def test_prefix(sales):
    assert urls(filters.by_prefix(sales, "postcode", "ab")) == ["u1", "u2"]
    assert urls(filters.by_prefix(sales, "postcode", "a.")) == ["u5"]
    assert filters.by_prefix(sales, "postcode", "").count() == 5
    assert filters.by_prefix(sales, "postcode", None).count() == 5


def test_choice(sales):
    assert urls(filters.by_choice(sales, "property_type", ["Flat"])) == ["u1", "u4", "u5"]
    assert filters.by_choice(sales, "property_type", []).count() == 5


def test_range(sales):
    assert urls(filters.by_range(sales, "price", low=0)) == ["u1", "u3", "u4", "u5"]
    assert urls(filters.by_range(sales, "price", 0, 50)) == ["u4", "u5"]
    assert urls(filters.by_range(sales, "bedrooms", high=0)) == ["u1"]
    assert filters.by_range(sales, "bedrooms").count() == 5


def test_selection(sales):
    chosen = filters.Selection("a", {"property_type": ["Flat"]}, {"price": (0, None), "bedrooms": (None, 0)})
    assert urls(chosen.apply(sales)) == ["u1"]
    assert filters.Selection().apply(sales).count() == 5


def test_project_and_facets(sales):
    assert filters.project(sales, filters.SALE_COLUMNS).columns == [
        "postcode", "price", "bedrooms", "property_type", "url", "scraped_at",
    ]
    assert [r.property_type for r in filters.facet(sales, "property_type").collect()] == ["Flat", "House"]


def test_latest_first(sales):
    got = filters.latest_first(sales, filters.SALE_COLUMNS)
    assert [r.url for r in got.collect()] == ["u3", "u1", "u4", "u2", "u5"]
    assert [r.url for r in filters.latest_first(sales, filters.SALE_COLUMNS, limit=2).collect()] == ["u3", "u1"]


def test_report(sales):
    got = [tuple(r) for r in reports.sale_by_postcode(sales).collect()]
    assert got == [("AB1", 2, 100.0), ("A.1", 1, 0.0), ("ab1", 1, 300.0), (None, 1, 50.0)]
    assert reports.sale_by_postcode(sales, top=1).count() == 1
    assert reports.selection_count(sales).first().listings == 5


def test_plans_push_and_limit(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")

    def plan(rows):
        return rows._jdf.queryExecution().executedPlan().toString()

    combined = filters.by_range(filters.by_choice(filters.by_prefix(part, "p_type", "e"), "p_brand", ["a", "b"]), "p_size", 1, 9)
    pushed = plan(combined.select("p_partkey"))
    for piece in ("StringStartsWith(p_type,E)", "In(p_brand, [a,b])", "GreaterThanOrEqual(p_size,1)", "LessThanOrEqual(p_size,9)"):
        assert piece in pushed
    assert "p_name" not in pushed.split("ReadSchema")[1]
    report = plan(reports.by_area(part, "p_size", "n", area="p_type"))
    assert "TakeOrderedAndProject" in report and "partial_count" in report
    first = plan(dedup.first_per_key(part, ["p_brand"], ["p_partkey"]))
    assert first.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(filters.latest_first(part, ["p_size", "p_partkey"], "p_size", "p_partkey", 5))


CARD = "source string, flatshare_id string, postcode string, url string, fetched_at timestamp, page_idx int, pos int"


def test_first_listing(spark):
    rng = random.Random(1)
    cards = []
    for i in range(600):
        hot = rng.random() < 0.4
        cards.append(
            (
                "s",
                "7" if hot else rng.choice([None, "", "1", "2", "3", "4"]),
                "AB1" if hot else rng.choice([None, "", "AB1", "AB2"]),
                f"u{i}",
                AT + dt.timedelta(seconds=rng.randrange(5)),
                rng.randrange(3),
                i,
            )
        )
    want = {}
    for c in sorted(cards, key=lambda c: (c[4], c[5], c[6])):
        if c[1] and c[2]:
            want.setdefault((c[1], c[2]), c[3])
    rows = spark.createDataFrame(cards, CARD).repartition(7)
    got = dedup.first_listing(rows).collect()
    assert {(r.flatshare_id, r.postcode): r.url for r in got} == want and len(got) == len(want)
    keyed = dedup.with_keys(rows, dedup.LISTING_KEYS)
    n = keyed.count()
    assert tuple(dedup.repeats(keyed, dedup.LISTING_KEYS).first()) == (n, len(want), n - len(want))


def test_first_url(spark):
    rows = spark.createDataFrame(
        [("a", "u1", 1), ("a", "u1", 0), ("b", "u1", 2), ("a", None, 3), ("a", "", 4)], "key string, url string, pos int"
    )
    got = dedup.first_url(rows, "key", ["pos"]).collect()
    assert sorted((r.key, r.url, r.pos) for r in got) == [("a", "u1", 0), ("b", "u1", 2)]


def test_urls(spark):
    links = spark.createDataFrame([("a", "u1"), ("a", "u1"), ("a", "u2"), ("b", "u1")], "key string, url string")
    assert sorted(r.url for r in dedup.distinct_urls(links, links.where("key = 'b'")).collect()) == ["u1", "u2"]
    assert {r.key: r.n_urls for r in dedup.urls_per_key(links, "key").collect()} == {"a": 2, "b": 1}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_attach(spark, threshold):
    """The same rows come back whether facts are broadcast or not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        keys = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise((F.col("id") % 40).cast("string"))
        rows = spark.range(3000).withColumn("key", keys)
        facts = rows.groupBy("key").agg(F.max("id").alias("top")).where(
            "key is null or key <> '7'"
        )
        got = skew.attach(rows, facts, ["key"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {}
    given = rows.collect()
    for r in given:
        if r.key != "7":
            want[r.key] = max(want.get(r.key, 0), r.id)
    assert sorted((r.id, r.top) for r in got if r.top is not None) == sorted(
        (r.id, want[r.key]) for r in given if r.key != "7"
    )
    assert len(got) == 3000 and set(got[0].asDict()) == {"id", "key", "top"}


def test_run_sql(spark, sales):
    text = f"SELECT postcode, COUNT(*) AS listings, AVG(price) AS avg_price\nFROM {SALE_VIEW}\nGROUP BY postcode\nORDER BY listings DESC\nLIMIT 1;"
    assert [tuple(r) for r in sql.run_sql(spark, text, {SALE_VIEW: sales}).collect()] == [("AB1", 2, 100.0)]
    with pytest.raises(AnalysisException):
        spark.table(SALE_VIEW)


def test_run_sql_keeps_other_views(spark, sales):
    spark.range(3).createOrReplaceTempView(SALE_VIEW)
    try:
        assert sql.run_sql(spark, f"SELECT 1 AS x FROM {SALE_VIEW} -- all", {SALE_VIEW: sales}).count() == 5
        assert spark.table(SALE_VIEW).count() == 3
    finally:
        spark.catalog.dropTempView(SALE_VIEW)


@pytest.mark.parametrize("text", ["DROP TABLE t", "CREATE TABLE t (a int)", "INSERT INTO t VALUES (1)", "SELEC 1"])
def test_run_sql_takes_queries_only(spark, text):
    with pytest.raises(ParseException):
        sql.run_sql(spark, text, {})


def test_register_listings(spark, sales):
    empty = spark.createDataFrame([], "postcode string, price_norm bigint")
    sql.register_listings(sales, empty)
    try:
        assert spark.table("sale_listings").count() == spark.table(SALE_VIEW).count() == 5
        assert spark.table(ROOM_VIEW).count() == spark.table("room_listings").count() == 0
    finally:
        for name in ("sale_listings", SALE_VIEW, "room_listings", ROOM_VIEW):
            spark.catalog.dropTempView(name)


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from letbook.sinks.tables import write_snapshot

    path, day = str(tmp_path / "snapshots"), F.lit(dt.datetime(2024, 5, 1))
    for run_id, n in (("r1", 5), ("r2", 3), ("r1", 5), ("r1", 4)):
        write_snapshot(spark.range(n), path, run_id, day)
    got = spark.read.parquet(path).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in got} == {"r1": 4, "r2": 3}
