import datetime as dt
import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from letbook import schemas
from letbook.fixed import DATED_FILES, ROOM_SOURCE
from letbook.operators import filters
from letbook.sinks.tables import write_shards, write_snapshot, write_url_list
from letbook.sources import ledgers, lists, pages, shards

UTC = dt.timezone.utc
AT = dt.datetime(2024, 5, 1, 12, 0, 0, 123456, tzinfo=UTC)


def write(path, rows, schema):
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), path, compression=None)


def sale_schema(status, unit="us", stamped=True):
    fields = [
        ("url", pa.string()), ("address", pa.string()), ("postcode", pa.string()), ("price", pa.int64()),
        ("bedrooms", pa.int64()), ("property_type", pa.string()), ("floor_area", pa.string()), ("status", status),
    ]
    return pa.schema(fields + ([("scraped_at", pa.timestamp(unit, "UTC"))] if stamped else []))


def sale(url, **more):
    row = dict(url=url, address="a", postcode="AB1 2CD", price=100, bedrooms=2, property_type="Flat", floor_area="")
    return {**row, **more}


@pytest.fixture
def sale_folder(tmp_path):
    write(
        tmp_path / "shard_1.parquet",
        [sale("u1", status="200", scraped_at=AT), sale("u2", status="fail", address="", price=None, scraped_at=AT)],
        sale_schema(pa.string()),
    )
    write(tmp_path / "shard_2.parquet", [], sale_schema(pa.string()))
    write(
        tmp_path / DATED_FILES.replace("*", "2024-05-01"),
        [sale("u3", status=200), sale("u4", status=None, bedrooms=None)],
        sale_schema(pa.int64(), stamped=False),
    )
    (tmp_path / "notes.txt").write_text("x")
    return str(tmp_path)


def test_load_sale_over_generations(spark, sale_folder):
    rows = {r.url: r for r in shards.load_sale(spark, sale_folder).collect()}
    assert sorted(rows) == ["u1", "u2", "u3", "u4"]
    assert [rows[u].status for u in sorted(rows)] == [200, None, 200, None]
    assert rows["u1"].scraped_at.replace(tzinfo=UTC) == AT and rows["u3"].scraped_at is None
    assert rows["u2"].address is None and rows["u2"].price is None
    assert rows["u1"].price == 100.0 and rows["u4"].bedrooms is None


def test_known_layouts_need_no_footers(spark, sale_folder):
    known = [shards.SALE_STREAMED, shards.SALE_DATED]
    by_name = shards.load_sale(spark, sale_folder, known)
    assert sorted(map(str, by_name.collect())) == sorted(map(str, shards.load_sale(spark, sale_folder).collect()))


def test_discover(spark, sale_folder):
    found = shards.discover(spark, sale_folder)
    assert sorted(len(v.paths) for v in found) == [1, 1]
    assert shards.scan_promoted(spark, sale_folder).schema["status"].dataType.simpleString() == "int"


def pandas_shard(path, rows):
    pq.write_table(pa.Table.from_pandas(pd.DataFrame(rows), preserve_index=False), path, compression=None)


def test_shards_as_pandas_types_them(spark, tmp_path):
    """Missing values make whole numbers fractions, empty columns have no type, times are
    nanoseconds: every shard of a folder can differ."""
    at = pd.Timestamp(AT).as_unit("ns")
    pandas_shard(tmp_path / "shard_1.parquet", [sale("u1", status="200", scraped_at=at)])
    pandas_shard(
        tmp_path / "shard_2.parquet",
        [sale("u2", status="200", price=None, scraped_at=at), sale("u3", status="fail", scraped_at=at)],
    )
    pandas_shard(
        tmp_path / DATED_FILES.replace("*", "1"),
        [sale("u4", status=200, bedrooms=None, floor_area=None), sale("u5", status=None, bedrooms=None, floor_area=None)],
    )
    pandas_shard(tmp_path / DATED_FILES.replace("*", "2"), [sale("u6", status=404, price="POA", bedrooms="2")])
    kinds = {str(f.type) for p in tmp_path.glob("*.parquet") for f in [pq.read_schema(p).field("price")]}
    assert kinds == {"int64", "double", "string"}

    assert len(shards.discover(spark, str(tmp_path))) == 4
    rows = {r.url: r for r in shards.load_sale(spark, str(tmp_path)).collect()}
    assert [rows[f"u{i}"].price for i in range(1, 7)] == [100.0, None, 100.0, 100.0, 100.0, None]
    assert [rows[f"u{i}"].bedrooms for i in range(1, 7)] == [2.0, 2.0, 2.0, None, None, 2.0]
    assert [rows[f"u{i}"].status for i in range(1, 7)] == [200, 200, None, 200, None, 404]
    assert rows["u1"].scraped_at.replace(tzinfo=UTC) == AT and rows["u4"].scraped_at is None

    promoted = shards.scan_promoted(spark, str(tmp_path))
    assert promoted.count() == 6 and promoted.schema["price"].dataType.simpleString() == "string"
    known = [shards.nanosecond(shards.SALE_STREAMED)]
    (tmp_path / "one").mkdir()
    pandas_shard(tmp_path / "one" / "shard_1.parquet", [sale("u1", status="200", scraped_at=at)])
    assert shards.load_sale(spark, str(tmp_path / "one"), known).first().scraped_at.replace(tzinfo=UTC) == AT


def test_discovery_brings_a_row_per_group_to_the_driver(spark, tmp_path):
    """Two hundred shards of two schemas in two folders: told apart by name in one, not in the other."""
    for folder, names in (("kind=apart", ("shard_{}", "dated-{}")), ("kind=mixed", ("part_{}", "part_{}"))):
        (tmp_path / folder).mkdir()
        for i in range(100):
            text = i % 2 == 0
            kind = sale_schema(pa.string() if text else pa.int64(), stamped=False)
            name = names[0 if text else 1].format(i)
            write(tmp_path / folder / f"{name}.parquet", [sale(f"{folder}{i}", status="200" if text else 404)], kind)
    found = shards.discover(spark, str(tmp_path))
    assert len(found) == 2 and all(v.fields and len(v.paths) == 2 for v in found)
    apart = shards.discover(spark, str(tmp_path / "kind=apart"))
    assert sorted(p.rsplit("/", 1)[1] for v in apart for p in v.paths) == ["dated-*.parquet", "shard_*.parquet"]
    for folder, n in (("kind=apart", 100), ("kind=mixed", 100), ("", 200)):
        rows = shards.load_sale(spark, str(tmp_path / folder)).collect()
        assert len({r.url for r in rows}) == len(rows) == n
        assert sum(r.status == 404 for r in rows) == n / 2


def test_load_room(spark, tmp_path):
    fields = [(n, pa.string()) for n in ("source", "postcode", "title", "url", "price_text")]
    rest = [("room_type", pa.string()), ("available", pa.string()), ("scraped_at", pa.timestamp("us", "UTC")), ("status", pa.int64())]
    base = dict(source="s", postcode="AB1", title="t", room_type="Double", available="", scraped_at=AT, status=0)
    write(
        tmp_path / "a.parquet",
        [dict(base, url="u1", price_text="£1,250.50 pcm", location="here")],
        pa.schema(fields + [("location", pa.string())] + rest),
    )
    write(
        tmp_path / "b.parquet",
        [dict(base, url="u2", price_text="POA", locatiom="there"), dict(base, url="u3", price_text=None, locatiom="")],
        pa.schema(fields + [("locatiom", pa.string())] + rest),
    )
    rows = {r.url: r for r in shards.load_room(spark, str(tmp_path)).collect()}
    assert [rows[u].location for u in ("u1", "u2", "u3")] == ["here", "there", None]
    assert [rows[u].price_norm for u in ("u1", "u2", "u3")] == [1250, None, None]
    assert rows["u1"].status is None and rows["u1"].available is None


def test_type_sale_without_columns(spark):
    row = shards.type_sale(spark.createDataFrame([("u",)], "url string")).first()
    assert row.url == "u" and row.price is None and row.scraped_at is None


def test_canonical_rows(spark):
    given = spark.createDataFrame(
        [("u", None, "3.0", "", "200"), (None, "p", "studio", "x", None)],
        "url string, postcode string, bedrooms string, price string, status string",
    )
    at = F.lit(AT)
    first, second = shards.canonical_sale(given, at).collect()
    assert (first.url, first.postcode, first.bedrooms, first.price, first.status) == ("u", "", 3, None, "200")
    assert (second.url, second.status, second.bedrooms) == ("", "", None)
    assert [r.url for r in shards.sale_rejects(given).collect()] == [None]

    room = shards.canonical_room(given, ROOM_SOURCE, at).collect()
    assert [r.status for r in room] == [200, 0]
    assert room[1].url == "" and room[0].source == ROOM_SOURCE and room[0].title == ""


def test_fingerprint(spark, sale_folder):
    import os

    files = [f for f in os.scandir(sale_folder) if f.name.endswith(".parquet")]
    row = shards.fingerprint(spark, sale_folder).first()
    assert row.file_count == len(files) == 3
    assert row.total_bytes == sum(f.stat().st_size for f in files)
    assert row.latest_mtime == max(int(f.stat().st_mtime) for f in files)


def test_fingerprint_of_nothing(spark, tmp_path):
    assert tuple(shards.fingerprint(spark, str(tmp_path)).first()) == (0, 0, 0)


@pytest.mark.parametrize(
    "text, column, keys",
    [
        ("OuterCode, Postcode\n1,AB10\n2, ab11 \n3,AB10\n4,\n", None, ["AB10", "AB11"]),
        ("OuterCode, Postcode\n1,AB10\n2,AB11\n", "OuterCode", ["1", "2"]),
        ("OuterCode, Postcode\n1,AB10\n", "none", ["AB10"]),
        ("postcode\nZE3\nAB10\n", None, ["ZE3", "AB10"]),
    ],
)
def test_location_list(spark, tmp_path, text, column, keys):
    path = tmp_path / "l.csv"
    path.write_text(text)
    got = lists.location_list(spark, str(path), column).orderBy("position").collect()
    assert [r.key for r in got] == keys


def test_location_ids(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text("OuterCode, Postcode\n1,AB10\n22,AB11\n")
    got = lists.location_ids(lists.read_list_csv(spark, str(path))).orderBy("position").collect()
    assert [r.location_id for r in got] == ["OUTCODE^1", "OUTCODE^22"]


def test_url_files(spark, tmp_path):
    (tmp_path / "failed_urls_worker0.txt").write_text("u1\n\n  u2 \n")
    (tmp_path / "failed_urls_worker7.txt").write_text("u2\nu3\n   \n")
    (tmp_path / "other.txt").write_text("u9\n")
    got = lists.read_url_list(spark, str(tmp_path)).collect()
    assert sorted(r.url for r in got) == ["u1", "u2", "u3"]
    out = str(tmp_path / "out")
    write_url_list(lists.read_url_list(spark, str(tmp_path)), out)
    assert sorted(r.url for r in lists.url_list(spark.read.text(out)).collect()) == ["u1", "u2", "u3"]


def state(tmp_path, content):
    path = tmp_path / "state.json"
    path.write_text(content)
    return str(path)


def test_state_file(spark, tmp_path):
    path = state(tmp_path, json.dumps({"completed_postcodes": ["B", "A"], "failed_postcodes": ["C", "C"]}, indent=2))
    got = ledgers.state_events(spark, path, "rooms", "r0", F.lit(AT)).collect()
    assert sorted((r.key, r.status) for r in got) == [
        ("A", "completed"), ("B", "completed"), ("C", "failed"), ("C", "failed"),
    ]


def test_state_file_key_names(spark, tmp_path):
    def keys(content):
        path = state(tmp_path, json.dumps(content))
        return sorted(r.key for r in ledgers.state_events(spark, path, "s", "r", F.lit(AT)).collect())

    assert keys({"completed_locations": ["x"]}) == ["x"]
    assert keys({"completed_outcodes": ["y"], "completed_locations": ["x"]}) == ["y"]
    assert keys({"completed_outcodes": [], "completed_locations": ["x"]}) == []
    path = state(tmp_path, json.dumps({"collected_urls": ["u", "v", "u"]}))
    assert sorted(r.url for r in ledgers.state_urls(spark, path).collect()) == ["u", "v"]


def test_unreadable_state_is_empty(spark, tmp_path):
    for content in ("", "{broken", "[]"):
        assert ledgers.state_events(spark, state(tmp_path, content), "s", "r", F.lit(AT)).count() == 0
    assert ledgers.state_events(spark, str(tmp_path / "none.json"), "s", "r", F.lit(AT)).count() == 0


def test_ledger_table(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledgers.read_ledger(spark, path).count() == 0
    events = spark.createDataFrame([("s", "k", "completed", "r1", AT)], ledgers.schemas.LEDGER)
    ledgers.append_ledger(events, path)
    ledgers.append_ledger(events, path)
    assert ledgers.read_ledger(spark, path).count() == 2


def test_settle_pages(spark):
    given = spark.createDataFrame(
        [(200, "x"), (200, ""), (404, "x"), (None, "x"), (0, None)], "http_status int, html string"
    )
    got = pages.settle_pages(given).withColumn("has", pages.has_html()).collect()
    assert [(r.http_status, r.html, r["has"]) for r in got] == [
        (200, "x", True), (200, "", False), (404, None, False), (0, None, False), (0, None, False),
    ]


def test_shard_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_shards(spark.range(12_001).coalesce(1), path)
    sizes = [pq.ParquetFile(p).metadata for p in (tmp_path / "out").glob("*.parquet")]
    assert sorted(m.num_rows for m in sizes) == [2001, 5000, 5000]
    assert {m.row_group(0).column(0).compression for m in sizes} == {"UNCOMPRESSED"}


def test_snapshots_of_one_day_add_up(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("u1", AT), ("u2", AT + dt.timedelta(days=1))], "url string, scraped_at timestamp")
    write_snapshot(rows, path, "full", F.col("scraped_at"))
    write_snapshot(rows.limit(1), path, "retry", F.lit(AT))
    got = spark.read.parquet(path)
    assert got.count() == 3
    days = {str(r.snapshot_date) for r in got.collect()}
    assert days == {"2024-05-01", "2024-05-02"}
    assert shards.load_sale(spark, path).count() == 3


def test_typed_snapshot_takes_filters_into_the_scan(spark, sale_folder, tmp_path):
    path = str(tmp_path / "typed")
    write_snapshot(shards.load_sale(spark, sale_folder), path, "full", F.coalesce("scraped_at", F.lit(AT)))
    rows = shards.read_typed(spark, path, schemas.SALE_TABLE)
    chosen = filters.Selection("ab", {}, {"price": (50, 500)}).apply(rows).where("snapshot_date = '2024-05-01'")
    assert sorted(r.url for r in chosen.collect()) == ["u1", "u3", "u4"]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(postcode,AB)" in plan and "GreaterThanOrEqual(price,50.0)" in plan
    assert "snapshot_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_costly_rows_come_in_bounded_tasks(spark):
    scan = spark.range(0, 1000, 1, 1)
    spread = pages.over_all_cores(scan, rows_per_task=10)
    assert spread.rdd.getNumPartitions() == 100 and spread.count() == 1000
    assert pages.over_all_cores(spread, rows_per_task=100).rdd.getNumPartitions() == 100
