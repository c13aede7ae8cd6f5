"""Whole runs: keyed room streams, sale collection, retries, files to views, SQL beside other SQL."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from letbook import schemas, sql
from letbook.functions.model import leaf, page_variant
from letbook.operators import paging, retry
from letbook.plans import registry
from letbook.plans.rooms import collect_rooms, room_run, write_rooms
from letbook.plans.sales import collected_urls, resolved, retry_run, write_collection
from letbook.sources.ledgers import read_ledger
from letbook.sources.pages import stream_pages
from letbook.streaming.series import series_over
from test_html import card
from test_paging import walk
from test_plans import RULES, room_pages

AT = dt.datetime(2024, 5, 1)


def with_totals(pages):
    """Room pages whose first one says how many results all of the location's pages hold."""
    n_pages = {}
    for key, _, _, idx, *_ in pages:
        n_pages[key] = max(n_pages.get(key, 0), idx + 1)
    line = "<p class='navcurrent'>Showing <strong>1</strong> of <strong>{}</strong></p>"
    return [(*p[:6], line.format(3 * n_pages[p[0]]) + p[6] if p[3] == 0 else p[6], p[7]) for p in pages]


def facts(rows):
    return sorted((r.postcode, r.url, r.title, r.status) for r in rows)


@pytest.mark.parametrize("files", [1, 1000])
def test_keyed_room_stream_equals_the_run(spark, tmp_path, files):
    """Pages dealt over files by their index, one file a batch or all at once: locations leave once, whole."""
    pages = with_totals(room_pages(5))
    inbox, rows_path, ledger_path, checkpoint = (str(tmp_path / p) for p in ("in", "rows", "ledger", "cp"))
    order = [1, 3, 0, 4, 2] if files == 1 else [0]
    for part in order:
        some = [p for p in pages if files > 1 or p[3] == part]
        spark.createDataFrame(some, schemas.PAGES).coalesce(1).write.mode("append").parquet(inbox)
    how = {"rules": RULES}
    collect_rooms(stream_pages(spark, inbox, files), rows_path, ledger_path, checkpoint, "r", F.lit(AT), **how)
    run = room_run(spark.createDataFrame(pages, schemas.PAGES), "r", F.lit(AT), **how)
    # every series has ended, so nothing waits for the end of the input
    assert facts(spark.read.schema(schemas.ROOM_LISTINGS).parquet(rows_path).collect()) == facts(run.rows.collect())
    events = sorted((r.key, r.status) for r in read_ledger(spark, ledger_path).collect())
    assert events == sorted((r.key, r.status) for r in run.events.collect())


def test_what_waits_is_written_when_the_input_is_complete(spark, tmp_path):
    inbox, rows_path, ledger_path, checkpoint = (str(tmp_path / p) for p in ("in", "rows", "ledger", "cp"))
    full = "".join(card(i, title=f"t{i}", href=f"/r?flatshare_id={i}") for i in range(3))
    line = "<p class='navcurrent'>1 of <strong>1</strong><strong>9</strong></p>"
    spark.createDataFrame([("P", "search", None, 0, 0, 200, line + full, AT)], schemas.PAGES).write.parquet(inbox)
    stream = lambda: stream_pages(spark, inbox)
    collect_rooms(stream(), rows_path, ledger_path, checkpoint, "r", F.lit(AT), rules=RULES)
    assert read_ledger(spark, ledger_path).count() == 0
    for _ in range(2):
        collect_rooms(stream(), rows_path, ledger_path, checkpoint, "r", F.lit(AT), rules=RULES, complete=True)
    assert [(r.key, r.status) for r in read_ledger(spark, ledger_path).collect()] == [("P", "completed")]
    assert spark.read.schema(schemas.ROOM_LISTINGS).parquet(rows_path).count() == 3


@pytest.mark.parametrize("rules", [paging.ROOM_SERIES, paging.SALE_SERIES, paging.SALE_SERIES_FIRST_ONLY])
def test_a_series_is_over_where_walking_it_ends(rules):
    full = rules.page_size
    for steps in ([(full, True), (full, True)], [(full, True), (1, True), (full, True)], [(0, True), (full, True)], [(0, False)], [(full, True), (0, False), (2, True)]):
        seen, _ = walk([(i, n, html, 200) for i, (n, html) in enumerate(steps)], rules)
        ends = len(seen) < len(steps)
        assert series_over(dict(enumerate(steps)), len(steps), rules)
        for known in range(len(steps)):
            some = dict(list(enumerate(steps))[:known])
            assert series_over(some, None, rules) == (ends and known >= len(seen)) or known >= len(seen)
        assert not series_over({1: (full, True)}, 5, rules)


def test_summary_observed_while_writing(spark, tmp_path):
    run = room_run(spark.createDataFrame(room_pages(6), schemas.PAGES), "r", F.lit(AT), rules=RULES)
    observed = write_rooms(run, str(tmp_path / "rows"), str(tmp_path / "ledger"))
    assert observed.collect() == run.summary.select(*observed.columns).collect()
    assert spark.read.parquet(str(tmp_path / "rows")).count() == run.rows.count()


def test_collected_urls_grow_by_what_is_new(spark, tmp_path):
    def page(key, numbers):
        return (key, "search", None, 0, 0, 200, "".join(f'<a class="propertyCard-link" href="/properties/{n}#x">p</a>' for n in numbers), AT)

    urls, ledger = str(tmp_path / "urls"), str(tmp_path / "ledger")
    for run_id, pages in (("a", [page("k1", [1, 2])]), ("b", [page("k2", [2, 3]), page("k3", [])]), ("b", [page("k2", [2, 3])])):
        write_collection(spark, spark.createDataFrame(pages, schemas.PAGES), urls, ledger, run_id, F.lit(AT))
    got = sorted((int(r.url.rsplit("/", 1)[1]), r.run_id) for r in collected_urls(spark, urls).collect())
    assert got == [(1, "a"), (2, "a"), (3, "b")]
    assert {(r.key, r.run_id, r.status) for r in read_ledger(spark, ledger).collect()} == {(k, r, "completed") for k, r in (("k1", "a"), ("k2", "b"), ("k3", "b"))}


def test_a_retry_run_that_was_stopped(spark, tmp_path):
    """Stopped after pass two and called again, it fetches only what is left and ends with the same table."""
    urls = spark.createDataFrame([(f"u{i}", i) for i in range(20)], "url string, n int")
    asked = []

    def fetch(todo, pass_no):
        asked.append((pass_no, todo.count()))
        ok = F.col("n") % (2**pass_no) != 0
        pages = urls.join(todo, "url", "left_semi")
        return pages.select("url", F.when(ok, 200).otherwise(503).alias("http_status"), F.lit("<p>x</p>").alias("html"), F.lit(AT).alias("fetched_at"))

    whole = retry_run(urls, fetch, str(tmp_path / "whole"))
    assert asked == [(1, 20), (2, 10), (3, 5)]
    retry_run(urls, fetch, str(tmp_path / "parts"), last=2)
    parts = retry_run(urls, fetch, str(tmp_path / "parts"))
    assert asked[3:] == asked[:3]
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert sorted(r.url for r in retry.final_failures(parts).collect()) == ["u0", "u16", "u8"]
    assert resolved(parts).where("status = '200'").count() == 17


def test_a_view_leaves_folders_and_row_groups_unread(spark, sf_dir):
    from letbook.operators import filters

    stored = registry._stored_sales(spark, sf_dir).where("snapshot_date >= DATE '2023-11-15'")
    chosen = filters.Selection("n1", {"property_type": ["BUILDING"]}, {"price": (0, None)}).apply(stored)
    plan = filters.latest_first(chosen, filters.SALE_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    folders, pushed = plan.split("PartitionFilters: ")[1].split("PushedFilters: ")[:2]
    assert "snapshot_date" in folders
    assert all(x in pushed for x in ("StringStartsWith(postcode,N1)", "EqualTo(property_type,BUILDING)", "GreaterThanOrEqual(price,0.0)"))


def test_sql_of_two_threads_on_one_session(spark):
    """The same table name with different rows at the same time; values by name; braces are text."""
    text = "SELECT '{a}' AS t, count(*) AS n FROM listings WHERE id >= :low;"
    got, errors = {}, []

    def ask(n):
        try:
            for _ in range(5):
                got.setdefault(n, set()).add(tuple(sql.run_sql(spark, text, {"listings": spark.range(n)}, {"low": 2}).first()))
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=ask, args=(n,)) for n in (5, 50, 500)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and got == {n: {("{a}", n - 2)} for n in (5, 50, 500)}
    assert not spark.catalog.tableExists("listings")


def test_models_of_any_shape(spark):
    pages = [
        '<script>window.PAGE_MODEL = {"a": {"b": [{"c": "x"}, 7]}, "n": "12", "d": 1.5};</script>',
        '<script>window.PAGE_MODEL = {"a": [1], "n": null};</script>',
        "<script>window.PAGE_MODEL = {broken;</script>",
        None,
    ]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").select("i", page_variant(F.col("html")).alias("m"))
    m = F.col("m")
    got = rows.select("i", leaf(m, "a.b[0].c"), leaf(m, "a.b[1]", "int"), leaf(m, "n", "int"), leaf(m, "d", "double"), leaf(m, "a.b", "int"), leaf(m, "z.y")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [("x", 7, 12, 1.5, None, None)] + [(None,) * 6] * 3
