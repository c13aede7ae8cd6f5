"""Room listings from search pages to table and ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letbook import schemas
from letbook.fixed import ROOM_ID_PARAM, ROOM_SOURCE, SHARD_ROWS
from letbook.functions.urls import query_param
from letbook.operators.dedup import first_listing, first_url, repeats, with_keys
from letbook.operators.extract import ROOM_LAYOUT, CardLayout, card_list, cards, listed_cards
from letbook.operators.ledger import room_outcomes, to_events
from letbook.functions.html import result_total
from letbook.operators.paging import ROOM_SERIES, SeriesRules, page_count, settle_fetches, tag_status, visited
from letbook.operators.skew import equal, prefixed
from letbook.session import keep
from letbook.sinks.tables import write_shards
from letbook.sources.ledgers import append_ledger
from letbook.sources.pages import has_html, settle_pages
from letbook.sources.shards import canonical_room, union_by_name
from letbook.streaming.jobs import read_batches, run_available, write_batch
from letbook.streaming.series import ended_series, state_on_disk, waiting

_PAGE = ["key", "page_idx", "http_status", "has_html", "fetched_at"]


@dataclass(frozen=True)
class RoomRun:
    """What a run gives, and the cards with new URLs that its rows are chosen from."""

    rows: DataFrame
    events: DataFrame
    summary: DataFrame
    found: DataFrame
    keys: tuple[str, ...]


def room_run(
    pages: DataFrame,
    run_id: str,
    at: Column,
    layout: CardLayout = ROOM_LAYOUT,
    rules: SeriesRules = ROOM_SERIES,
) -> RoomRun:
    """Deduplicated rows, ledger events and the summary of a set of search pages.

    The markup is read and parsed once; all later steps read the typed cards, which are a
    small part of it.
    """
    return _run_of(keep(_parsed(pages, layout), "cards"), run_id, at, layout, rules)


def _parsed(pages: DataFrame, layout: CardLayout) -> DataFrame:
    """The cards of every page, and a row for a page without any."""
    return cards(settle_pages(pages).withColumn("has_html", has_html()), _PAGE, layout, outer=True)


def _run_of(parsed: DataFrame, run_id: str, at: Column, layout: CardLayout, rules: SeriesRules) -> RoomRun:
    one_per_page = parsed.where(F.coalesce(F.col("pos"), F.lit(0)) == 0).select(*_PAGE, "n_items")
    fetches = settle_fetches(one_per_page, ["key"])
    seen = keep(visited(fetches, rules, ["key"]), "visited")
    found = parsed.drop("http_status", "n_items", "has_html").where(F.col("pos").isNotNull())
    # of a page fetched several times only the fetch that was chosen gives cards
    fetch = ["key", "page_idx", "fetched_at"]
    on_seen = found.join(prefixed(seen.select(*fetch), fetch, "_seen_"), equal(fetch, "_seen_"), "left_semi")

    unique = first_url(on_seen, "key", ["page_idx", "pos", "fetched_at"])
    tagged = keep(
        tag_status(unique, seen, ["key"])
        .withColumnRenamed("key", "postcode")
        .withColumn("source", F.lit(ROOM_SOURCE)),
        "tagged",
    )
    outcomes = room_outcomes(seen, ["key"])
    return RoomRun(
        rows=canonical_room(first_listing(tagged), ROOM_SOURCE, stamp=F.col("fetched_at")),
        events=to_events(outcomes, ROOM_SOURCE, "key", run_id, at),
        summary=_summary(outcomes, tagged, ["source", layout.id_param, "postcode"]),
        found=tagged,
        keys=("source", layout.id_param, "postcode"),
    )


def write_rooms(run: RoomRun, rows_path: str, ledger_path: str, rows_per_file: int = SHARD_ROWS) -> DataFrame:
    """Writes rows and ledger events; the summary is counted on the way, without another scan. One row.

    The counts are those of the jobs that write; a task that had to be repeated counts once.
    """
    found, keyed, kept, done = Observation(), Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    keys = list(run.keys)
    cards = with_keys(run.found.observe(found, n), keys).observe(keyed, n)
    rows = canonical_room(first_listing(cards, keys).observe(kept, n), ROOM_SOURCE, stamp=F.col("fetched_at"))
    write_shards(rows, rows_path, rows_per_file)
    append_ledger(run.events.observe(done, n, F.count_if(F.col("status") == "failed").alias("failed")), ledger_path)
    counts = [(done.get["n"], found.get["n"], keyed.get["n"] - kept.get["n"], done.get["failed"])]
    return run.rows.sparkSession.createDataFrame(counts, "processed long, total_rows long, dropped long, failed long")


def _summary(outcomes: DataFrame, tagged: DataFrame, keys: list[str]) -> DataFrame:
    """One row: locations processed and failed, rows found, rows dropped as repeats."""
    parts = [
        outcomes.agg(
            F.count(F.lit(1)).alias("processed"), F.count_if(F.col("status") == "failed").alias("failed")
        ),
        tagged.agg(F.count(F.lit(1)).alias("total_rows")),
        repeats(with_keys(tagged, keys), keys).select(F.col("n_dropped").alias("dropped")),
    ]
    return union_by_name(parts).agg(
        *[F.sum(name).alias(name) for name in ("processed", "total_rows", "dropped", "failed")]
    )


def room_stream(
    pages: DataFrame,
    rows_path: str,
    ledger_path: str,
    checkpoint: str,
    run_id: str,
    at: Column,
    rows_per_file: int = SHARD_ROWS,
) -> StreamingQuery:
    """Rows and ledger events of the pages that have arrived, however they are dealt over batches.

    Batches only append parsed pages to a table beside the checkpoint. Once all are in, a location's stop page,
    status and completion come from all its pages of the run, and what the run wrote before is replaced. Listings
    that other runs wrote under the same postcode are left out. A run that was stopped is written by the next call,
    whatever the run id of that.
    """
    spark = pages.sparkSession
    pages_path, written_path = f"{checkpoint}/pages", f"{checkpoint}/written"
    keys = ["postcode", "_id"]

    def with_id(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_id", query_param(F.col("url"), ROOM_ID_PARAM))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(_parsed(batch, ROOM_LAYOUT).withColumn("run_id", F.lit(run_id)), pages_path, batch_id, rows_per_file)

    query = run_available(pages, checkpoint, on_batch)
    like = _parsed(spark.createDataFrame([], schemas.PAGES), ROOM_LAYOUT).withColumn("run_id", F.lit(run_id))
    numbered = spark.createDataFrame([], like.schema).withColumn("batch_id", F.lit(0))
    arrived = read_batches(numbered, pages_path)
    written = read_batches(spark.createDataFrame([], "run_id string, last int"), written_path)
    runs = arrived.groupBy("run_id").agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last"))
    done = written.groupBy("run_id").agg(F.max("last").alias("done"))
    open_runs = runs.join(done, "run_id", "left").where("done is null or done < last").orderBy("first").collect()
    for name, first, last, _ in open_runs:
        own = arrived.where(F.col("run_id") == name).drop("run_id", "batch_id")
        run = _run_of(own, name, at, ROOM_LAYOUT, ROOM_SERIES)
        # a run's folder bears the number of its first batch
        seen = with_id(read_batches(run.rows, rows_path, but=first)).select(*keys)
        fresh = with_id(run.rows).join(seen, keys, "left_anti").drop("_id")
        write_batch(fresh.select(*run.rows.columns), rows_path, first, rows_per_file)
        write_batch(run.events, ledger_path, first, rows_per_file)
        write_batch(spark.createDataFrame([(name, last)], "run_id string, last int"), written_path, last)
    return query


def _waiting_rows(pages: DataFrame, layout: CardLayout, rules: SeriesRules) -> DataFrame:
    """Pages as the keyed buffer takes them, a row each: how many pages a first page promises, times as numbers, the
    cards in one JSON text, as every row and value costs time on its way through the state."""
    planned = F.when(F.col("page_idx") == 0, page_count(F.coalesce(result_total(F.col("html")), F.lit(0)), rules.page_size))
    settled = settle_pages(pages).withColumns({"has_html": has_html(), "planned": planned.cast("int")})
    rows = settled.select(*_PAGE, "planned", card_list(F.col("html"), layout).alias("_cards"))
    listed = {"n_items": F.coalesce(F.size("_cards"), F.lit(0)), "cards": F.to_json("_cards"), "fetched_us": F.unix_micros("fetched_at")}
    return rows.withColumns(listed).drop("fetched_at", "_cards")


def collect_rooms(
    pages: DataFrame,
    rows_path: str,
    ledger_path: str,
    checkpoint: str,
    run_id: str,
    at: Column,
    layout: CardLayout = ROOM_LAYOUT,
    rules: SeriesRules = ROOM_SERIES,
    complete: bool = False,
    rows_per_file: int = SHARD_ROWS,
) -> StreamingQuery:
    """Rows and ledger events of a run's pages, a location's as soon as its series is over, each location once.

    Pages wait in state keyed by location, in any order, over any number of batches and restarts, until a page that
    ends the series and all before it are there, or as many pages as the first one promises. What leaves in a batch
    is a small `room_run` of whole locations. A fetch of a location that has left is too late. With `complete`,
    no more pages will come: what still waits is written, too (again, if this is called again).
    """
    spark = pages.sparkSession
    rows = _waiting_rows(pages, layout, rules)

    def write(found: DataFrame, batch_id: int) -> None:
        timed = found.withColumn("fetched_at", F.timestamp_micros("fetched_us")).drop("fetched_us", "planned")
        run = _run_of(keep(listed_cards(timed, "cards", layout), "ended"), run_id, at, layout, rules)
        write_batch(run.rows, rows_path, batch_id, rows_per_file)
        write_batch(run.events, ledger_path, batch_id, rows_per_file)

    with state_on_disk(spark):
        query = run_available(ended_series(rows, rules), checkpoint, write)
    if complete:
        write(waiting(spark, checkpoint, rows.schema), -1)
    return query
