"""Page series as keyed state: a location's pages wait until its series has ended, then leave together."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from letbook.operators.paging import SeriesRules

#: Rows of a location that are put into the state at once.
CHUNK = 5000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def series_over(pages: dict[int, tuple[int, bool]], planned: int | None, rules: SeriesRules) -> bool:
    """Whether pages (index: items, markup) hold all of a series: up to one that ends it, or as many as planned."""
    at = 0
    while at in pages:
        n_items, has_html = pages[at]
        short = (n_items if has_html else 0) < rules.page_size
        if at == 0:
            ends = short and (rules.empty_first_ends or (has_html and n_items > 0))
        else:
            ends = short and (rules.missing_later_ends or has_html)
        at += 1
        if ends or (planned is not None and at >= planned):
            return True
    return False


class SeriesBuffer(StatefulProcessor):
    """Rows of a location, held back until its series is over; rows that come later are too late.

    Rows have key, page_idx, has_html, n_items, planned (pages, on rows of the first page) and fetched_us. A page
    fetched several times counts as its best fetch so far: one with items, then the latest.
    """

    def __init__(self, schema: StructType, rules: SeriesRules):
        self._schema, self._rules = schema, rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        page = "struct<idx:int,n_items:int,has_html:boolean,fetched_us:bigint>"
        self._facts = handle.getValueState("facts", f"over boolean, planned int, pages array<{page}>")
        self._rows = handle.getListState("rows", self._schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        over, planned, known = self._facts.get() if self._facts.exists() else (False, None, [])
        if over:
            return
        best = {p[0]: tuple(p[1:]) for p in known}
        held = bool(best)
        chunk: list[Row] = []
        while True:
            for row in islice(rows, CHUNK - len(chunk)):
                chunk.append(row)
                planned = row["planned"] if row["planned"] is not None else planned
                fetch = (row["n_items"] or 0, bool(row["has_html"]), row["fetched_us"])
                if row["page_idx"] is not None:
                    best[row["page_idx"]] = max(best.get(row["page_idx"], fetch), fetch, key=_rank)
            if len(chunk) < CHUNK:
                break
            self._rows.appendList([tuple(r) for r in chunk])
            chunk, held = [], True
        if series_over({i: f[:2] for i, f in best.items()}, planned, self._rules):
            if held:
                for stored in self._rows.get():
                    yield Row(*self._schema.names)(*stored)
                self._rows.clear()
            yield from chunk
            self._facts.update((True, None, []))
            return
        if chunk:
            self._rows.appendList([tuple(r) for r in chunk])
        self._facts.update((False, planned, [(i, *f) for i, f in best.items()]))

    def close(self) -> None:
        pass


def _rank(fetch: tuple) -> tuple:
    return fetch[0] > 0, fetch[2] is not None, fetch[2] or 0


def ended_series(rows: DataFrame, rules: SeriesRules) -> DataFrame:
    """The stream's rows by location, all rows of one at once, as soon as its series is over."""
    buffer = SeriesBuffer(rows.schema, rules)
    return rows.groupBy("key").transformWithState(buffer, rows.schema, "Append", "None")


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams that start meanwhile keep their state in RocksDB, which keyed buffers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def waiting(spark: SparkSession, checkpoint: str, schema: StructType) -> DataFrame:
    """Rows of locations whose series is not over, read from a stopped stream's state."""
    try:
        stored = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load()
    except AnalysisException:
        return spark.createDataFrame([], schema)  # nothing was ever put into the state
    return stored.select("list_element.*").select(*schema.names)
