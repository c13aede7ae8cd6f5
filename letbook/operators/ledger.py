"""Work bookkeeping on a ledger of events: what is left, what is done, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.operators.paging import last_status


def first_items(locations: DataFrame, limit: int | None, order: str = "position") -> DataFrame:
    """The first items of the list; 0 or None takes them all. Comes before removing done ones."""
    return locations.orderBy(order).limit(limit) if limit else locations


def current(events: DataFrame) -> DataFrame:
    """The latest event of each key."""
    latest = F.max_by(
        F.struct("status", "run_id", "updated_at"), F.struct("updated_at", "run_id", "status")
    )
    return events.groupBy("source", "key").agg(latest.alias("_e")).select("source", "key", "_e.*")


def completed(events: DataFrame) -> DataFrame:
    """Sources and keys ever completed: a later failure does not undo it."""
    return events.where(F.col("status") == "completed").select("source", "key").distinct()


def failed(events: DataFrame) -> DataFrame:
    """Sources and keys whose latest event is a failure."""
    return current(events).where(F.col("status") == "failed").select("source", "key")


def remaining(locations: DataFrame, done: DataFrame) -> DataFrame:
    """Locations that are not done, with their place in the list.

    Where both tables name a source, a key done for one source is still to do for another.
    """
    on = ["source", "key"] if "source" in locations.columns and "source" in done.columns else ["key"]
    return locations.join(done.select(*on).distinct(), on, "left_anti")


def work_list(
    locations: DataFrame, events: DataFrame, source: str, retry_failed: bool = False
) -> DataFrame:
    """Keys of a source to work on: the failed ones in retry mode when there are any, else what remains."""
    own = events.where(F.col("source") == source)
    left = remaining(locations, completed(own).select("key")).select("key")
    if not retry_failed:
        return left
    again = failed(own).select("key")
    none_failed = again.agg(F.count(F.lit(1))).scalar() == 0
    return again.unionByName(left.where(none_failed))


def room_outcomes(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per location: completed when its first page had markup and the last answer was 200.

    A location without any results is completed too; one whose first page never loaded failed.
    """
    ok = F.col("first_html") & (F.col("status") == 200)
    return last_status(pages, keys).select(
        *keys, F.when(ok, "completed").otherwise("failed").alias("status")
    )


def sale_outcomes(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per location: completed once its pages have been gone through, links or not."""
    return pages.select(*keys).distinct().withColumn("status", F.lit("completed"))


def to_events(outcomes: DataFrame, source: str, key: str, run_id: str, at: Column) -> DataFrame:
    """Outcomes as ledger events of a run."""
    return outcomes.select(
        F.lit(source).alias("source"),
        F.col(key).cast("string").alias("key"),
        "status",
        F.lit(run_id).alias("run_id"),
        at.cast("timestamp").alias("updated_at"),
    )


def sorted_completed(events: DataFrame) -> DataFrame:
    return completed(events).orderBy("source", "key")
