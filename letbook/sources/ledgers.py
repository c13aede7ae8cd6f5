"""The work ledger: which keys are done, which failed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook import schemas

_EVENT = ("source", "key", "status", "run_id", "updated_at")
_STATE_FILE = (
    "completed_postcodes array<string>, failed_postcodes array<string>, "
    "completed_outcodes array<string>, completed_locations array<string>, "
    "collected_urls array<string>"
)


def _state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_STATE_FILE).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STATE_FILE)


def _listed(state: DataFrame, keys: Column) -> DataFrame:
    return state.select(F.explode(keys).alias("key"))


def state_events(
    spark: SparkSession, path: str, source: str, run_id: str, at: Column
) -> DataFrame:
    """Ledger events out of a JSON state file; missing or unreadable means none.

    The oldest key name counts only where the newer one is absent. Failed keys keep repeats.
    """
    state = _state(spark, path)
    done = F.coalesce("completed_postcodes", "completed_outcodes", "completed_locations")
    events = (
        _listed(state, done).withColumn("status", F.lit("completed"))
    ).unionByName(
        _listed(state, F.col("failed_postcodes")).withColumn("status", F.lit("failed"))
    )
    return events.select(
        F.lit(source).alias("source"),
        "key",
        "status",
        F.lit(run_id).alias("run_id"),
        at.cast("timestamp").alias("updated_at"),
    )


def state_urls(spark: SparkSession, path: str) -> DataFrame:
    """URLs collected so far, out of a JSON state file."""
    return _listed(_state(spark, path), F.col("collected_urls")).withColumnRenamed("key", "url").distinct()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table by its schema; one that is not there has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Events of the ledger table, in whatever folders; a missing table is an empty ledger."""
    return read_or_empty(spark, path, schemas.LEDGER).select(*_EVENT)


def append_ledger(events: DataFrame, path: str) -> None:
    events.select(*_EVENT).write.mode("append").parquet(path)
