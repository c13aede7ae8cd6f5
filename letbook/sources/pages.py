"""Fetched pages as an input table or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook import schemas

#: Rows that a task of costly extraction takes.
ROWS_PER_TASK = 50_000


def settle_pages(pages: DataFrame) -> DataFrame:
    """Status 0 where nothing came back, and markup only where the status is 200."""
    status = F.coalesce(F.col("http_status").cast("string").try_cast("int"), F.lit(0))
    return pages.withColumn("http_status", status).withColumn(
        "html", F.when(F.col("http_status") == 200, F.col("html"))
    )


def has_html(column: str = "html"):
    return F.coalesce(F.col(column) != "", F.lit(False))


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    source = spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", max_files)
    return settle_pages(source.parquet(path))


def over_all_cores(scan: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows of a table scan over at least as many tasks as there are cores, and as its rows call for.

    For costly extraction: narrow rows that take long would otherwise come by the million in one split of a file. A
    scan that already has that many splits, as any large table of whole pages does, is left as it is.
    """
    tasks = max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // rows_per_task))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan
