"""Parquet sinks. Spark's commit protocol makes each write appear whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import SHARD_ROWS
from letbook.functions.text import day_label


def write_shards(
    rows: DataFrame,
    path: str,
    rows_per_file: int = SHARD_ROWS,
    compression: str = "none",
    mode: str = "append",
) -> None:
    """Files of at most `rows_per_file` rows.

    The default is the collectors' shard; large tables want millions of rows per file.
    """
    (
        rows.write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", compression)
        .parquet(path)
    )


def write_snapshot(
    rows: DataFrame, path: str, run_id: str, at: Column, compression: str = "none", sort_by: Sequence[str] = ()
) -> None:
    """Rows written under the day and the run they belong to; other runs stay.

    A day written again under the same run replaces what that run wrote there, so a run that was stopped
    can be repeated.

    The rebalance hint lets adaptive execution split a large day over several tasks and
    gather small ones, so files come out even whatever the days hold. Files sorted by the
    columns that readers filter on let them leave row groups unread.
    """
    dated = rows.withColumn("snapshot_date", day_label(at)).withColumn("run_id", F.lit(run_id))
    even = dated.hint("rebalance", "snapshot_date")
    if sort_by:
        even = even.sortWithinPartitions("snapshot_date", "run_id", *sort_by)
    (
        even.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date", "run_id")
        .option("compression", compression)
        .parquet(path)
    )


def write_url_list(urls: DataFrame, path: str) -> None:
    """One URL per line."""
    urls.select("url").write.mode("overwrite").text(path)
