"""Structured Streaming forms: duplicates, continuous shards, resumable collection."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letbook.fixed import SHARD_ROWS
from letbook.operators.dedup import ARRIVAL, LISTING_KEYS, first_per_key, with_keys
from letbook.session import keep

SPREAD = 64
#: Folders of keys that a batch names when it reads the history; a batch that needs more reads all of it.
MOST_BUCKETS = 4096


def run_available(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Works off what is there in micro-batches and ends; a restart goes on after the last one."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_batch(rows: DataFrame, path: str, batch_id: int, rows_per_file: int = SHARD_ROWS) -> None:
    """A batch in a folder of its own; repeating the batch replaces just that."""
    (
        rows.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{path}/batch_id={batch_id}")
    )


def read_batches(like: DataFrame, path: str, before: int | None = None, but: int | None = None) -> DataFrame:
    """Rows of earlier batches, or of all but one; a table that is not there yet has none."""
    spark = like.sparkSession
    try:
        rows = spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)
    if before is not None and "batch_id" in rows.columns:
        rows = rows.where(F.col("batch_id") < before)
    if but is not None and "batch_id" in rows.columns:
        rows = rows.where(F.col("batch_id") != but)
    return rows.select(*like.columns)


@dataclass(frozen=True)
class SeenKeys:
    """Keys that batches have written, in folders by a hash of the key, beside the table they belong to.

    There are 2 ** level folders of about `bucket_rows` keys each. A batch reads those its own keys hash to, so what
    it reads depends on the batch, not on how long the history is. When folders grow beyond that, all keys are
    written once more on a higher level; that happens each time the history has doubled.
    """

    path: str
    keys: tuple[str, ...]
    bucket_rows: int = 1_000_000

    def _sizes(self, spark: SparkSession, before: int) -> tuple[int, int]:
        """Keys written by earlier batches, and the level they are on."""
        sizes = read_batches(spark.createDataFrame([], "n long, level int"), f"{self.path}/sizes", before=before)
        found = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("level"), F.lit(0))).first()
        return found[0], found[1]

    def _at(self, level: int) -> str:
        return f"{self.path}/level={level}"

    def _bucket(self, level: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(1 << level)).cast("int")

    def _write(self, rows: DataFrame, level: int, batch_id: int) -> None:
        placed = rows.select(*self.keys, self._bucket(level).alias("bucket"))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self._at(level)}/batch_id={batch_id}"
        )

    def of_level(self, like: DataFrame, level: int, before: int) -> DataFrame:
        """The keys of earlier batches, with the folder they lie in."""
        kept = like.select(*self.keys).limit(0).withColumns({"bucket": F.lit(0), "batch_id": F.lit(0)})
        return read_batches(kept, self._at(level), before=before)

    def touched(self, fresh: DataFrame, level: int, before: int) -> DataFrame:
        """Earlier keys in the folders that these rows hash to; the others are not read."""
        history = self.of_level(fresh, level, before)
        numbers = [r[0] for r in fresh.select(self._bucket(level)).distinct().limit(MOST_BUCKETS + 1).collect()]
        if len(numbers) <= MOST_BUCKETS:
            history = history.where(F.col("bucket").isin(numbers))
        return history.select(*self.keys)

    def level_for(self, fresh: DataFrame, batch_id: int) -> int:
        """The level for a batch and all before it, onto which these are written if they are on a lower one."""
        before, level = self._sizes(fresh.sparkSession, batch_id)
        wanted = max(level, math.ceil(math.log2(max(1.0, (before + fresh.count()) / self.bucket_rows))))
        if wanted > level and before:
            self._write(self.of_level(fresh, level, batch_id), wanted, batch_id - 1)
        return wanted

    def add(self, rows: DataFrame, level: int, batch_id: int) -> None:
        self._write(rows, level, batch_id)
        counted = rows.agg(F.count(F.lit(1)).alias("n"), F.lit(level).alias("level"))
        write_batch(counted, f"{self.path}/sizes", batch_id)


def dedup_exact(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str] = LISTING_KEYS,
    order: list[str] = ARRIVAL,
    rows_per_file: int = SHARD_ROWS,
    bucket_rows: int = 1_000_000,
) -> StreamingQuery:
    """First arrivals only, over the whole life of the table, in the given order of arrival.

    A batch is reduced to one row per key before the shuffle and loses the keys that
    earlier batches wrote (`SeenKeys`, in a folder beside the table). A batch that is
    repeated writes the same rows and keys again.
    """
    seen = SeenKeys(f"{path.rstrip('/')}-seen", tuple(keys), bucket_rows)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = keep(first_per_key(with_keys(batch, keys), keys, order), "fresh")
        level = seen.level_for(fresh, batch_id)
        new = keep(fresh.join(seen.touched(fresh, level, batch_id), keys, "left_anti"), "new")
        write_batch(new, path, batch_id, rows_per_file)
        seen.add(new, level, batch_id)

    return run_available(stream, checkpoint, on_batch)


def dedup_stateful(
    stream: DataFrame,
    keys: list[str] = LISTING_KEYS,
    time: str = "fetched_at",
    delay: str | None = "1 day",
    spread_by: list[str] | None = None,
    slices: int = SPREAD,
) -> DataFrame:
    """A stream without repeats, its memory in the state store; one row of each key comes
    through, in no promised order.

    With a delay, repeats that come within it of each other are caught and the state stays
    bounded; without one, all repeats are, and the state holds every key (then set the
    session's state store to RocksDB). With `spread_by`, repeats are first removed within
    slices of each key, so that no task gets all copies of a frequent one; give as many slices
    as a frequent key deserves tasks.
    """
    rows = with_keys(stream, keys)
    if delay:
        rows = rows.withWatermark(time, delay)

    def once(part: DataFrame, columns: list[str]) -> DataFrame:
        return part.dropDuplicatesWithinWatermark(columns) if delay else part.dropDuplicates(columns)

    if spread_by:
        number = F.pmod(F.xxhash64(*spread_by), F.lit(slices))
        rows = once(rows.withColumn("_slice", number), [*keys, "_slice"]).drop("_slice")
    return once(rows, keys)


def shard_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    rows_per_file: int = SHARD_ROWS,
    compression: str = "none",
) -> StreamingQuery:
    """Rows written as they arrive, each file exactly once, the run over when input ends."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", compression)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def collect_with_ledger(
    stream: DataFrame,
    rows_path: str,
    ledger_path: str,
    checkpoint: str,
    to_rows: Callable[[DataFrame], DataFrame],
    to_events: Callable[[DataFrame], DataFrame],
    rows_per_file: int = SHARD_ROWS,
) -> StreamingQuery:
    """Rows and ledger events of each batch, both replaced when a batch is repeated.

    Stopped at any point, a restart with the same checkpoint loses and repeats nothing.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(to_rows(batch), rows_path, batch_id, rows_per_file)
        write_batch(to_events(batch), ledger_path, batch_id, rows_per_file)

    return run_available(stream, checkpoint, on_batch)
