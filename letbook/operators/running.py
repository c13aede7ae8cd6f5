"""Running and rolling computations over long logs, in which no hot key is one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letbook.operators.skew import HOT_ROWS, hot_keys, mark_hot
from letbook.session import keep

BUCKET_SECONDS = 600
#: Ranges of a hot key's rows for each task that they deserve.
RANGES = 2
BLOCK_ROWS = 100_000


def time_bucket(time: str, seconds: int = BUCKET_SECONDS) -> Column:
    """Number of the time slice a row falls in."""
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (seconds * 1_000_000))


def running(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
    began: Column | None = None,
) -> DataFrame:
    """Adds to each row, within its key and in the given order:

    `done`, its number; `total`, the rows of the key; `started`, the least value of
    `began`, unless given the first order column; and each of `sums` up to the row.

    Keys are counted first. Without hot ones this is a plain window. The rows of hot keys
    are cut into buckets that are groups of their own: at quantiles of the whole order,
    sampled by a range partitioning, so that buckets are even whatever the times are (all
    in one second, or none), or by `bucket`, if given, which grows with the first order
    column. What came before a bucket is added up over one row per bucket. That start value
    joins its bucket as a first row, which costs no second shuffle.
    """
    counts = keep(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "counts")
    hot = hot_keys(counts, keys, "_n", hot_rows)
    lines = rows.withColumns(
        {
            "_n": F.lit(1).cast("bigint"),
            "_began": F.col(order[0]) if began is None else began,
            **{f"_{name}": value for name, value in sums.items()},
        }
    )
    if hot is None:
        group = Window.partitionBy(*keys)
        upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return lines.select(
            *rows.columns,
            F.sum("_n").over(upto).alias("done"),
            F.sum("_n").over(group).alias("total"),
            F.min("_began").over(group).alias("started"),
            *[F.sum(f"_{name}").over(upto).alias(name) for name in sums],
        )

    marked = mark_hot(lines, hot, keys).withColumn("_line", F.lit(1))
    if bucket is None:
        spread = marked.where(F.col("_parts").isNotNull())
        # a hot key has rows in a range more than it has tasks at least, and there are few hot keys
        n_ranges = RANGES * (hot.agg(F.sum("_parts")).first()[0] + 1)
        ranged = spread.repartitionByRange(n_ranges, *keys, *order).withColumn("_bucket", F.spark_partition_id().cast("bigint"))
        few = marked.where(F.col("_parts").isNull()).withColumn("_bucket", F.lit(None).cast("bigint"))
        # stored, as a range sampled again could cut elsewhere
        lines = few.unionByName(keep(ranged, "ranges"))
    else:
        lines = marked.withColumn("_bucket", F.when(F.col("_parts").isNotNull(), bucket))
    per_bucket = (
        lines.where(F.col("_parts").isNotNull())
        .groupBy(*keys, "_bucket")
        .agg(
            F.sum("_n").alias("_n"),
            F.min("_began").alias("_started"),
            *[F.sum(f"_{name}").alias(f"_{name}") for name in sums],
        )
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *keys,
        "_bucket",
        F.lit(0).alias("_line"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        F.sum("_n").over(whole).alias("_total"),
        F.min("_started").over(whole).alias("_started"),
        *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in sums],
    )
    group = Window.partitionBy(*keys, "_bucket")
    upto = group.orderBy("_line", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = lines.unionByName(starts, allowMissingColumns=True)
    # keys that are not hot have no start rows: their one group is the whole key
    return (
        every.select(
            *rows.columns,
            "_line",
            F.sum("_n").over(upto).alias("done"),
            F.coalesce(F.max("_total").over(group), F.sum("_n").over(group)).alias("total"),
            F.coalesce(F.min("_started").over(group), F.min("_began").over(group)).alias("started"),
            *[F.sum(f"_{name}").over(upto).alias(name) for name in sums],
        )
        .where(F.col("_line") == 1)
        .drop("_line")
    )


def rolling_mean(
    rows: DataFrame,
    keys: list[str],
    number: str,
    value: str,
    size: int,
    name: str,
    default: float,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds the mean of `value` over the last `size` rows of the key, this one included.

    `number` counts the rows of a key from 1. A key is cut into blocks of consecutive
    rows; the last `size - 1` rows of a block are lent to the next one. Means come from
    running sums, so a row costs the same whatever the size. The sums are of whole
    millionths, which do not drift, so no block size changes a mean; they are kept in an
    upper and a lower half, so that no block overflows. A value that is NULL, NaN, infinite
    or beyond 64 bits of millionths is no measurement.
    """
    measured = F.col(value).cast("double")
    usable = ~F.isnan(measured) & (F.abs(measured) < float("inf"))
    whole = F.when(usable, F.round(measured * 1_000_000)).try_cast("bigint")
    rows = rows.withColumn("_whole", whole).withColumns(
        {"_upper": F.shiftright("_whole", 32), "_lower": F.col("_whole").bitwiseAND(F.lit(0xFFFFFFFF))}
    )
    place = F.col(number) - 1
    home = F.floor(place / block_rows)
    lent = F.pmod(place, F.lit(block_rows)) >= block_rows - (size - 1)
    lines = rows.withColumn("_home", home).withColumn(
        "_block",
        F.explode(
            F.when(lent, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array("_home"))
        ),
    )
    ordered = Window.partitionBy(*keys, "_block").orderBy(number)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = ("_upper", "_lower")
    sums = lines.withColumns(
        {
            **{p: F.coalesce(F.sum(p).over(upto), F.lit(0)) for p in parts},
            "_count": F.count("_whole").over(upto),
        }
    )
    recent = sums.withColumns({p: F.col(p) - F.lag(p, size, 0).over(ordered) for p in (*parts, "_count")})
    total = F.col("_upper") * float(1 << 32) + F.col("_lower")
    mean = F.when(F.col("_count") > 0, total / F.col("_count") / 1_000_000).otherwise(F.lit(default))
    return (
        recent.where(F.col("_home") == F.col("_block"))
        .withColumn(name, mean)
        .drop("_home", "_block", "_count", "_whole", *parts)
    )
