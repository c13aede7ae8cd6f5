"""Work lists: locations and URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letbook.fixed import FAILED_URL_FILES
from letbook.functions.text import clean_key, strip
from letbook.functions.urls import location_id


def read_list_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns as text, with the place of each line.

    Blanks around header names are cut, so `OuterCode, Postcode` has a column `Postcode`.
    """
    rows = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return rows.withColumn("position", F.monotonically_increasing_id())


def pick_column(columns: list[str], wanted: str | None) -> str:
    """The wanted column when it is there, else `Postcode`, else the first."""
    for name in (wanted, "Postcode"):
        if name and name in columns:
            return name
    return columns[0]


def distinct_keys(rows: DataFrame, key: Column, position: Column) -> DataFrame:
    """Clean keys without repeats, each with the place where it first stood."""
    return (
        rows.select(clean_key(key).alias("key"), position.alias("position"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("position").alias("position"))
    )


def location_list(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    rows = read_list_csv(spark, path)
    name = pick_column([c for c in rows.columns if c != "position"], column)
    return distinct_keys(rows, F.col(name), F.col("position"))


def location_ids(rows: DataFrame, code: str = "OuterCode") -> DataFrame:
    """Rows with the text id of their location number."""
    return rows.withColumn("location_id", location_id(F.col(code)))


def url_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stripped lines without blanks and repeats."""
    return (
        lines.select(strip(F.col(column)).alias("url")).where(F.col("url") != "").distinct()
    )


def read_url_list(
    spark: SparkSession, path: str, glob: str = FAILED_URL_FILES
) -> DataFrame:
    return url_list(spark.read.option("pathGlobFilter", glob).text(path))
