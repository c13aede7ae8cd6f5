"""Free SQL over the listing tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from letbook.fixed import ROOM_VIEW, SALE_VIEW


def register(tables: Mapping[str, DataFrame]) -> None:
    """Temporary views by name; empty tables are registered too."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)


def register_listings(sale: DataFrame, room: DataFrame) -> None:
    """Both listing tables under their own names and those that existing queries use."""
    register({"sale_listings": sale, SALE_VIEW: sale, "room_listings": room, ROOM_VIEW: room})


def run_sql(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame], values: Mapping[str, object] | None = None
) -> DataFrame:
    """The result of one query over the given tables, as it is; `:name` in the text stands for a value.

    Tables are named by common table expressions of the one statement, so nothing is shared between threads and
    a session's own views stay as they are. Anything but a query is a syntax error, as the text stands where
    only a query may.
    """
    named = ", ".join(f"`{name}` AS (SELECT * FROM {{table_{i}}})" for i, name in enumerate(tables))
    query = text.strip().rstrip(";").replace("{", "{{").replace("}", "}}")
    statement = f"{'WITH ' if named else ''}{named} SELECT * FROM (\n{query}\n)"
    return spark.sql(statement, args=dict(values or {}), **{f"table_{i}": rows for i, rows in enumerate(tables.values())})
