"""Keys that hold very many rows: finding them, and joining per-key facts back on rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A key is hot when it holds a million rows and more than 1/100,000 of all of them. So fewer
# than 100,000 keys can be hot, whatever the data, and a list of them is small enough to
# broadcast.
HOT_ROWS = 1_000_000
HOT_SHARE = 100_000


def prefixed(rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return rows.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def equal(keys: Sequence[str], prefix: str) -> Column:
    """Key columns equal to their prefixed twins; NULL keys match each other."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def hot_keys(
    counts: DataFrame, keys: Sequence[str], n_rows: str, hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """The hot keys, each with `_parts`, the number of tasks its rows deserve; None without any.

    `counts` is a stored table with one row per key and its number of rows. The parts of
    all keys together are below twice the number of keys that could be hot.
    """
    size = counts.agg(F.sum(n_rows).alias("total"), F.max(n_rows).alias("most")).first()
    least = max((size["total"] or 0) // HOT_SHARE + 1, hot_rows)
    if (size["most"] or 0) < least:
        return None
    parts = F.ceil(F.col(n_rows) / least).cast("int")
    return counts.where(F.col(n_rows) >= least).select(*keys, parts.alias("_parts"))


def mark_hot(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows, with `_parts` of their key where it is hot, else NULL."""
    listed = F.broadcast(prefixed(hot, keys, "_hot_"))
    return rows.join(listed, equal(keys, "_hot_"), "left").drop(*[f"_hot_{k}" for k in keys])


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with the facts of its key, of which `facts` has one row per key.

    A plain join: small facts are broadcast by their size, and adaptive execution splits the rows of a hot
    key over several tasks.
    """
    same = equal(keys, "_fact_")
    return rows.join(prefixed(facts, keys, "_fact_"), same, "left").drop(*[f"_fact_{k}" for k in keys])
