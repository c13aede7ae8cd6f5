"""Listing tables out of Parquet shards whose schemas differ by generation.

Types that cannot be promoted (status as text and as number) are brought together per
variant, before the union. Which files are of which variant is read from their footers or,
where the layout is known, told by their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, FractionalType, IntegralType, NumericType, StructType

from letbook import schemas
from letbook.fixed import DATED_FILES, STREAMED_FILES
from letbook.functions.text import money, to_number, to_status, to_time, truthy
from letbook.sources import footers


@dataclass(frozen=True)
class Variant:
    """Shards with one physical schema: which files, what they hold, what to repair.

    `fields` is given where names do not tell the files from others of their folders: then
    tasks look which ones they are.
    """

    schema: str
    glob: str = "*.parquet"
    paths: tuple[str, ...] = ()
    repairs: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    fields: str | None = None


def _nanos(moment: Column) -> Column:
    return F.timestamp_micros(F.floor(moment / 1000).cast("bigint"))


# Known layouts, for folders that hold nothing else; `discover` finds out by itself.
SALE_STREAMED = Variant(schemas.SALE_SHARD_TEXT_STATUS, STREAMED_FILES)
SALE_DATED = Variant(schemas.SALE_SHARD_INT_STATUS, DATED_FILES)
ROOM_SHARDS = Variant(schemas.ROOM_SHARD)


def nanosecond(variant: Variant, column: str = "scraped_at") -> Variant:
    """The same shards with times stored as nanoseconds, a unit Spark reads as plain numbers."""
    return replace(
        variant,
        schema=variant.schema.replace(f"{column} timestamp", f"{column} bigint"),
        repairs={**variant.repairs, column: _nanos},
    )


_UUID = "[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"


def discover(spark: SparkSession, path: str, glob: str = "*.parquet") -> list[Variant]:
    """The variants of a folder, from the footers of its files; files without rows are left out.

    The same column can be whole numbers in one shard and, where values are missing,
    fractions or nothing in the next. One Spark job reads the footers and groups the files
    by folder, schema and name without its numbers; a row per group reaches the driver,
    never one per file.
    """
    files = _files(spark, path, glob)
    if files is None:
        return []
    found = files.mapInArrow(footers.describe, "path string, fields string")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    groups = found.groupBy(
        "fields",
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_replace(F.regexp_replace(name, _UUID, "*"), "[0-9]+", "*").alias("pattern"),
        name.rlike(_UUID).alias("named_by_chance"),
    ).agg(F.count(F.lit(1)).alias("n"))
    by_fields: dict[str, list] = {}
    by_folder: dict[str, list] = {}
    for row in groups.collect():
        by_fields.setdefault(row.fields, []).append(row)
        by_folder.setdefault(row.folder, []).append(row)
    return [_variant(fields, rows, by_folder) for fields, rows in sorted(by_fields.items())]


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """The paths of a folder's files; None when it is not there."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return _or_empty(lambda: reader.load(path).select("path"), lambda: None)


def _told_apart(group, others: list) -> bool:
    """Whether a group's name pattern picks its files and no others of the folder."""
    if re.search(r"[\[\]{}?*\\]", group.folder) or re.search(r"[\[\]{}?\\]", group.pattern):
        return False
    rest = [o for o in others if o is not group]
    if any(group.named_by_chance or o.named_by_chance for o in rest):
        return False
    return not any(fnmatchcase(o.pattern, group.pattern) or fnmatchcase(group.pattern, o.pattern) for o in rest)


def _variant(fields: str, groups: list, by_folder: dict[str, list]) -> Variant:
    kinds = dict(json.loads(fields))
    nanos = [name for name, kind in kinds.items() if kind == footers.NANOS]
    columns = {n: "bigint" if n in nanos else kind for n, kind in kinds.items()}
    by_name = all(_told_apart(g, by_folder[g.folder]) for g in groups)
    folders = sorted({g.folder for g in groups})
    return Variant(
        ", ".join(f"`{n}` {kind}" for n, kind in columns.items()),
        paths=tuple(sorted(f"{g.folder}/{g.pattern}" for g in groups)) if by_name else tuple(folders),
        repairs={n: _nanos for n in nanos},
        fields=None if by_name else fields,
    )


def _or_empty(read: Callable, empty: Callable):
    """What `read` gives, or `empty` when its folder is not there."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty()


def scan(spark: SparkSession, path: str, variant: Variant) -> DataFrame:
    """Rows of one variant; a missing folder or no matching file gives no rows."""
    reader = spark.read.schema(variant.schema)
    if variant.fields:
        # folders of mixed shards: the files are picked and read where their footers are
        kind = StructType.fromDDL(variant.schema)
        listed = [_files(spark, folder, variant.glob) for folder in variant.paths]
        listed = [f for f in listed if f is not None] or [spark.createDataFrame([], "path string")]
        files = reduce(DataFrame.union, listed).distinct()
        rows = files.mapInArrow(footers.read_those(variant.fields, to_arrow_schema(kind)), kind)
    elif variant.paths:
        rows = reader.parquet(*variant.paths)
    else:
        rows = _or_empty(
            lambda: reader.option("pathGlobFilter", variant.glob).parquet(path),
            lambda: spark.createDataFrame([], variant.schema),
        )
    return rows.withColumns({name: repair(F.col(name)) for name, repair in variant.repairs.items()})


def _common(kinds: set[DataType]) -> str | None:
    """The type that holds all of these; None when they are one already."""
    if len(kinds) == 1:
        return None
    if all(isinstance(k, IntegralType) for k in kinds):
        return "bigint"
    return "double" if all(isinstance(k, NumericType) for k in kinds) else "string"


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns a frame lacks are NULL, types that differ are widened."""
    kinds: dict[str, set[DataType]] = {}
    for frame in frames:
        for column in frame.schema:
            kinds.setdefault(column.name, set()).add(column.dataType)
    wider = {name: _common(found) for name, found in kinds.items()}
    same = [
        frame.withColumns({n: F.col(n).cast(wider[n]) for n in frame.columns if wider[n]})
        for frame in frames
    ]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), same)


def _number(rows: DataFrame, name: str) -> Column:
    """The column as double; only text has to be looked at."""
    if name not in rows.columns:
        return F.lit(None).cast("double")
    kind = rows.schema[name].dataType
    if isinstance(kind, FractionalType):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.col(name).cast("double") if isinstance(kind, NumericType) else to_number(F.col(name))


def _status(rows: DataFrame, name: str = "status") -> Column:
    """The status as int, NULL when there is none; only text has to be looked at."""
    if name not in rows.columns:
        return F.lit(None).cast("int")
    status = F.col(name)
    if isinstance(rows.schema[name].dataType, NumericType):
        return F.when(status > 0, status.try_cast("int"))
    return to_status(status)


def settle_status(rows: DataFrame) -> DataFrame:
    """Status as int wherever it came from, so that variants can be put together."""
    return rows.withColumn("status", _status(rows))


def scan_promoted(
    spark: SparkSession, path: str, variants: Sequence[Variant] | None = None
) -> DataFrame:
    """All shards of a folder, columns promoted, status in one type.

    Without any shard, the table is empty and has the sale shard's columns.
    """
    known = discover(spark, path) if variants is None else variants
    frames = [scan(spark, path, v) for v in known]
    if not frames:
        frames = [spark.createDataFrame([], SALE_STREAMED.schema)]
    return union_by_name([settle_status(rows) for rows in frames])


def _optional(rows: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast(kind)


def type_sale(rows: DataFrame) -> DataFrame:
    """Sale rows in the table's types: bad numbers and times NULL, empty texts NULL."""

    def text(name: str) -> Column:
        return truthy(_optional(rows, name, "string").cast("string")).alias(name)

    return rows.select(
        text("url"),
        text("address"),
        text("postcode"),
        _number(rows, "price").alias("price"),
        _number(rows, "bedrooms").alias("bedrooms"),
        text("property_type"),
        text("floor_area"),
        _status(rows).alias("status"),
        to_time(_optional(rows, "scraped_at", "timestamp")).alias("scraped_at"),
    )


def type_room(rows: DataFrame) -> DataFrame:
    """Room rows in the table's types, the misspelled column repaired, the price as number."""

    def text(name: str) -> Column:
        return truthy(_optional(rows, name, "string").cast("string")).alias(name)

    location = F.coalesce(
        truthy(_optional(rows, "location", "string")), truthy(_optional(rows, "locatiom", "string"))
    )
    return rows.select(
        text("source"),
        text("postcode"),
        text("title"),
        text("url"),
        text("price_text"),
        location.alias("location"),
        text("room_type"),
        text("available"),
        to_time(_optional(rows, "scraped_at", "timestamp")).alias("scraped_at"),
        _status(rows).alias("status"),
        money(_optional(rows, "price_text", "string").cast("string")).alias("price_norm"),
    )


def _load(
    spark: SparkSession,
    path: str,
    variants: Sequence[Variant] | None,
    typed: Callable[[DataFrame], DataFrame],
    empty: str,
) -> DataFrame:
    known = discover(spark, path) if variants is None else variants
    frames = [typed(scan(spark, path, v)) for v in known]
    return union_by_name(frames or [typed(spark.createDataFrame([], empty))])


def load_sale(
    spark: SparkSession, path: str, variants: Sequence[Variant] | None = None
) -> DataFrame:
    """The sale table of a folder of shards, each variant typed before the union."""
    return _load(spark, path, variants, type_sale, SALE_STREAMED.schema)


def load_room(
    spark: SparkSession, path: str, variants: Sequence[Variant] | None = None
) -> DataFrame:
    """The room table of a folder of shards, each variant typed before the union."""
    return _load(spark, path, variants, type_room, ROOM_SHARDS.schema)


def read_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a dated table that was written typed.

    Nothing is coerced on the way, so filters reach the Parquet scan, and those on the day
    or the run leave whole folders unread.
    """
    return spark.read.schema(f"{schema}, snapshot_date date, run_id string").parquet(path)


def canonical_sale(rows: DataFrame, stamp: Column | None = None) -> DataFrame:
    """The row a sale shard holds: texts never NULL, whole numbers, status as text, stamped."""

    def text(name: str) -> Column:
        return F.coalesce(_optional(rows, name, "string").cast("string"), F.lit("")).alias(name)

    return rows.select(
        text("url"),
        text("address"),
        text("postcode"),
        _number(rows, "price").try_cast("bigint").alias("price"),
        _number(rows, "bedrooms").try_cast("int").alias("bedrooms"),
        text("property_type"),
        text("floor_area"),
        text("status"),
        (F.current_timestamp() if stamp is None else stamp).alias("scraped_at"),
    )


def sale_rejects(rows: DataFrame) -> DataFrame:
    """Rows whose price or bedrooms hold something that is no number."""

    def bad(name: str) -> Column:
        given = truthy(_optional(rows, name, "string").cast("string"))
        return given.isNotNull() & to_number(given).isNull()

    return rows.where(bad("price") | bad("bedrooms"))


def canonical_room(rows: DataFrame, source: str, stamp: Column | None = None) -> DataFrame:
    """The row a room shard holds: constant source, texts never NULL, status 0 when unknown."""

    def text(name: str) -> Column:
        return F.coalesce(_optional(rows, name, "string").cast("string"), F.lit("")).alias(name)

    return rows.select(
        F.lit(source).alias("source"),
        text("postcode"),
        text("title"),
        text("url"),
        text("price_text"),
        text("location"),
        text("room_type"),
        text("available"),
        (F.current_timestamp() if stamp is None else stamp).alias("scraped_at"),
        F.coalesce(_status(rows), F.lit(0)).alias("status"),
    )


def fingerprint(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """File count, latest change in whole seconds and total bytes; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("modificationTime", "length")
    )
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.max(F.unix_seconds("modificationTime")), F.lit(0)).alias("latest_mtime"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )
