"""The JSON model that detail pages embed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letbook.fixed import MODEL_PATTERN, MODEL_START
from letbook.functions.text import bedroom_count, digits_int, first_truthy, postcode_of, to_number
from letbook.schemas import PAGE_MODEL

_BAD = "_unparsed"
_OPTIONS = {"columnNameOfCorruptRecord": _BAD, "allowSingleQuotes": "false"}
_SCHEMA = f"struct<{PAGE_MODEL}>"


def _by_braces(rows: DataFrame, html: Column, name: str) -> DataFrame:
    """The object that starts at the first brace after the marker.

    The JSON reader finds the end itself and ignores what follows, so braces inside texts
    do no harm. Only where it fails is the text read again, without line breaks.
    """
    schema = f"struct<{PAGE_MODEL}, {_BAD}: string>"
    text = F.nullif(F.regexp_extract(html, MODEL_START, 1), F.lit(""))
    first, second = F.col("_first"), F.col("_second")
    again = F.from_json(F.translate("_text", "\r\n", ""), schema, _OPTIONS)
    # each step is a column of its own, so that no text is parsed twice
    return (
        rows.withColumn("_text", text)
        .withColumn("_first", F.from_json("_text", schema, _OPTIONS))
        .withColumn("_second", F.when(first[_BAD].isNotNull(), again))
        .withColumn(
            name,
            F.coalesce(F.when(first[_BAD].isNull(), first), F.when(second[_BAD].isNull(), second)),
        )
        .drop("_text", "_first", "_second")
    )


def _by_pattern(rows: DataFrame, html: Column, name: str) -> DataFrame:
    """The shortest text from the marker's brace to `};</script>`; it must be one object."""
    text = F.nullif(F.regexp_extract(html, MODEL_PATTERN, 1), F.lit(""))
    # inside brackets, anything after the object is a syntax error instead of being ignored
    several = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), f"array<{_SCHEMA}>", {"allowSingleQuotes": "false"}
    )
    return (
        rows.withColumn("_several", several)
        .withColumn(name, F.when(F.size("_several") == 1, F.get("_several", F.lit(0))))
        .drop("_several")
    )


def with_model(
    rows: DataFrame, form: str = "braces", html: Column | None = None, name: str = "model"
) -> DataFrame:
    """Rows with the model of their page: NULL where it is missing or malformed.

    `form` is `braces` or `pattern`, the two ways of finding where the model ends.
    """
    find = {"braces": _by_braces, "pattern": _by_pattern}[form]
    return find(rows, F.col("html") if html is None else html, name)


def page_variant(html: Column) -> Column:
    """The model of a page whatever its shape, as a VARIANT: NULL where it is missing or malformed.

    The text is found as in the pattern form and parsed once, without a schema.
    """
    return F.try_parse_json(F.nullif(F.regexp_extract(html, MODEL_PATTERN, 1), F.lit("")))


def leaf(model: Column, path: str, kind: str = "string") -> Column:
    """A leaf of a VARIANT by its path, dots between names; NULL where it is missing, null or of another kind."""
    return F.try_variant_get(model, "$." + path, kind)


def variant_fields(model: Column, strict_price: bool = True) -> list[Column]:
    """Typed listing fields of a VARIANT model; see `model_fields`."""
    tracked = "analyticsInfo.analyticsProperty."
    price_text = leaf(model, tracked + "price")
    sizings = leaf(model, "propertyData.sizings", "array<variant>")
    displays = F.transform(sizings, lambda s: F.struct(leaf(s, "display").alias("display")))
    address = "propertyData.address."
    return [
        first_truthy(leaf(model, address + "displayAddress")).alias("address"),
        postcode_of(leaf(model, tracked + "postcode"), leaf(model, address + "outcode"), leaf(model, address + "incode")).alias(
            "postcode"
        ),
        (digits_int(price_text) if strict_price else to_number(price_text).try_cast("bigint")).alias("price"),
        bedroom_count(leaf(model, "propertyData.bedrooms")).alias("bedrooms"),
        first_truthy(leaf(model, "propertyData.propertySubType"), leaf(model, "propertyData.propertyType")).alias("property_type"),
        first_filled(displays, "display").alias("floor_area"),
    ]


def first_filled(items: Column, field: str) -> Column:
    """The field of the first array item in which it is neither NULL nor empty."""
    return F.get(F.filter(items, lambda x: x[field] != ""), F.lit(0))[field]


def model_fields(model: Column, strict_price: bool = True) -> list[Column]:
    """Typed listing fields of a model.

    `strict_price` takes whole non-negative numbers only; otherwise any number counts.
    """
    data = model.propertyData
    tracked = model.analyticsInfo.analyticsProperty
    price = digits_int(tracked.price) if strict_price else to_number(tracked.price).try_cast("bigint")
    return [
        first_truthy(data.address.displayAddress).alias("address"),
        postcode_of(tracked.postcode, data.address.outcode, data.address.incode).alias("postcode"),
        price.alias("price"),
        bedroom_count(data.bedrooms).alias("bedrooms"),
        first_truthy(data.propertySubType, data.propertyType).alias("property_type"),
        first_filled(data.sizings, "display").alias("floor_area"),
    ]
