"""Text, number and time coercions. All of them are native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letbook.fixed import BLANKS


def strip(text: Column) -> Column:
    """Cut blanks of every kind, not only spaces, at both ends."""
    return F.trim(text, F.lit(BLANKS))


def truthy(value: Column) -> Column:
    """NULL in place of an empty text."""
    return F.nullif(value, F.lit(""))


def first_truthy(*values: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[truthy(v) for v in values])


def or_blank(value: Column) -> Column:
    """Empty text in place of NULL."""
    return F.coalesce(value.cast("string"), F.lit(""))


def clean_key(text: Column) -> Column:
    """Stripped and upper-cased."""
    return F.upper(strip(text.cast("string")))


def to_number(value: Column) -> Column:
    """Double, or NULL where the text is not a number; NaN counts as missing.

    A trailing type letter (`1d`, `2f`) is a number for a JVM cast but not for data.
    """
    text = value.cast("string")
    number = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def to_time(value: Column) -> Column:
    """Timestamp, or NULL where the text is not one."""
    return value.try_cast("timestamp")


def to_status(value: Column) -> Column:
    """HTTP status as int; network failures (`fail`, 0) and other texts give NULL."""
    text = value.cast("string")
    return F.nullif(F.when(text.rlike("^[0-9]+$"), text.try_cast("int")), F.lit(0))


def is_success(status: Column) -> Column:
    """True for 200 given as number or text, false for everything else including NULL."""
    return F.coalesce(status.cast("string").try_cast("int") == 200, F.lit(False))


def digits_int(value: Column) -> Column:
    """All-digit text as bigint; floats, signs and other texts give NULL."""
    return F.when(value.rlike("^[0-9]+$"), value.try_cast("bigint"))


def bedroom_count(value: Column) -> Column:
    """Number as int, the fraction cut; NULL where it is no number."""
    return to_number(value).try_cast("int")


def money(text: Column) -> Column:
    """Whole pounds after the first pound sign that digits or commas follow."""
    digits = F.regexp_extract(text, "£([0-9,]+)", 1)
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint")


def postcode_of(analytics: Column, outcode: Column, incode: Column) -> Column:
    """The analytics postcode, else outward and inward code joined, else NULL."""
    joined = strip(F.concat_ws(" ", outcode, incode))
    return first_truthy(analytics, joined)


def grouped_number(value: Column) -> Column:
    """`1234567` as `1,234,567`."""
    return F.format_number(value, 0)


def minutes_seconds(seconds: Column) -> Column:
    """Seconds as `mm:ss`; the minutes grow past two digits when they have to."""
    whole = F.floor(seconds).cast("bigint")
    minutes = F.floor(whole / 60).cast("bigint")
    shown = F.format_string("%02d:%02d", minutes, F.pmod(whole, F.lit(60)))
    return F.when(seconds.isNotNull(), shown)


def day_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def epoch_label(moment: Column) -> Column:
    return F.unix_millis(moment)
