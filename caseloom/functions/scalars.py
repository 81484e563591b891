"""Column -> Column building blocks for cleaning codes, numbers, dates and labels.

Every function here is a composition of built-in expressions, so it stays inside whole-stage code
generation.  Two number-to-integer rules exist on purpose: staging truncates (``standard_code``), the
warehouse rounds half to even (``canonical_code``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plain decimal or exponent notation.  Spark alone would also take '1d', '1f' and 'NaN' as numbers.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Cell texts that a CSV reader treats as missing.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


# ---------------------------------------------------------------- numbers
def parse_number(text: Column, strict: bool = False) -> Column:
    """Text to double; anything that is not plainly a number becomes NULL (or fails when strict)."""
    if strict:
        return F.nullif(text.cast("double"), F.lit(float("nan")))
    return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))


def double_of(df: DataFrame, name: str, strict: bool = False) -> Column:
    """``df[name]`` as double, skipping the text round trip for columns that are numeric already."""
    kind = dict(df.dtypes)[name]
    if kind in _NUMERIC_TYPES or kind.startswith("decimal"):
        return F.nullif(F.col(name).cast("double"), F.lit(float("nan")))
    return parse_number(F.nullif(F.trim(F.col(name).cast("string")), F.lit("")), strict)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_MARKERS), text)


def fill_default(number: Column, default: float) -> Column:
    return F.coalesce(number, F.lit(default))


def standard_code(text: Column) -> Column:
    """Staging code: number, missing -> 0, truncated towards zero, as text; '0' means no code."""
    whole = F.coalesce(parse_number(text), F.lit(0.0)).try_cast("int")
    return zero_code_to_null(whole.cast("string"))


def truncated_code(text: Column) -> Column:
    """``standard_code`` before its zero rule."""
    return F.coalesce(parse_number(text), F.lit(0.0)).try_cast("int").cast("string")


def zero_code_to_null(code: Column) -> Column:
    return F.nullif(code, F.lit("0"))


def half_even_int(text: Column, strict: bool = False) -> Column:
    """Text to integer, ties to the even neighbour (1.5 -> 2, 2.5 -> 2)."""
    number = F.rint(parse_number(F.trim(text.cast("string")), strict))
    return number.cast("int") if strict else number.try_cast("int")


def canonical_code(text: Column, strict: bool = False) -> Column:
    """Warehouse code: '07', ' 7 ' and '7.0' are all '7'."""
    return half_even_int(text, strict).cast("string")


def or_unknown(code: Column, member: str) -> Column:
    return F.coalesce(code, F.lit(member))


def blank_to_double(text: Column, strict: bool = False) -> Column:
    return parse_number(F.nullif(F.trim(text.cast("string")), F.lit("")), strict)


def sanitised_number(text: Column) -> Column:
    """Number left after dropping every character that cannot be part of one."""
    kept = F.regexp_replace(text.cast("string"), "[^0-9.-]", "")
    return F.nullif(kept, F.lit("")).try_cast("double")


def cap(number: Column, limit: float) -> Column:
    """``least`` that keeps NULL as NULL."""
    return F.when(number > limit, F.lit(limit)).otherwise(number)


# ---------------------------------------------------------------- dates and times
def dual_format_date(text: Column) -> Column:
    """'M/d/yyyy ...' or 'yyyy-MM-dd[T ]...' to date, whatever blanks stand around; unreadable text becomes NULL."""
    text = F.trim(text)
    token = F.substring_index(text, " ", 1)
    month, day = F.substring_index(token, "/", 1), F.substring_index(F.substring_index(token, "/", 2), "/", -1)
    # Rearranged to y-M-d and cast: much cheaper than a pattern parser, same one- or two-digit rule.
    rearranged = F.concat_ws("-", F.substring_index(token, "/", -1), month, day).try_cast("date")
    us = F.when(F.substring_index(token, "/", 3) == token, rearranged)
    return F.when(text.contains("/"), us).otherwise(F.substring_index(token, "T", 1).try_cast("date"))


def date_of(df: DataFrame, name: str) -> Column:
    """``df[name]`` as a date whatever its stored type."""
    kind = dict(df.dtypes)[name]
    return F.col(name).cast("date") if kind.startswith(("date", "timestamp")) else dual_format_date(F.col(name))


# US spellings tried in this order; the first one is what extracts usually hold.
US_TIMESTAMPS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")


def to_timestamp_or_null(text: Column) -> Column:
    """ISO or US text to timestamp, decided per value, so patterns are only tried where they can fit."""
    us = F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in US_TIMESTAMPS])
    return F.when(text.contains("/"), us).otherwise(F.try_to_timestamp(text))


def hour_of_code(time_code: Column) -> Column:
    """1530 -> 15, by integer division."""
    return F.call_function("div", time_code, F.lit(100)).cast("int")


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 20), "Evening")
        .otherwise("Night")
    )


def padded_hour(text: Column) -> Column:
    """First two characters of the time code padded to four, sign included; 0 when unreadable."""
    whole = parse_number(text.cast("string")).try_cast("bigint")
    digits = F.abs(whole).cast("string")
    width = F.when(whole < 0, 3).otherwise(4)
    padded = F.lpad(digits, F.greatest(width, F.length(digits)), F.lit("0"))
    signed = F.when(whole < 0, F.concat(F.lit("-"), padded)).otherwise(padded)
    return F.coalesce(F.substring(signed, 1, 2).try_cast("int"), F.lit(0))


def sunday_zero_weekday(day: Column) -> Column:
    return F.dayofweek(day) - 1


def date_parts(day: Column) -> list[Column]:
    """year, month, day, day_of_week (Sunday = 0), quarter."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        sunday_zero_weekday(day).alias("day_of_week"),
        F.quarter(day).alias("quarter"),
    ]


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


# ---------------------------------------------------------------- display text
def two_decimals(number: Column) -> Column:
    return F.format_string("%.2f", number)


def thousands(count: Column) -> Column:
    return F.format_number(count, 0)


def whole_age(age: Column) -> Column:
    """Rounded half to even, missing as 0."""
    return F.bround(F.coalesce(age, F.lit(0.0)), 0).cast("int")


def short_label(label: Column, width: int = 15) -> Column:
    return F.concat(F.substring(F.coalesce(label, F.lit("None")), 1, width), F.lit("..."))


# ---------------------------------------------------------------- predicates
def null_island_both_zero(lat: Column, lon: Column) -> Column:
    """Quality rule: both coordinates are exactly zero."""
    return (lat == 0) & (lon == 0)


def off_null_island(lat: Column, lon: Column) -> Column:
    """Neither coordinate is zero; a NULL coordinate makes it NULL, so filters drop the row."""
    return (lat != 0) & (lon != 0)


def in_hash_sample(key: Column, percent: int) -> Column:
    """Repeatable sample: the first 32 bits of md5(key), modulo 100."""
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent
