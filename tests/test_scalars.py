from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.functions.calendar import is_holiday


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers_reject_type_suffixes_and_nan(spark):
    texts = ["1d", "1f", "NaN", "1e3", " 7 ", "", "x", None, "-.5", "+4.", "0x1p3", "Infinity"]
    assert apply(spark, X.parse_number, texts) == [
        None, None, None, 1000.0, 7.0, None, None, None, -0.5, 4.0, None, None]


def test_strict_number_fails_on_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, lambda c: X.parse_number(c, strict=True), ["x"])


def test_standard_code_truncates_and_drops_zero(spark):
    texts = ["1.9", "-1.9", "x", " 7 ", "", "0", None, "0.4"]
    assert apply(spark, X.standard_code, texts) == ["1", "-1", None, "7", None, None, None, None]


def test_canonical_code_rounds_half_to_even(spark):
    texts = ["1.5", "2.5", "07", "101.0", "", "x", " 3 ", None, "99999999999"]
    assert apply(spark, X.canonical_code, texts) == ["2", "2", "7", "101", None, None, "3", None, None]


def test_dual_format_dates(spark):
    texts = [
        "01/08/2020 12:00:00 AM", "1/8/2020", "2020-01-08T00:00:00.000", "2020-01-08", "bad", None, "13/45/2020",
        "1/8/20", "1/2/2020/4", "1/2",
    ]
    eighth = date(2020, 1, 8)
    assert apply(spark, X.dual_format_date, texts) == [eighth] * 4 + [None] * 6
    padded = [" 2020-01-08", "  01/08/2020 ", " 1/8/2020 12:00:00 AM", "2020-01-08 10:00:00", "2020-01-08x", " "]
    assert apply(spark, X.dual_format_date, padded) == [eighth] * 4 + [None] * 2


def test_timestamps_of_mixed_formats(spark):
    texts = ["2020-01-08T13:30:00.000", "01/08/2020 01:30:00 PM", "1/8/2020", "bad", None]
    assert apply(spark, X.to_timestamp_or_null, texts) == [
        datetime(2020, 1, 8, 13, 30), datetime(2020, 1, 8, 13, 30), datetime(2020, 1, 8), None, None]


def test_hours_and_bands(spark):
    codes = [0, 459, 500, 1159, 1200, 1659, 1700, 2059, 2100, 2359, 12345]
    assert apply(spark, X.hour_of_code, codes, "int") == [0, 4, 5, 11, 12, 16, 17, 20, 21, 23, 123]
    bands = apply(spark, lambda c: X.time_of_day(X.hour_of_code(c)), codes[:10], "int")
    assert bands == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night",
                     "Night"]


def test_padded_hour(spark):
    texts = ["5", "130", "1230", "12345", "930.7", "-130", "-5", "x", None, "1e12"]
    assert apply(spark, X.padded_hour, texts) == [0, 1, 12, 12, 9, -1, 0, 0, 0, 10]


def test_cap_keeps_null(spark):
    assert apply(spark, lambda c: X.cap(c, 80.0), [81.0, 80.0, None, 3.0], "double") == [80.0, 80.0, None, 3.0]


def test_sanitised_number(spark):
    assert apply(spark, X.sanitised_number, ["$1,234.5", "abc", "", None, "-3 yrs", "1-2"]) == [
        1234.5, None, None, None, -3.0, None]


def test_weekday_of_dimension_starts_on_sunday(spark):
    assert apply(spark, X.sunday_zero_weekday, [date(2023, 1, 1), date(2023, 1, 2)], "date") == [0, 1]


def test_missing_markers(spark):
    assert apply(spark, X.missing_to_null, ["NA", "", "null", "n/a", "NAB", "0", " "]) == [
        None, None, None, None, "NAB", "0", " "]


def test_display_texts(spark):
    assert apply(spark, X.thousands, [1234567], "bigint") == ["1,234,567"]
    assert apply(spark, X.whole_age, [34.5, 35.5, None], "double") == [34, 36, 0]
    assert apply(spark, X.short_label, ["STRONG-ARM (HANDS)", "-", None]) == [
        "STRONG-ARM (HAN...", "-...", "None..."]
    assert apply(spark, X.two_decimals, [1.0, 12345.678], "double") == ["1.00", "12345.68"]
    assert apply(spark, X.minute_text, [datetime(2024, 1, 2, 3, 4, 5)], "timestamp") == ["2024-01-02 03:04"]


def test_three_null_island_rules(spark):
    places = spark.createDataFrame(
        [(0.0, 0.0), (0.0, -118.0), (34.0, 0.0), (34.0, -118.0), (None, -118.0)], "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    assert places.where(X.off_null_island(lat, lon)).count() == 1
    assert places.where(X.null_island_both_zero(lat, lon)).collect() == [(0.0, 0.0)]
    filled = places.select(*[X.fill_default(c, 0.0).alias(n) for c, n in ((lat, "lat"), (lon, "lon"))])
    assert filled.where(X.off_null_island(lat, lon)).collect() == [(34.0, -118.0)]


# The public federal calendar with observed days.
HOLIDAYS = {
    2021: "01-01 01-18 02-15 05-31 06-18 06-19 07-04 07-05 09-06 10-11 11-11 11-25 12-24 12-25 12-31",
    2022: "01-01 01-17 02-21 05-30 06-19 06-20 07-04 09-05 10-10 11-11 11-24 12-25 12-26",
    2023: "01-01 01-02 01-16 02-20 05-29 06-19 07-04 09-04 10-09 11-10 11-11 11-23 12-25",
}


@pytest.mark.parametrize("year", HOLIDAYS)
def test_holidays(spark, year):
    days = spark.sql(f"select explode(sequence(date'{year}-01-01', date'{year}-12-31')) as ds")
    found = [f"{r['ds']:%m-%d}" for r in days.where(is_holiday("ds")).orderBy("ds").collect()]
    assert " ".join(found) == HOLIDAYS[year]
