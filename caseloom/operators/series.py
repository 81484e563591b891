"""Daily series: counting, windows over past rows, spines, holdout, error measures.

A series has one row per day and key, so any of its groups is bounded by the calendar (a century is
36,525 rows).  Windows are therefore safe here, with or without keys; they are never used on facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

HOLDOUT_ROWS = 90
MINIMUM_HISTORY = 100


class ShortHistory(ValueError):
    """A series has fewer days than a model needs."""


def daily_counts(rows: DataFrame, day: str = "date_occ", keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., ds, y): rows per day, rows without a day left out."""
    return (
        rows.where(F.col(day).isNotNull())
        .groupBy(*keys, F.col(day).alias("ds"))
        .agg(F.count("*").alias("y"))
    )


def _by_day(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("ds")


def until(series: DataFrame, cutoff: date) -> DataFrame:
    return series.where(F.col("ds") <= F.lit(cutoff))


def until_day_before(series: DataFrame, as_of: date) -> DataFrame:
    return series.where(F.col("ds") <= F.date_sub(F.lit(as_of), 1))


def lag_column(k: int, keys: Sequence[str] = (), y: str = "y") -> Column:
    """The value k rows earlier."""
    return F.lag(y, k).over(_by_day(keys))


def _full_past(measure: Column, width: int, keys: Sequence[str], y: str) -> Column:
    frame = _by_day(keys).rowsBetween(-width, -1)
    return F.when(F.count(y).over(frame) == width, measure.over(frame))


def past_mean(width: int, keys: Sequence[str] = (), y: str = "y") -> Column:
    """Mean of the ``width`` rows before this one, NULL until there are that many."""
    return _full_past(F.avg(y), width, keys, y)


def past_std(width: int, keys: Sequence[str] = (), y: str = "y") -> Column:
    """Sample deviation over the same frame as ``past_mean``."""
    return _full_past(F.stddev_samp(y), width, keys, y)


def moving_average(width: int = 7, keys: Sequence[str] = (), y: str = "y") -> Column:
    """Mean of this row and up to ``width - 1`` rows before it."""
    return F.avg(y).over(_by_day(keys).rowsBetween(1 - width, 0))


def holdout_flag(series: DataFrame, rows: int = HOLDOUT_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``is_test``: true on the last ``rows`` rows of each series."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    return series.withColumn("is_test", F.row_number().over(newest_first) <= rows)


def holdout_split(
    series: DataFrame, rows: int = HOLDOUT_ROWS, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    flagged = holdout_flag(series, rows, keys)
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def date_spine(spans: DataFrame, first: Column, last: Column, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day from ``first`` to ``last`` for every row of ``spans``."""
    return spans.select(*keys, F.explode(F.sequence(first, last)).alias("ds"))


def future_spine(
    series: DataFrame, periods: int = 90, start: date | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """``periods`` consecutive days from ``start``, by default from the day after the last one."""
    last = series.groupBy(*keys).agg(F.max("ds").alias("last")).where("last IS NOT NULL")
    first = F.date_add("last", 1) if start is None else F.lit(start)
    return date_spine(last, first, F.date_add(first, periods - 1), keys)


def densify(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fill missing days with zero, so that k rows back means k days back."""
    spans = series.groupBy(*keys).agg(F.min("ds").alias("a"), F.max("ds").alias("b")).where("a IS NOT NULL")
    spine = date_spine(spans, F.col("a"), F.col("b"), keys)
    return spine.join(series, [*keys, "ds"], "left").withColumn("y", F.coalesce("y", F.lit(0)))


def profile(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return series.groupBy(*keys).agg(
        F.count("*").alias("days"), F.min("ds").alias("first_day"), F.max("ds").alias("last_day")
    )


def require_history(series: DataFrame, minimum: int = MINIMUM_HISTORY) -> None:
    found = profile(series).first()["days"]
    if found < minimum:
        raise ShortHistory(f"{found} days of history, at least {minimum} needed")


def actual_vs_forecast(actual: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(ds, y, yhat) on the days both sides have, matched by day rather than by position."""
    return actual.join(forecast.select(*keys, "ds", "yhat"), [*keys, "ds"])


def on_days_of(forecast: DataFrame, days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return forecast.join(days.select(*keys, "ds"), [*keys, "ds"], "left_semi")


def mae() -> Column:
    return F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae")


def rmse() -> Column:
    return F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), F.lit(2.0)))).alias("rmse")
