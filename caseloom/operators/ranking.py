"""Counts, tops, latest rows and option lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_counts(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def top_label(counts: DataFrame, label: str) -> DataFrame:
    """One row, one column: the label with the largest ``n`` (ties: first by name, NULL last).

    '-' stands for "no rows at all"; the label of a winning NULL group stays NULL.
    """
    best = F.min_by(label, F.struct(-F.col("n"), F.col(label).isNull(), F.col(label)))
    return counts.agg(F.when(F.count("*") == 0, "-").otherwise(best).alias(label))


def latest_per_group(rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of each group; rows without a time are older than all others.

    An aggregate rather than a window: every task keeps one candidate per group before the shuffle.
    """
    rest = [c for c in rows.columns if c not in (*keys, order, *ties)]
    newest = F.max(F.struct(order, *ties, *rest)).alias("newest")
    found = rows.groupBy(*keys).agg(newest)  # NULL is the smallest value of a struct's field
    return found.select(*[F.col(c) if c in keys else F.col(f"newest.{c}") for c in rows.columns])


def newest_rows(rows: DataFrame, day: str, tie: str, n: int) -> DataFrame:
    """Top n by day, newest first: every task keeps n rows, nothing is sorted globally."""
    return rows.orderBy(F.desc_nulls_last(day), F.asc(tie)).limit(n)


def options(dimension: DataFrame, label: str, keep_null: bool = True) -> DataFrame:
    """Sorted distinct labels."""
    rows = dimension.select(label)
    rows = rows if keep_null else rows.where(F.col(label).isNotNull())
    return rows.distinct().orderBy(F.asc_nulls_last(label))


def span(rows: DataFrame, day: str) -> DataFrame:
    return rows.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def metric_rows(metrics: DataFrame, names: Sequence[str] = ("mae", "rmse")) -> DataFrame:
    """Long form for charts: (model_name, created_at, metric, error_value)."""
    return metrics.unpivot(["model_name", "created_at"], list(names), "metric", "error_value")


