"""The user-facing queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.operators import ranking, series
from caseloom.operators.star import (
    Star,
    StarFilter,
    bernoulli_sample,
    filtered_fact,
    hash_sample,
    mapped_points,
    with_labels,
)


def kpis(star: Star, chosen: StarFilter) -> DataFrame:
    """One row: total, avg_age, top_area, top_weapon.

    The fact is read once and reduced to (area, weapon) counts before any label is joined; the total
    and both tops come out of one grouping-sets pass over that small table.
    """
    cells = (
        filtered_fact(star, chosen)
        .groupBy("area_id", "weapon_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("vict_age").alias("age_sum"),
            F.count("vict_age").alias("age_n"),
        )
    )
    sets = (
        with_labels(star, cells, ["area", "weapon"])
        .groupingSets(
            [[F.col("area_name")], [F.col("weapon_desc")], []], F.col("area_name"), F.col("weapon_desc")
        )
        .agg(
            F.sum("n").alias("n"),
            F.sum("age_sum").alias("age_sum"),
            F.sum("age_n").alias("age_n"),
            F.grouping_id().alias("gid"),
        )
    )
    # grouping_id: one bit per grouped-away column, the first column being the high bit.
    by_area, by_weapon, overall = F.col("gid") == 1, F.col("gid") == 2, F.col("gid") == 3

    def top(label: str, rows: Column) -> Column:
        order = F.struct(-F.col("n"), F.col(label).isNull(), F.col(label))
        return F.when(F.count("*") == 0, "-").otherwise(F.min_by(label, F.when(rows, order)))

    return sets.agg(
        F.coalesce(F.max(F.when(overall, F.col("n"))), F.lit(0)).alias("total"),
        F.max(F.when(overall, F.try_divide("age_sum", "age_n"))).alias("avg_age"),
        top("area_name", by_area).alias("top_area"),
        top("weapon_desc", by_weapon).alias("top_weapon"),
    )


def kpi_texts(row: DataFrame) -> DataFrame:
    """The key figures as display text."""
    return row.select(
        X.thousands(F.col("total")).alias("total_cases"),
        F.concat(X.whole_age(F.col("avg_age")).cast("string"), F.lit(" Yrs")).alias("avg_age"),
        F.col("top_area").alias("hotspot"),
        X.short_label(F.col("top_weapon")).alias("top_weapon"),
    )


def map_points(
    star: Star, chosen: StarFilter, percent: int = 10, seed: int | None = None, repeatable: bool = False
) -> DataFrame:
    """(lat, lon, area_name, crm_cd_desc) of a sample of the facts that pass the filter, taken before labels are joined.

    A row's luck does not depend on the filter, so sampling after it gives the same sample and lets the scan skip years.
    """
    points = mapped_points(filtered_fact(star, chosen))
    sampled = hash_sample(points, "dr_no", percent) if repeatable else bernoulli_sample(points, percent / 100, seed)
    return with_labels(star, sampled, ["area", "crime"]).select("lat", "lon", "area_name", "crm_cd_desc")


def trend(star: Star, chosen: StarFilter, window: int = 7) -> DataFrame:
    """(date_occ, n, ma): incidents per day and their trailing mean, in date order."""
    days = series.daily_counts(filtered_fact(star, chosen))
    return (
        days.withColumn("ma", series.moving_average(window))
        .select(F.col("ds").alias("date_occ"), F.col("y").alias("n"), "ma")
        .orderBy("date_occ")
    )


def preview(star: Star, chosen: StarFilter, n: int = 1000) -> DataFrame:
    """The newest n incidents with labels; n rows are picked first, only those meet the dimensions."""
    newest = ranking.newest_rows(filtered_fact(star, chosen), "date_occ", "dr_no", n)
    return (
        with_labels(star, newest, ["area", "crime", "weapon", "status"])
        .select("dr_no", "date_occ", "area_name", "crm_cd_desc", "weapon_desc", "status_desc")
        .orderBy(F.desc_nulls_last("date_occ"), "dr_no")
    )


def filter_options(star: Star) -> DataFrame:
    """(option, value): first and last day, then the sorted labels of each filter."""
    span = ranking.span(star.fact, "date_occ")
    days = span.select(
        F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day"),
    ).unpivot([], ["first_day", "last_day"], "option", "value")
    for option, dimension, label, keep_null in (
        ("area", star.area, "area_name", True),
        ("crime", star.crime, "crm_cd_desc", True),
        ("weapon", star.weapon, "weapon_desc", False),
        ("premise", star.premise, "premis_desc", False),
    ):
        labels = ranking.options(dimension, label, keep_null)
        days = days.unionByName(labels.select(F.lit(option).alias("option"), F.col(label).alias("value")))
    return days.orderBy("option", F.asc_nulls_last("value"))


def latest_metrics(metrics: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """The newest metrics of each model; with a registry, only of models that were published."""
    if registry is not None:
        metrics = metrics.join(registry.select("model_name", "created_at"), ["model_name", "created_at"], "left_semi")
    return ranking.latest_per_group(metrics, ["model_name"], "created_at")


def metrics_table(latest: DataFrame) -> DataFrame:
    """Display form of ``latest_metrics``."""
    return latest.select(
        "model_name",
        X.two_decimals(F.col("mae")).alias("mae"),
        X.two_decimals(F.col("rmse")).alias("rmse"),
        "training_rows",
        X.minute_text(F.col("created_at")).alias("created_at"),
    )


def champion(latest: DataFrame) -> DataFrame:
    """The model with the lowest error (mae, then rmse, then name); unscored models cannot win."""
    scored = latest.where("mae IS NOT NULL AND rmse IS NOT NULL")
    return scored.agg(F.min_by("model_name", F.struct("mae", "rmse", "model_name")).alias("champion"))
