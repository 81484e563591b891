"""Strict cleaning for research extracts, and spatial clusters on what remains."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.sources import headers as H

CUTOFF = date(2023, 12, 31)
KNOWN_SEXES = ("M", "F", "X")
OLDEST_AGE = 80.0
CLUSTERS, SEED = 100, 42
REQUIRED = ("dr_no", "date_occ", "time_occ", "lat", "lon", "vict_age")


# ---------------------------------------------------------------- rules
def until_cutoff(rows: DataFrame, cutoff: date) -> DataFrame:
    """Timestamps up to midnight of the cutoff day; later times of that day and NULLs are dropped."""
    return rows.where(F.col("date_occ") <= F.lit(cutoff).cast("timestamp"))


def off_zero_coordinates(rows: DataFrame) -> DataFrame:
    """Missing coordinates count as zero; a zero in either one drops the row."""
    filled = rows.withColumns({c: X.fill_default(F.col(c), 0.0) for c in ("lat", "lon")})
    return filled.where(X.off_null_island(F.col("lat"), F.col("lon")))


def with_positive_age(rows: DataFrame) -> DataFrame:
    return rows.where("vict_age > 0")


def with_known_sex(rows: DataFrame) -> DataFrame:
    """Rows of a known sex; extracts without that column pass unchanged."""
    return rows.where(F.col("vict_sex").isin(*KNOWN_SEXES)) if "vict_sex" in rows.columns else rows


def clean(extract: DataFrame, cutoff: date = CUTOFF) -> DataFrame:
    """Mapped, typed and filtered research rows with ``hour``, without clusters."""
    rows = H.map_columns(extract, H.RESEARCH_COLUMNS, H.snake_header, keep_unmapped=True)
    rows = H.ensure_columns(rows, REQUIRED)
    typed = rows.withColumns(
        {
            "date_occ": X.to_timestamp_or_null(F.col("date_occ").cast("string")),
            "lat": X.fill_default(X.double_of(rows, "lat"), 0.0),
            "lon": X.fill_default(X.double_of(rows, "lon"), 0.0),
            "vict_age": X.fill_default(X.double_of(rows, "vict_age"), -1.0),
        }
    )
    kept = with_known_sex(with_positive_age(off_zero_coordinates(until_cutoff(typed, cutoff))))
    return kept.withColumns(
        {"vict_age": X.cap(F.col("vict_age"), OLDEST_AGE), "hour": X.padded_hour(F.col("time_occ"))}
    )


# ---------------------------------------------------------------- clusters
def fit_clusters(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED, iterations: int = 20) -> PipelineModel:
    """k-means over (lat, lon).

    Equal coordinates are folded into one weighted point first, which leaves the objective unchanged
    while every iteration passes over distinct places instead of all incidents.
    """
    places = rows.groupBy("lat", "lon").agg(F.count("*").cast("double").alias("weight")).persist()
    try:
        kmeans = KMeans(
            k=max(2, min(k, places.count())), seed=seed, maxIter=iterations, weightCol="weight",
            featuresCol="place", predictionCol="crime_cluster",
        )
        assembler = VectorAssembler(inputCols=["lat", "lon"], outputCol="place")
        return Pipeline(stages=[assembler, kmeans]).fit(places)
    finally:
        places.unpersist()


def with_clusters(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``crime_cluster``; a map over the rows."""
    return model.transform(rows).drop("place")


def cluster_centres(model: PipelineModel) -> list[tuple[float, float]]:
    return [tuple(map(float, c)) for c in model.stages[-1].clusterCenters()]
