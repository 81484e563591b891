"""The end-to-end jobs, as plain functions over a session, paths and explicit times."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.operators import forecast as M
from caseloom.operators import quality
from caseloom.operators import series as S
from caseloom.plans import research, snapshot
from caseloom.plans.warehouse import merge_staging
from caseloom.schemas import STAGING, STAGING_COLUMNS, TABLES
from caseloom.sources import headers as H
from caseloom.sources import lake
from caseloom.sources.registry import ModelRegistry
from caseloom.sources.store import Commit, Store

# The names under which models are published and looked up.
CHAMPION = "xgboost_crime_v1"
ADDITIVE = "prophet_crime_v1"
STANDARDISED_CODES = ("area_id", "crm_cd", "premis_id", "weapon_id")

# Published variants, name -> (recipe, uses the cutoff).
VARIANTS: dict[str, tuple[M.Recipe, bool]] = {
    "rf_safe_2023": (M.Forest(), True),
    "rf_full_latest": (M.Forest(), False),
    "xgboost_full_latest": (M.Boosted(), False),
}
RESEARCH_VARIANTS: dict[str, M.Recipe] = {"thesis_xgboost": M.Boosted(), "thesis_rf": M.Forest()}


# ---------------------------------------------------------------- loading
def daily_staging(extract: DataFrame) -> DataFrame:
    """Daily extract to the staging layout: mapped columns, dates parsed, codes standardised."""
    lake.require_rows(extract, "extract")
    rows = H.map_columns(extract, H.DAILY_COLUMNS, H.basic_header)
    changed = {}
    if "date_occ" in rows.columns:
        changed["date_occ"] = X.to_timestamp_or_null(F.col("date_occ").cast("string")).cast("string")
    for c in STANDARDISED_CODES:
        if c in rows.columns:
            changed[c] = X.standard_code(F.col(c).cast("string"))
    for c in ("vict_age", "lat", "lon"):
        if c in rows.columns:
            changed[c] = X.double_of(rows, c)
    return H.conform(rows.withColumns(changed), STAGING)


def historical_staging(extract: DataFrame) -> DataFrame:
    """Historical extract to the staging layout: all text but three numbers."""
    rows = H.map_columns(extract, H.historical_columns(STAGING_COLUMNS), H.alphanumeric_header)
    numbers = {c: X.double_of(rows, c) for c in ("vict_age", "lat", "lon") if c in rows.columns}
    return H.conform(rows.withColumns(numbers), STAGING)


def daily_load(spark: SparkSession, lake_path: str, staging_path: str, store: Store) -> Commit:
    """Newest lake object -> staging -> star schema."""
    newest = lake.latest_object(spark, lake_path)
    if newest is None:
        raise lake.EmptyInput(f"{lake_path} is empty")
    version = lake.content_version(spark, newest)  # before reading: a file that changes meanwhile is loaded again
    staging = lake.replace_table(daily_staging(lake.read_lake(spark, newest)), staging_path)
    return merge_staging(store, staging, batch=version)


@dataclass(frozen=True)
class HistoricalResult:
    commit: Commit
    report: DataFrame


def historical_load(
    spark: SparkSession, csv_path: str, staging_path: str, store: Store, lexical: bool = False
) -> HistoricalResult:
    """Bulk CSV -> staging -> checks -> star schema.  Violations are reported, never blocking."""
    version = lake.content_version(spark, csv_path)
    lake.replace_table(historical_staging(lake.read_csv(spark, csv_path)), staging_path)
    staging = quality.require_staging(spark, staging_path)
    found = quality.quality_report(staging, lexical)
    report = spark.createDataFrame(found.collect(), found.schema)  # three rows; the next load overwrites staging
    return HistoricalResult(merge_staging(store, staging, batch=version), report)


def research_load(
    spark: SparkSession,
    lake_path: str,
    target: str,
    preferred: str,
    cutoff: date = research.CUTOFF,
    clusters: int = research.CLUSTERS,
) -> DataFrame:
    """Preferred (else newest) lake object -> strict rules -> clusters -> research table.  What is not called JSON is CSV."""
    extract = lake.read_lake(spark, lake.preferred_object(spark, lake_path, preferred), otherwise="csv")
    rows = lake.require_rows(research.clean(extract, cutoff), "research table after cleaning")
    # Written before clustering: k-means passes over the data many times.
    cleaned = lake.replace_table(rows, f"{target.rstrip('/')}_unclustered")
    model = research.fit_clusters(cleaned, clusters)
    return lake.replace_table(research.with_clusters(cleaned, model), target)


# ---------------------------------------------------------------- training
def fact_series(store: Store) -> DataFrame:
    return S.daily_counts(store.table("fact_crime"))


def train_champion(
    series: DataFrame, models: ModelRegistry, at: datetime, cutoff: date = research.CUTOFF,
    recipe: M.Recipe = M.Boosted(),
) -> M.Trained:
    trained = M.train_and_evaluate(series, recipe, cutoff)
    models.publish(CHAMPION, trained, at)
    return trained


def train_additive(
    series: DataFrame, models: ModelRegistry, at: datetime, cutoff: date = research.CUTOFF,
    recipe: M.Additive = M.Additive(),
) -> M.Trained:
    """At least 100 days of history are required."""
    trained = M.train_and_evaluate(series, recipe, cutoff, minimum=S.MINIMUM_HISTORY)
    models.publish(ADDITIVE, trained, at)
    return trained


def train_variants(
    series: DataFrame, models: ModelRegistry, at: datetime, only: str = "all", cutoff: date = research.CUTOFF,
    variants: Mapping[str, tuple[M.Recipe, bool]] = VARIANTS,
) -> dict[str, M.Trained]:
    trained = {}
    for name, (recipe, cut) in variants.items():
        if only in ("all", name):
            trained[name] = M.train_and_evaluate(series, recipe, cutoff if cut else None)
            models.publish(name, trained[name], at)
    return trained


def daily_retrain(
    series: DataFrame, models: ModelRegistry, as_of: date, at: datetime, recipe: M.Recipe = M.Boosted()
) -> M.Trained:
    trained = M.retrain(series, recipe, as_of)
    models.publish(CHAMPION, trained, at)
    return trained


def end_to_end(
    spark: SparkSession, lake_path: str, staging_path: str, store: Store, models: ModelRegistry, as_of: date,
    at: datetime, recipe: M.Recipe = M.Boosted(),
) -> tuple[Commit, M.Trained]:
    commit = daily_load(spark, lake_path, staging_path, store)
    return commit, daily_retrain(fact_series(store), models, as_of, at, recipe)


def weekly_training(
    series: DataFrame, models: ModelRegistry, at: datetime, cutoff: date = research.CUTOFF,
    champion: M.Recipe = M.Boosted(), variants: Mapping[str, tuple[M.Recipe, bool]] = VARIANTS,
) -> DataFrame:
    """Champion, then the variants; returns the metrics table."""
    train_champion(series, models, at, cutoff, champion)
    train_variants(series, models, at, "all", cutoff, variants)
    return models.metrics()


def research_training(
    research_rows: DataFrame, models: ModelRegistry, at: datetime,
    variants: Mapping[str, M.Recipe] = RESEARCH_VARIANTS,
) -> DataFrame:
    """Both tree models on the research table's daily counts; returns the metrics table."""
    days = research_rows.withColumn("date_occ", F.to_date("date_occ"))
    for name, recipe in variants.items():
        models.publish(name, M.train_and_evaluate(S.daily_counts(days), recipe), at)
    return models.metrics()


# ---------------------------------------------------------------- serving
def forecast_for(
    models: ModelRegistry, name: str, as_of: date, periods: int = M.HORIZON
) -> DataFrame:
    """(ds, yhat, yhat_lower, yhat_upper) from ``as_of`` on; empty when the model is unknown."""
    model = models.load_latest(name)
    spine = S.date_spine(
        models.latest_row(name), F.lit(as_of), F.date_add(F.lit(as_of), periods - 1)
    )
    if model is None:
        return M.with_band(spine.withColumn("yhat", F.lit(None).cast("double")))
    return M.with_band(M.predict(model, spine))


MODEL_TABLES = ("registry", "metrics", "holdout")


def snapshot_store(store: Store, models: ModelRegistry, destination: str, at: datetime) -> str:
    """Star schema, model tables and the fitted models as one verified snapshot.  Registered paths are kept below the models' folder."""
    tables = {name: store.table(name) for name in TABLES}
    below = F.substring_index(F.col("path"), f"{models.root}/", -1)
    tables |= {
        "model_registry": models.registry().withColumn("path", below), "model_metrics": models.metrics(), "model_holdout": models.holdout()
    }
    folder = snapshot.snapshot(store.spark, tables, destination, at)
    snapshot.snapshot_files(store.spark, f"{models.root}/models", destination, folder)
    return folder


def restore_store(spark: SparkSession, folder: str, target: str) -> tuple[Store, ModelRegistry]:
    """A store and a model registry below ``target`` holding what the snapshot holds, all verified first.

    The tables become visible by one commit and the models by their registry rows, which come last, so a restore that
    dies leaves neither; ``target`` must not hold a store yet."""
    store, models = Store(spark, f"{target}/warehouse"), ModelRegistry(spark, f"{target}/registry")
    if store.commits() or models.names():
        raise ValueError(f"{target} is in use")
    tables = snapshot.verify(spark, folder)
    number, load = store.new_load()
    rows = {name: store.write(name, load, tables[name].select(*TABLES[name].names)) for name in TABLES}
    snapshot.restore_files(spark, folder, folder.rsplit("/", 1)[0], f"{models.root}/models")
    here = F.concat(F.lit(f"{models.root}/"), F.col("path"))
    for name in reversed(MODEL_TABLES):
        df = tables[f"model_{name}"]
        df = df.withColumn("path", here) if name == "registry" else df
        df.write.mode("overwrite").parquet(f"{models.root}/{name}")
    store.commit(number, load, rows, batch=f"snapshot {folder}")
    return store, models
