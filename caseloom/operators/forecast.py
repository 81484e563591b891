"""Training, scoring and applying daily-count models."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.calendar import calendar_sql, cyclic_calendar_sql
from caseloom.operators import features as M
from caseloom.operators import series as S
from caseloom.operators.histogram_trees import Growth, TreeModel, boosted_nodes, forest_nodes
from caseloom.operators.trees import FlatEnsemble, flatten
from caseloom.session import ship_package, work_path
from caseloom.sources.lake import EmptyInput

LOWER_BAND, UPPER_BAND = 0.85, 1.15
HORIZON = 90


# ---------------------------------------------------------------- what to train
@dataclass(frozen=True)
class Forest:
    trees: int = 500
    depth: int = 10
    min_leaf: int = 4
    seed: int = 42

    def train(self, rows: DataFrame, features: Mapping[str, str]) -> TreeModel:
        """A forest for one series; ``rows`` hold the values of ``features`` and ``y``."""
        nodes = forest_nodes(rows, list(features), self.trees, Growth(self.depth, 0.0, self.min_leaf), self.seed)
        return TreeModel(rows.sparkSession, dict(features), nodes.toArrow().to_pandas(), np.ones(self.trees), float(self.trees))

    def estimator(self) -> RandomForestRegressor:
        """The same for the rows of many series together, which no task holds."""
        return RandomForestRegressor(
            numTrees=self.trees, maxDepth=self.depth, minInstancesPerNode=self.min_leaf, seed=self.seed,
            featuresCol="features", labelCol="y", predictionCol="yhat",
        )


@dataclass(frozen=True)
class Boosted:
    rounds: int = 1000
    rate: float = 0.01
    depth: int = 5
    subsample: float = 0.8
    seed: int = 42

    def train(self, rows: DataFrame, features: Mapping[str, str]) -> TreeModel:
        """Boosted trees for one series; ``rows`` hold the values of ``features`` and ``y``."""
        nodes = boosted_nodes(rows, list(features), self.rounds, self.rate, Growth(self.depth), self.subsample, self.seed)
        weights = np.array([1.0, *[self.rate] * self.rounds])
        return TreeModel(rows.sparkSession, dict(features), nodes.toArrow().to_pandas(), weights, 1.0)

    def estimator(self) -> GBTRegressor:
        """The same for the rows of many series together, which no task holds; here a round is a Spark job."""
        return GBTRegressor(
            maxIter=self.rounds, stepSize=self.rate, maxDepth=self.depth, subsamplingRate=self.subsample,
            seed=self.seed, featuresCol="features", labelCol="y", predictionCol="yhat",
        )


@dataclass(frozen=True)
class Additive:
    """Piecewise linear trend plus yearly and weekly Fourier terms, fitted as a ridge regression."""

    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly: int = 10
    weekly: int = 3
    penalty: float = 0.01

    def estimator(self) -> LinearRegression:
        return LinearRegression(
            regParam=self.penalty, elasticNetParam=0.0, featuresCol="features", labelCol="y", predictionCol="yhat"
        )

    def terms(self, first: date, last: date) -> dict[str, str]:
        t = f"(datediff(ds, DATE'{first}') / {max((last - first).days, 1)}D)"
        columns = {"trend": t}
        for i in range(1, self.changepoints + 1):
            bend = self.changepoint_range * i / (self.changepoints + 1)
            columns[f"bend_{i}"] = f"greatest(0D, {t} - {bend}D)"
        day = "datediff(ds, DATE'1970-01-01')"
        for name, period, order in (("yearly", 365.25, self.yearly), ("weekly", 7.0, self.weekly)):
            for k in range(1, order + 1):
                angle = f"2 * pi() * {k} * {day} / {period}D"
                columns[f"{name}_sin_{k}"] = f"sin({angle})"
                columns[f"{name}_cos_{k}"] = f"cos({angle})"
        return columns


Recipe = Forest | Boosted | Additive


def _pipeline(recipe: Additive, series: DataFrame) -> Pipeline:
    """Features and estimator in one saved unit: the fitted model needs nothing but ``ds``."""
    span = S.profile(series).first()
    columns = recipe.terms(span["first_day"], span["last_day"])
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__"),
            VectorAssembler(inputCols=list(columns), outputCol="features"),
            recipe.estimator(),
        ]
    )


Model = PipelineModel | TreeModel


def _training_rows(series: DataFrame, features: Mapping[str, str]) -> DataFrame:
    return series.select(*[F.expr(sql).cast("double").alias(name) for name, sql in features.items()], F.col("y").cast("double").alias("y"))


def fit(series: DataFrame, recipe: Recipe) -> Model:
    """A model of one series, which is bounded by the calendar: the additive one is solved over a single partition, and trees grow
    in tasks that hold the series, so how the rows were partitioned changes no fitted value."""
    if isinstance(recipe, Additive):
        return _pipeline(recipe, series).fit(series.coalesce(1))
    features = calendar_sql("ds")
    return recipe.train(_training_rows(series, features), features)


def predict(model: Model, days: DataFrame) -> DataFrame:
    """``days`` plus ``yhat``; the same call for every kind of model."""
    return model.transform(days).select(*days.columns, "yhat")


def save_model(model: Model, path: str) -> None:
    if isinstance(model, TreeModel):
        model.save(path)
    else:
        model.write().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    return TreeModel.load(spark, path) if TreeModel.saved_at(spark, path) else PipelineModel.load(path)


# ---------------------------------------------------------------- scoring
@dataclass(frozen=True)
class Trained:
    """A fitted model, its errors on the holdout days and the forecasts (ds, y, yhat) they were computed from."""

    model: Model
    mae: float | None
    rmse: float | None
    training_rows: int
    holdout: tuple[tuple[date, int, float], ...] = ()


def error_measures(compared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return compared.groupBy(*keys).agg(S.mae(), S.rmse())


def train_and_evaluate(
    series: DataFrame,
    recipe: Recipe,
    cutoff: date | None = None,
    holdout: int = S.HOLDOUT_ROWS,
    minimum: int | None = None,
) -> Trained:
    """Score on the last ``holdout`` rows, then refit on everything up to the cutoff."""
    known = (series if cutoff is None else S.until(series, cutoff)).persist()
    try:
        rows = known.count()
        if rows == 0:
            raise EmptyInput("no days to train on")
        if minimum is not None:
            S.require_history(known, minimum)
        train, test = S.holdout_split(known, holdout)
        scored = predict(fit(train, recipe), test.select("ds"))
        compared = S.actual_vs_forecast(test, scored).select("ds", "y", "yhat").orderBy("ds").persist()
        try:
            errors = error_measures(compared).first()
            kept = tuple((r["ds"], r["y"], r["yhat"]) for r in compared.collect())  # at most ``holdout`` rows
        finally:
            compared.unpersist()
        return Trained(fit(known, recipe), errors["mae"], errors["rmse"], rows, kept)
    finally:
        known.unpersist()


def retrain(series: DataFrame, recipe: Recipe, as_of: date) -> Trained:
    """Daily refit on everything before ``as_of``; not scored, so its error measures stay NULL."""
    known = S.until_day_before(series, as_of).persist()
    try:
        rows = known.count()
        if rows == 0:
            raise EmptyInput("no days to train on")
        return Trained(fit(known, recipe), None, None, rows)
    finally:
        known.unpersist()


# ---------------------------------------------------------------- direct forecast
def with_band(forecast: DataFrame) -> DataFrame:
    return forecast.withColumns(
        {"yhat_lower": F.col("yhat") * LOWER_BAND, "yhat_upper": F.col("yhat") * UPPER_BAND}
    )


def direct_forecast(model: PipelineModel, series: DataFrame, periods: int = HORIZON, start: date | None = None) -> DataFrame:
    return predict(model, S.future_spine(series, periods, start))


# ---------------------------------------------------------------- recursive forecast
def fit_on_lags(series: DataFrame, recipe: Forest | Boosted, keys: Sequence[str] = ()):
    """Tree ensemble on the lag feature set, incomplete first rows dropped.  With ``keys``, one for all series together."""
    rows = M.complete_rows(M.lag_features(series, keys))
    if not keys:
        features = {name: f"`{name}`" for name in M.LAG_FEATURES}
        return recipe.train(_training_rows(rows, features), features)
    assembler = VectorAssembler(inputCols=list(M.LAG_FEATURES), outputCol="features")
    # Training passes over its input several times; the windows should run once.
    inputs = assembler.transform(rows).select("features", "y").persist()
    try:
        return recipe.estimator().fit(inputs)
    finally:
        inputs.unpersist()


def roll_forward(ensemble: FlatEnsemble, history: np.ndarray, calendar: np.ndarray) -> np.ndarray:
    """One-step predictions fed back as history, for many series at once.

    ``history`` is (series x last values, oldest first), ``calendar`` (series x days x features);
    the result is (series x days).
    """
    width = history.shape[1]
    days = calendar.shape[1]
    values = np.concatenate([history, np.empty((len(history), days))], axis=1)
    for step in range(days):
        past = values[:, : width + step]
        lagged = [past[:, -k] for k in M.LAGS]
        rolled = [f(past[:, -w:]) for w in M.WINDOWS for f in (_mean, _deviation)]
        row = np.column_stack([calendar[:, step, :], *lagged, *rolled])
        values[:, width + step] = ensemble.predict(row)
    return values[:, width:]


def _mean(window: np.ndarray) -> np.ndarray:
    return window.mean(axis=1)


def _deviation(window: np.ndarray) -> np.ndarray:
    return window.std(axis=1, ddof=1)


def recursive_forecast(
    series: DataFrame, model, periods: int = HORIZON, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys..., ds, yhat) for ``periods`` days after the end of each series.

    Spark reduces each series to one row: its last values and the calendar features of the days to
    come.  Those rows are spread over tasks that only evaluate the (size-bounded) ensemble.  A
    series shorter than the longest lag has no complete features and gets NULL forecasts.
    """
    spark = series.sparkSession
    ship_package(spark)
    depth = max(*M.LAGS, *M.WINDOWS)
    trees = model.ensemble if isinstance(model, TreeModel) else flatten(spark, model, work_path(spark, "ensemble"))
    ensemble = spark.sparkContext.broadcast(trees)

    newest = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    tail = series.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= depth)
    states = (
        tail.groupBy(*keys)
        .agg(
            F.max("ds").alias("last"),
            F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("rows"),
        )
        .where("last IS NOT NULL")
    )
    days = F.sequence(F.date_add("last", 1), F.date_add("last", periods))
    per_day = ", ".join(f"double({sql})" for sql in cyclic_calendar_sql("d").values())
    states = states.withColumn("days", days).select(
        *keys,
        "last",
        F.col("rows.y").alias("history"),
        F.expr(f"flatten(transform(days, d -> array({per_day})))").alias("calendar"),
    )

    n_calendar = len(cyclic_calendar_sql("d"))

    def forecast(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[*keys, "last"]].copy()
            full = batch["history"].map(len).to_numpy() == depth
            result: list[list[float] | None] = [None] * len(batch)
            if full.any():
                chosen = batch[full]
                calendar = np.stack(chosen["calendar"].to_numpy()).reshape(-1, periods, n_calendar)
                rolled = roll_forward(ensemble.value, np.stack(chosen["history"].to_numpy()), calendar)
                for position, row in zip(np.flatnonzero(full), rolled):
                    result[position] = row.tolist()
            out["yhats"] = pd.Series(result, index=out.index, dtype=object)
            yield out

    key_fields = [states.schema[k] for k in keys]
    schema = T.StructType(
        [*key_fields, T.StructField("last", T.DateType()), T.StructField("yhats", T.ArrayType(T.DoubleType()))]
    )
    rolled = states.mapInPandas(forecast, schema)
    steps = F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step")
    return rolled.select(*keys, "last", "yhats", steps).select(
        *keys, F.date_add("last", F.col("step")).alias("ds"), F.expr("yhats[step - 1]").alias("yhat")
    )


# The settings of the comparison, which has its own.
COMPARED: dict[str, Recipe] = {"boosted": Boosted(rate=0.02, subsample=1.0), "forest": Forest(min_leaf=1)}


def compare_models(
    series: DataFrame,
    recipes: Mapping[str, Forest | Boosted] = COMPARED,
    cutoff: date | None = None,
    holdout: int = S.HOLDOUT_ROWS,
) -> DataFrame:
    """(model, mae, rmse): every recipe fitted on lag features and rolled over the holdout days.

    Forecasts are matched with actuals by day, so a gap in the series does not shift them.
    """
    known = series if cutoff is None else S.until(series, cutoff)
    train, test = S.holdout_split(known, holdout)
    train = train.persist()
    try:
        periods = (S.profile(test).first()["last_day"] - S.profile(train).first()["last_day"]).days
        forecasts = None
        for name, recipe in recipes.items():
            rolled = recursive_forecast(train, fit_on_lags(train, recipe), periods)
            rolled = rolled.withColumn("model", F.lit(name))
            forecasts = rolled if forecasts is None else forecasts.unionByName(rolled)
        compared = test.join(forecasts, "ds")
        return error_measures(compared, ["model"])
    finally:
        train.unpersist()
