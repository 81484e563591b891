from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from caseloom.operators import features as M
from caseloom.operators import forecast as P
from caseloom.operators import series as S
from caseloom.operators.trees import flatten
from caseloom.plans import dashboard, flows, research
from caseloom.sources.lake import EmptyInput
from caseloom.sources.registry import ModelRegistry

DAY = date(2022, 1, 1)
FOREST, BOOSTED = P.Forest(trees=5, depth=4), P.Boosted(rounds=4, depth=3)


@pytest.fixture(scope="module")
def wave(spark):
    rows = [(DAY + timedelta(i), 50 + round(20 * math.sin(i / 7) + i % 5)) for i in range(260)]
    return spark.createDataFrame(rows, "ds date, y bigint").coalesce(1).persist()


@pytest.mark.parametrize("recipe", [FOREST, BOOSTED], ids=["forest", "boosted"])
def test_flat_ensemble_equals_the_model(spark, wave, tmp_path, recipe):
    rows = M.complete_rows(M.lag_features(wave))
    assembled = VectorAssembler(inputCols=list(M.LAG_FEATURES), outputCol="features").transform(rows)
    model = recipe.estimator().fit(assembled)
    flat = flatten(spark, model, str(tmp_path / "m"))
    scored = model.transform(VectorAssembler(inputCols=list(M.LAG_FEATURES), outputCol="features").transform(rows))
    got = scored.select(*M.LAG_FEATURES, "yhat").toPandas()
    want = flat.predict(got[list(M.LAG_FEATURES)].to_numpy(float), chunk=50)
    np.testing.assert_allclose(got["yhat"], want, rtol=1e-12)


def test_recursive_forecast_by_hand(spark, wave):
    """Each step again with Spark's own features and model, feeding predictions back."""
    model = P.fit_on_lags(wave, FOREST)
    rolled = [r["yhat"] for r in P.recursive_forecast(wave, model, 4).orderBy("ds").collect()]
    history = [(r["ds"], float(r["y"])) for r in wave.orderBy("ds").collect()]
    for step in range(4):
        day = history[-1][0] + timedelta(1)
        frame = spark.createDataFrame([*history, (day, 0.0)], "ds date, y double")
        row = M.lag_features(frame).where(f"ds = DATE'{day}'")
        value = model.transform(row).first()["yhat"]
        assert value == pytest.approx(rolled[step], rel=1e-9)
        history.append((day, value))


def test_constant_series_stays_constant_for_every_key(spark):
    rows = spark.sql(
        "select k, date_add(date'2022-01-01', i) as ds, bigint(7) as y from (select explode(array('a','b')) as k), "
        "(select explode(sequence(0, 99)) as i)")
    out = P.recursive_forecast(rows, P.fit_on_lags(rows, FOREST, ["k"]), 30, ["k"])
    got = out.collect()
    assert len(got) == 60 and {r["yhat"] for r in got} == {7.0}
    assert min(r["ds"] for r in got) == DAY + timedelta(100)


def test_short_series_get_null_forecasts(spark, wave):
    short = wave.where("ds < DATE'2022-01-11'")
    out = P.recursive_forecast(short, P.fit_on_lags(wave, FOREST), 3).collect()
    assert [r["yhat"] for r in out] == [None] * 3


@pytest.mark.parametrize("recipe", [FOREST, BOOSTED, P.Additive()], ids=["forest", "boosted", "additive"])
def test_train_evaluate_publish_and_serve(spark, wave, tmp_path, recipe):
    models = ModelRegistry(spark, str(tmp_path))
    done = P.train_and_evaluate(wave, recipe, cutoff=date(2022, 9, 1))
    assert done.training_rows == 244 and 0 < done.mae <= done.rmse
    models.publish("m", done, datetime(2024, 1, 1))
    out = flows.forecast_for(models, "m", date(2023, 1, 1), 5).orderBy("ds").collect()
    assert [r["ds"] for r in out] == [date(2023, 1, 1) + timedelta(i) for i in range(5)]
    assert out[0]["yhat_lower"] == pytest.approx(out[0]["yhat"] * 0.85)
    assert out[0]["yhat_upper"] == pytest.approx(out[0]["yhat"] * 1.15)


def test_additive_model_follows_a_trend(spark):
    rows = [(DAY + timedelta(i), 100 + i) for i in range(400)]
    series = spark.createDataFrame(rows, "ds date, y bigint").coalesce(1)
    done = P.train_and_evaluate(series, P.Additive(changepoints=0, yearly=0), minimum=100)
    assert done.mae < 2


def test_guards(wave):
    with pytest.raises(EmptyInput):
        P.train_and_evaluate(wave, FOREST, cutoff=date(2000, 1, 1))
    with pytest.raises(S.ShortHistory):
        P.train_and_evaluate(wave, FOREST, cutoff=date(2022, 2, 1), minimum=100)


def test_registry_serves_the_newest_and_metrics_follow(spark, wave, tmp_path):
    models = ModelRegistry(spark, str(tmp_path))
    assert models.names() == [] and models.load_latest("x") is None
    assert flows.forecast_for(models, "x", DAY).isEmpty()
    first = P.train_and_evaluate(wave, FOREST)
    models.publish("forest", first, datetime(2024, 1, 1))
    newest = models.publish("forest", first, datetime(2024, 1, 2))
    flows.daily_retrain(wave, models, date(2022, 6, 1), datetime(2024, 1, 3), BOOSTED)
    assert models.names() == ["forest", flows.CHAMPION]
    again = models.holdout().groupBy("created_at").agg(S.mae(), S.rmse()).collect()
    assert len(again) == 2 and all((r["mae"], r["rmse"]) == pytest.approx((first.mae, first.rmse)) for r in again)
    assert models.latest_row("forest").first()["path"] == newest
    latest = dashboard.latest_metrics(models.metrics(), models.registry())
    rows = {r["model_name"]: r for r in latest.collect()}
    assert rows["forest"]["created_at"] == datetime(2024, 1, 2)
    # An unscored retrain has no error and cannot be the champion.
    assert rows[flows.CHAMPION]["mae"] is None and rows[flows.CHAMPION]["training_rows"] == 151
    assert dashboard.champion(latest).first()[0] == "forest"


def test_variants(spark, wave, tmp_path):
    models = ModelRegistry(spark, str(tmp_path))
    small = {n: (FOREST, cut) for n, (_, cut) in flows.VARIANTS.items()}
    only = flows.train_variants(wave, models, datetime(2024, 1, 1), "rf_full_latest", variants=small)
    assert list(only) == ["rf_full_latest"]
    every = flows.train_variants(wave, models, datetime(2024, 1, 2), cutoff=date(2022, 8, 1), variants=small)
    assert list(every) == list(flows.VARIANTS)
    assert every["rf_safe_2023"].training_rows == 213 and every["rf_full_latest"].training_rows == 260


def test_compare_matches_by_day_despite_gaps(spark, wave):
    gappy = wave.where("ds NOT IN (DATE'2022-08-01', DATE'2022-08-02')")
    rows = P.compare_models(gappy, {"forest": FOREST, "boosted": BOOSTED}).collect()
    assert sorted(r["model"] for r in rows) == ["boosted", "forest"]
    assert all(0 < r["mae"] <= r["rmse"] for r in rows)


def test_clusters_give_the_nearest_centre(spark):
    points = spark.range(900).selectExpr(
        "34 + (id % 3) + (id % 10) / 100.0D as lat", "-118 - (id % 3) + (id % 7) / 100.0D as lon")
    model = research.fit_clusters(points, k=3)
    centres = research.cluster_centres(model)
    for r in research.with_clusters(points, model).collect():
        gaps = [(r["lat"] - a) ** 2 + (r["lon"] - b) ** 2 for a, b in centres]
        assert gaps[r["crime_cluster"]] == min(gaps)


def test_more_clusters_than_places(spark):
    points = spark.sql("select * from values (1D, 1D), (1D, 1D), (9D, 9D) as t(lat, lon)")
    labels = research.with_clusters(points, research.fit_clusters(points, k=100)).collect()
    assert {r["crime_cluster"] for r in labels} <= {0, 1}
