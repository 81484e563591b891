"""Daily series: counts, windows, spines, features, error measures, models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators import features as M
from caseloom.operators import forecast
from caseloom.operators import series as S
from caseloom.plans import flows, research
from caseloom.session import work_path
from caseloom.sources.registry import ModelRegistry
from caseloom.workload import fixture as fx
from caseloom.workload import stores
from caseloom.workload.registry import query

AT = datetime(2024, 1, 31, 6, 0)
FOREST, BOOSTED = forecast.Forest(), forecast.Boosted()


def days_sql(body: str, **extra: str) -> str:
    """``body`` over ``days(ds, y)``."""
    return fx.with_fact(body, days=fx.DAYS, **extra)


def area_days_sql(body: str) -> str:
    return fx.with_fact(body, days=(
        "select area_id, date_occ as ds, count(*) as y from fact where date_occ is not null group by 1, 2"))


def _days(spark, sf_dir, keys=()):
    return S.daily_counts(stores.fact(spark, sf_dir), keys=keys)


# ---------------------------------------------------------------- counts and order
@query("a3_daily_counts", days_sql("select * from days"))
def _daily_counts(spark, sf_dir):
    return _days(spark, sf_dir)


@query("a3_daily_counts_by_area", area_days_sql("select * from days"))
def _daily_counts_by_area(spark, sf_dir):
    return _days(spark, sf_dir, ["area_id"])


@query("a4_daily_counts_research", fx.with_raw(
    f"select ds, count(*) as y from (select {fx.date_sql('date_occ')} as ds, * from raw) where "
    f"ds <= date '{fx.CUTOFF}' and lat <> 0 and lon <> 0 and vict_age > 0 and vict_sex in ('M', 'F', 'X') group by ds"))
def _daily_counts_research(spark, sf_dir):
    rows = research.clean(fx.raw(spark, sf_dir, ("dr_no", "date_occ", "time_occ", "lat", "lon", "vict_age", "vict_sex")),
                          fx.CUTOFF)
    return S.daily_counts(rows.withColumn("date_occ", F.to_date("date_occ")))


@query("a13_series_profile", days_sql(
    "select count(*) as days, min(ds) as first_day, max(ds) as last_day from days"))
def _profile(spark, sf_dir):
    return S.profile(_days(spark, sf_dir))


@query("o5_chronological", days_sql("select * from days order by ds"))
def _chronological(spark, sf_dir):
    return _days(spark, sf_dir).orderBy("ds")


# ---------------------------------------------------------------- windows
def _over(keys: str = "") -> str:
    return f"({'partition by ' + keys if keys else ''} order by ds"


@query("w1_lags", days_sql("select ds, " + ", ".join(f"lag(y, {k}) over (order by ds) as lag_{k}" for k in M.LAGS)
                           + " from days"))
def _lags(spark, sf_dir):
    return _days(spark, sf_dir).select("ds", *[S.lag_column(k).alias(f"lag_{k}") for k in M.LAGS])


def _past_sql(measure: str, w: int, keys: str = "") -> str:
    frame = f"{_over(keys)} rows between {w} preceding and 1 preceding)"
    return f"case when count(y) over {frame} = {w} then {measure}(y) over {frame} end"


@query("w2_rolling_mean", days_sql(
    f"select ds, {_past_sql('avg', 7)} as mean_7, {_past_sql('avg', 30)} as mean_30 from days"))
def _rolling_mean(spark, sf_dir):
    return _days(spark, sf_dir).select("ds", S.past_mean(7).alias("mean_7"), S.past_mean(30).alias("mean_30"))


@query("w3_rolling_std", days_sql(
    f"select ds, round({_past_sql('stddev_samp', 7)}, 6) as std_7, "
    f"round({_past_sql('stddev_samp', 30)}, 6) as std_30 from days"))
def _rolling_std(spark, sf_dir):
    return _days(spark, sf_dir).select(
        "ds", F.round(S.past_std(7), 6).alias("std_7"), F.round(S.past_std(30), 6).alias("std_30"))


@query("w4_ma7", days_sql(
    "select ds, avg(y) over (order by ds rows between 6 preceding and current row) as ma from days"))
def _ma7(spark, sf_dir):
    return _days(spark, sf_dir).select("ds", S.moving_average(7).alias("ma"))


@query("w4_ma7_by_area", area_days_sql(
    "select area_id, ds, avg(y) over (partition by area_id order by ds rows between 6 preceding and current row) "
    "as ma from days"))
def _ma7_by_area(spark, sf_dir):
    return _days(spark, sf_dir, ["area_id"]).select("area_id", "ds", S.moving_average(7, ["area_id"]).alias("ma"))


@query("w7_holdout_split", days_sql(
    "select ds, y, row_number() over (order by ds desc) <= 90 as is_test from days"))
def _holdout(spark, sf_dir):
    return S.holdout_flag(_days(spark, sf_dir))


# ---------------------------------------------------------------- reshape
_SPINE = (
    "select cast(unnest(generate_series(d + 1, d + 90, interval 1 day)) as date) as ds from "
    "(select max(ds) as d from days)"
)


@query("u4_date_spine", days_sql(_SPINE))
def _spine(spark, sf_dir):
    return S.future_spine(_days(spark, sf_dir))


@query("u1_append_rows", days_sql(f"select ds, y from days union all select ds, null from ({_SPINE})"))
def _append_rows(spark, sf_dir):
    days = _days(spark, sf_dir)
    return days.unionByName(S.future_spine(days).withColumn("y", F.lit(None).cast("bigint")))


@query("u4_densified", days_sql(
    "select s.ds, coalesce(y, 0) as y from (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as ds "
    "from (select min(ds) as a, max(ds) as b from days)) s left join days on days.ds = s.ds"))
def _densified(spark, sf_dir):
    return S.densify(_days(spark, sf_dir))


# ---------------------------------------------------------------- forecasts versus actuals
@query("j3_actual_vs_forecast", f"with {fx.FORECAST_SQL} select ds, y, yhat from forecast")
def _actual_vs_forecast(spark, sf_dir):
    frozen = fx.frozen_forecast(spark, sf_dir)
    return S.actual_vs_forecast(frozen.select("ds", "y"), frozen)


@query("j4_semi_dates", days_sql(
    f"select ds from ({_SPINE} union all select ds from days) where ds in "
    "(select ds from days order by ds desc limit 90)"))
def _semi_dates(spark, sf_dir):
    """Forecast days (whole history and future) that belong to the test set."""
    days = _days(spark, sf_dir)
    _, test = S.holdout_split(days)
    return S.on_days_of(S.future_spine(days).unionByName(days.select("ds")), test)


@query("a11_mae", f"with {fx.FORECAST_SQL} select avg(abs(y - yhat)) as mae from forecast")
def _mae(spark, sf_dir):
    return fx.frozen_forecast(spark, sf_dir).agg(S.mae())


@query("a12_rmse", f"with {fx.FORECAST_SQL} select sqrt(avg(pow(y - yhat, 2))) as rmse from forecast")
def _rmse(spark, sf_dir):
    return fx.frozen_forecast(spark, sf_dir).agg(S.rmse())


@query("m13_band", f"with {fx.FORECAST_SQL} select ds, y, yhat, yhat * 0.85::double as yhat_lower, "
       "yhat * 1.15::double as yhat_upper from forecast")
def _band(spark, sf_dir):
    return forecast.with_band(fx.frozen_forecast(spark, sf_dir))


# ---------------------------------------------------------------- features
_HOLIDAY_FLAGS = ", ".join(
    f"(strftime({d}, '%m%d') in ('0101', '0704', '1111', '1225') or "
    f"(strftime({d}, '%m%d') = '0619' and year({d}) >= 2021)) as {n}"
    for d, n in (("ds", "hf"), ("cast(ds + to_days(1) as date)", "hn"), ("cast(ds - to_days(1) as date)", "hp")))
_HOLIDAY = (
    "cast(hf or (w = 4 and hn) or (w = 0 and hp) or (w = 0 and ((m = 1 and dd between 15 and 21) or "
    "(m = 2 and dd between 15 and 21) or (m = 5 and dd >= 25) or (m = 9 and dd <= 7) or "
    "(m = 10 and dd between 8 and 14))) or (m = 11 and w = 3 and dd between 22 and 28) as int)"
)
_PARTS = (
    f"select *, cast(isodow(ds) - 1 as int) as w, cast(month(ds) as int) as m, cast(day(ds) as int) as dd, "
    f"{_HOLIDAY_FLAGS} from days"
)
_CALENDAR = {
    "day_of_week": "w", "quarter": "cast(quarter(ds) as int)", "month": "m", "year": "cast(year(ds) as int)",
    "day_of_year": "cast(dayofyear(ds) as int)", "week_of_year": "cast(week(ds) as int)", "is_holiday": _HOLIDAY,
}
_LAG_SQL = {
    **{k: v for k, v in _CALENDAR.items() if k != "week_of_year"},
    "is_weekend": "cast(w >= 5 as int)",
    "day_of_week_sin": "round(sin(2 * pi() * w / 7), 9)", "day_of_week_cos": "round(cos(2 * pi() * w / 7), 9)",
    "month_sin": "round(sin(2 * pi() * m / 12), 9)", "month_cos": "round(cos(2 * pi() * m / 12), 9)",
    **{f"lag_{k}": f"lag(y, {k}) over (order by ds)" for k in M.LAGS},
    **{f"rolling_mean_{w}": f"round({_past_sql('avg', w)}, 6)" for w in M.WINDOWS},
    **{f"rolling_std_{w}": f"round({_past_sql('stddev_samp', w)}, 6)" for w in M.WINDOWS},
}


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in columns.items())


@query("m1_calendar", days_sql(f"select ds, y, {_listed(_CALENDAR)} from ({_PARTS})"))
def _calendar(spark, sf_dir):
    return M.calendar_features(_days(spark, sf_dir))


def _rounded(features):
    digits = {c: 9 for c in M.LAG_FEATURES if c.endswith(("_sin", "_cos"))}
    digits |= {c: 6 for c in M.LAG_FEATURES if c.startswith("rolling_")}
    return features.withColumns({c: F.round(c, d) for c, d in digits.items()})


_LAG_ROWS = f"select ds, y, {_listed(_LAG_SQL)} from ({_PARTS})"


@query("m2_lag_features", days_sql(_LAG_ROWS))
def _lag_features(spark, sf_dir):
    return _rounded(M.lag_features(_days(spark, sf_dir)))


@query("m3_complete_rows", days_sql(
    f"select * from ({_LAG_ROWS}) where lag_30 is not null and rolling_std_30 is not null"))
def _complete_rows(spark, sf_dir):
    return _rounded(M.complete_rows(M.lag_features(_days(spark, sf_dir))))


# ---------------------------------------------------------------- models (rows only)
@query("m4_clusters")
def _clusters(spark, sf_dir):
    """Incidents per cluster with the cluster's mean position."""
    points = stores.fact(spark, sf_dir).select("lat", "lon").where("lat <> 0 AND lon <> 0")
    model = research.fit_clusters(points)
    return research.with_clusters(points, model).groupBy("crime_cluster").agg(
        F.count("*").alias("n"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def _holdout_forecast(recipe):
    def run(spark, sf_dir):
        train, test = S.holdout_split(_days(spark, sf_dir))
        return forecast.predict(forecast.fit(train, recipe), test.select("ds", "y"))

    return run


query("m5_forest")(_holdout_forecast(FOREST))
query("m6_boosted")(_holdout_forecast(BOOSTED))
query("m7_seasonal")(_holdout_forecast(forecast.Additive()))

_METRICS = T.StructType(
    [T.StructField("model", T.StringType()), T.StructField("mae", T.DoubleType()),
     T.StructField("rmse", T.DoubleType()), T.StructField("training_rows", T.IntegerType())])


@query("m8_train_evaluate")
def _train_evaluate(spark, sf_dir):
    days = _days(spark, sf_dir)
    rows = []
    for name, recipe in {"forest": FOREST, "boosted": BOOSTED, "additive": forecast.Additive()}.items():
        done = forecast.train_and_evaluate(days, recipe, fx.CUTOFF)
        rows.append((name, done.mae, done.rmse, done.training_rows))
    return spark.createDataFrame(rows, _METRICS)


@query("m11_recursive")
def _recursive(spark, sf_dir):
    """The whole series, 90 days ahead, every forecast fed back as history."""
    days = S.densify(_days(spark, sf_dir))
    return forecast.recursive_forecast(days, forecast.fit_on_lags(days, FOREST))


@query("m12_direct")
def _direct(spark, sf_dir):
    days = _days(spark, sf_dir)
    return forecast.with_band(forecast.direct_forecast(forecast.fit(days, FOREST), days))


@query("m14_compare")
def _compare(spark, sf_dir):
    return forecast.compare_models(_days(spark, sf_dir), cutoff=fx.CUTOFF)


@query("d7_forecast")
def _served_forecast(spark, sf_dir):
    """Train the champion, publish it, load the newest model of its name back and serve 90 days from ``AS_OF``."""
    models = ModelRegistry(spark, work_path(spark, "models"))
    flows.train_champion(_days(spark, sf_dir), models, AT, fx.CUTOFF)
    return flows.forecast_for(models, flows.CHAMPION, fx.AS_OF)
