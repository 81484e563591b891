from __future__ import annotations

from datetime import date, timedelta

import pytest

from caseloom.operators import features as M
from caseloom.operators import series as S

DAY = date(2024, 1, 1)


def days(table, ys, start=DAY):
    return table("ds date, y bigint", [(start + timedelta(i), y) for i, y in enumerate(ys)])


def column(df, name="x"):
    return [r[name] for r in df.orderBy("ds").collect()]


def test_daily_counts_skip_missing_days(table):
    rows = table("k string, date_occ date", [("a", DAY), ("a", DAY), ("b", DAY), ("a", None)])
    assert S.daily_counts(rows).collect() == [(DAY, 3)]
    assert sorted(S.daily_counts(rows, keys=["k"]).collect()) == [("a", DAY, 2), ("b", DAY, 1)]


def test_windows(table):
    d = days(table, range(1, 11))
    assert column(d.select("ds", S.past_std(3).alias("x"))) == [None] * 3 + [1.0] * 7
    assert column(d.select("ds", S.past_mean(3).alias("x")))[:5] == [None, None, None, 2.0, 3.0]
    assert column(d.select("ds", S.moving_average(7).alias("x"))) == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0, 7.0]
    assert column(d.select("ds", S.lag_column(2).alias("x")))[:4] == [None, None, 1, 2]


def test_windows_stay_inside_their_series(table):
    rows = table("k string, ds date, y bigint",
                 [(k, DAY + timedelta(i), v) for k, v in (("a", 1), ("b", 100)) for i in range(4)])
    out = rows.select("k", "ds", S.moving_average(7, ["k"]).alias("x"), S.lag_column(1, ["k"]).alias("l"))
    assert {(r["k"], r["x"], r["l"]) for r in out.collect()} == {
        ("a", 1.0, None), ("a", 1.0, 1), ("b", 100.0, None), ("b", 100.0, 100)}


def test_cutoffs(table):
    d = days(table, range(5))
    assert S.until(d, DAY + timedelta(2)).count() == 3
    assert S.until_day_before(d, DAY + timedelta(2)).count() == 2


def test_holdout(table):
    train, test = S.holdout_split(days(table, range(10)), rows=3)
    assert column(train, "y") == list(range(7)) and column(test, "y") == [7, 8, 9]


def test_spine_and_densify(table):
    d = table("ds date, y bigint", [(DAY, 4), (DAY + timedelta(3), 5)])
    assert column(S.densify(d), "y") == [4, 0, 0, 5]
    assert column(S.future_spine(d, 2), "ds") == [DAY + timedelta(4), DAY + timedelta(5)]
    assert column(S.future_spine(d, 2, start=date(2025, 1, 1)), "ds") == [date(2025, 1, 1), date(2025, 1, 2)]
    assert S.future_spine(d.limit(0)).isEmpty() and S.densify(d.limit(0)).isEmpty()


def test_minimum_history(table):
    with pytest.raises(S.ShortHistory):
        S.require_history(days(table, range(99)))
    S.require_history(days(table, range(100)))


def test_errors_and_matching_by_day(table):
    actual = days(table, [10, 20, 30])
    forecast = table("ds date, yhat double", [(DAY, 12.0), (DAY + timedelta(2), 29.0), (DAY + timedelta(9), 1.0)])
    both = S.actual_vs_forecast(actual, forecast)
    assert tuple(both.agg(S.mae(), S.rmse()).first()) == (1.5, 2.5**0.5)
    assert S.on_days_of(forecast, actual).count() == 2


def test_calendar_features(table):
    row = M.calendar_features(days(table, [1], date(2023, 1, 1))).first()
    assert [row[c] for c in M.CALENDAR_FEATURES] == [6, 1, 1, 2023, 1, 52, 1]


def test_lag_features_by_hand(table):
    d = days(table, [i * i % 23 for i in range(40)])
    rows = M.lag_features(d).orderBy("ds").collect()
    ys = [r["y"] for r in rows]
    at = 35
    assert [rows[at][f"lag_{k}"] for k in M.LAGS] == [ys[at - k] for k in M.LAGS]
    import statistics

    for w in M.WINDOWS:
        assert rows[at][f"rolling_mean_{w}"] == pytest.approx(statistics.mean(ys[at - w : at]))
        assert rows[at][f"rolling_std_{w}"] == pytest.approx(statistics.stdev(ys[at - w : at]))
    assert M.complete_rows(M.lag_features(d)).count() == 10
    assert len(M.LAG_FEATURES) == 19
    assert [c for c in M.lag_features(d).columns if c not in ("ds", "y")] == list(M.LAG_FEATURES)


def test_lag_windows_share_one_sort(table):
    plan = M.lag_features(days(table, range(3)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") <= 2
