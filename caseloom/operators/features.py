"""Model inputs derived from a daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.calendar import calendar_sql, cyclic_calendar_sql
from caseloom.operators import series as S

LAGS = (1, 7, 14, 30)
WINDOWS = (7, 30)
CALENDAR_FEATURES = tuple(calendar_sql())
LAG_FEATURES = (
    *cyclic_calendar_sql(),
    *[f"lag_{k}" for k in LAGS],
    *[f"rolling_{stat}_{w}" for w in WINDOWS for stat in ("mean", "std")],
)


def calendar_features(series: DataFrame, day: str = "ds") -> DataFrame:
    """Add the seven calendar features of ``day``."""
    return series.withColumns({name: F.expr(sql) for name, sql in calendar_sql(day).items()})


def lag_features(
    series: DataFrame,
    keys: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Add calendar, cyclic, lag and rolling features; all windows share one sort per series."""
    columns = {name: F.expr(sql) for name, sql in cyclic_calendar_sql("ds").items()}
    columns |= {f"lag_{k}": S.lag_column(k, keys) for k in lags}
    for w in windows:
        columns[f"rolling_mean_{w}"] = S.past_mean(w, keys)
        columns[f"rolling_std_{w}"] = S.past_std(w, keys)
    return series.withColumns(columns)


def complete_rows(features: DataFrame) -> DataFrame:
    """Rows whose features are all known."""
    return features.na.drop()
