"""Calendar features of a date as SQL expression text.

Text rather than Column objects, because the same expressions also travel inside saved
``pyspark.ml`` pipelines (``SQLTransformer``): a stored model can then be applied to bare dates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays with a fixed date, as month * 100 + day.
FIXED_HOLIDAYS = (101, 704, 1111, 1225)
JUNETEENTH, JUNETEENTH_FIRST_YEAR = 619, 2021
# Holidays on the n-th weekday of a month: (month, weekday with Monday = 0, first day, last day).
FLOATING_HOLIDAYS = (
    (1, 0, 15, 21),
    (2, 0, 15, 21),
    (5, 0, 25, 31),
    (9, 0, 1, 7),
    (10, 0, 8, 14),
    (11, 3, 22, 28),
)


def _on_fixed_date(day: str) -> str:
    code = f"(month({day}) * 100 + dayofmonth({day}))"
    dates = ", ".join(map(str, FIXED_HOLIDAYS))
    return (
        f"({code} IN ({dates}) OR ({code} = {JUNETEENTH} AND year({day}) >= {JUNETEENTH_FIRST_YEAR}))"
    )


def holiday_sql(day: str) -> str:
    """Boolean: ``day`` is a national holiday or the weekday on which one is observed."""
    floating = " OR ".join(
        f"(month({day}) = {m} AND weekday({day}) = {w} AND dayofmonth({day}) BETWEEN {a} AND {b})"
        for m, w, a, b in FLOATING_HOLIDAYS
    )
    observed = (
        f"(weekday({day}) = 4 AND {_on_fixed_date(f'date_add({day}, 1)')}) OR "
        f"(weekday({day}) = 0 AND {_on_fixed_date(f'date_sub({day}, 1)')})"
    )
    return f"({_on_fixed_date(day)} OR {floating} OR {observed})"


def is_holiday(day: str) -> Column:
    return F.expr(holiday_sql(day))


def calendar_sql(day: str = "ds") -> dict[str, str]:
    """The seven calendar features, in model order."""
    return {
        "day_of_week": f"weekday({day})",
        "quarter": f"quarter({day})",
        "month": f"month({day})",
        "year": f"year({day})",
        "day_of_year": f"dayofyear({day})",
        "week_of_year": f"weekofyear({day})",
        "is_holiday": f"int({holiday_sql(day)})",
    }


def cyclic_calendar_sql(day: str = "ds") -> dict[str, str]:
    """The calendar part of the lag feature set, in model order."""
    plain = calendar_sql(day)
    return {
        **{k: plain[k] for k in ("day_of_week", "quarter", "month", "year", "day_of_year")},
        "is_weekend": f"int(weekday({day}) IN (5, 6))",
        "is_holiday": plain["is_holiday"],
        "day_of_week_sin": f"sin(2 * pi() * weekday({day}) / 7)",
        "day_of_week_cos": f"cos(2 * pi() * weekday({day}) / 7)",
        "month_sin": f"sin(2 * pi() * month({day}) / 12)",
        "month_cos": f"cos(2 * pi() * month({day}) / 12)",
    }
