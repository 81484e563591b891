"""Incident records made from the test tables, once for Spark and once as SQL text.

One raw incident per line item.  Column expressions are written once, in the common subset of both
dialects, with ``{us}``, ``{iso}`` and ``{shift}`` standing for the three dialect differences.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = date(1999, 12, 31)
AS_OF = date(2000, 6, 30)

# column -> expression
_RAW = {
    "dr_no": (
        "case when l_suppkey % 10 = 0 then concat(' ', cast(l_orderkey * 10 + l_linenumber as varchar(20)), "
        "' ') else cast(l_orderkey * 10 + l_linenumber as varchar(20)) end"
    ),
    "date_rptd": "concat({us_shifted}, ' 12:00:00 AM')",
    "date_occ": (
        "case when l_partkey % 50 = 7 then null when l_linenumber % 2 = 0 then concat({us}, ' 12:00:00 AM') "
        "else concat({iso}, 'T00:00:00.000') end"
    ),
    "time_occ": (
        "concat(lpad(cast((l_orderkey % 24) * 100 + l_partkey % 60 as varchar(20)), 4, '0'), case when "
        "l_suppkey % 3 = 0 then '.0' else '' end)"
    ),
    "area_id": "case when l_partkey % 30 = 4 then null else lpad(cast(c_nationkey + 1 as varchar(20)), 2, '0') end",
    "area_name": "n_name",
    "crm_cd": "cast(p_size + 100 as varchar(20))",
    "crm_cd_desc": "p_type",
    "status_id": "case when l_partkey % 40 = 3 then null else concat(l_returnflag, l_linestatus) end",
    "status_desc": "concat('Status ', l_returnflag, l_linestatus)",
    "premis_id": "concat(cast(l_suppkey + 101 as varchar(20)), '.0')",
    "premis_desc": "s_name",
    "weapon_id": "case when l_returnflag = 'N' then null else substr(p_brand, 7) end",
    "weapon_desc": "case when l_returnflag = 'N' then null else p_brand end",
    "vict_age": "l_quantity * 2 - 5",
    "vict_sex": "case l_partkey % 5 when 0 then 'M' when 1 then 'F' when 2 then 'X' when 3 then 'H' end",
    "lat": "case when l_partkey % 60 = 0 then 0.0e0 else 33.7e0 + (l_partkey % 120) / 200.0e0 end",
    "lon": "case when l_partkey % 60 in (0, 30) then 0.0e0 else -118.7e0 + (l_suppkey % 100) / 200.0e0 end",
}
RAW_COLUMNS = tuple(_RAW)
DOUBLES = ("vict_age", "lat", "lon")  # as text they read differently in the two engines

_SHIFT = "cast(l_partkey % 20 - 2 as int)"
_SPARK = {
    "us": "date_format(l_shipdate, 'MM/dd/yyyy')",
    "iso": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "us_shifted": f"date_format(date_add(l_shipdate, {_SHIFT}), 'MM/dd/yyyy')",
}
_DUCK = {
    "us": "strftime(l_shipdate, '%m/%d/%Y')",
    "iso": "strftime(l_shipdate, '%Y-%m-%d')",
    "us_shifted": f"strftime(l_shipdate + to_days({_SHIFT}), '%m/%d/%Y')",
}

# tables joined to lineitem with its order, in order; orders get their customers before, as there are far fewer of them
_JOINS = (
    ("part", "l_partkey = p_partkey"),
    ("supplier", "l_suppkey = s_suppkey"),
    ("nation", "c_nationkey = n_nationkey"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per raw incident, over all six tables: a line item without its order, customer, nation, part or supplier is no
    incident."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    df = table(spark, sf_dir, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    for name, condition in _JOINS:
        df = df.join(table(spark, sf_dir, name), F.expr(condition))
    return df


def raw_column(name: str) -> Column:
    return F.expr(_RAW[name].format(**_SPARK))


def raw(spark: SparkSession, sf_dir: str, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Raw incidents with the wanted columns, over all six tables whichever columns are wanted."""
    return _joined(spark, sf_dir).select(*[raw_column(c).alias(c) for c in columns])


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows of ``raw`` with the columns its expressions are over; they take half the room of all columns as text."""
    joined = _joined(spark, sf_dir)
    used = set(re.findall(r"\w+", " ".join(e.format(**_SPARK) for e in _RAW.values())))
    return joined.select(*[c for c in joined.columns if c.lower() in used])


# ---------------------------------------------------------------- the same as SQL text
RAW_SQL = (
    "raw as (select "
    + ", ".join(f"{expr.format(**_DUCK)} as {name}" for name, expr in _RAW.items())
    + " from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"
    " join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"
    " join supplier on l_suppkey = s_suppkey)"
)


def code_sql(column: str) -> str:
    return f"cast(cast(try_cast(trim({column}) as double) as int) as varchar)"


DATE_SQL = (
    "case when {0} like '%/%' then cast(try_strptime(split_part({0}, ' ', 1), '%m/%d/%Y') as date) "
    "else try_cast(substr({0}, 1, 10) as date) end"
)


def date_sql(column: str) -> str:
    return DATE_SQL.replace("{0}", column)


FACT_COLUMNS = (
    "dr_no", "date_occ", "time_occ", "area_id", "crm_cd", "status_id", "premis_id", "weapon_id", "lat", "lon",
    "vict_age",
)


def typed_sql(source: str = "raw") -> str:
    return (
        f"select trim(dr_no) as dr_no, {date_sql('date_occ')} as date_occ, "
        "cast(try_cast(time_occ as double) as int) as time_occ, "
        f"coalesce({code_sql('area_id')}, '0') as area_id, coalesce({code_sql('crm_cd')}, '0') as crm_cd, "
        "coalesce(trim(status_id), 'XX') as status_id, "
        f"coalesce({code_sql('premis_id')}, '0') as premis_id, "
        f"coalesce({code_sql('weapon_id')}, '0') as weapon_id, lat, lon, vict_age "
        f"from {source} where dr_no is not null"
    )


def first_sql(rows: str) -> str:
    order = ", ".join(f"{c} asc nulls last" for c in FACT_COLUMNS[1:])
    return (
        f"select {', '.join(FACT_COLUMNS)} from (select *, row_number() over (partition by dr_no order by {order})"
        f" as rn from ({rows})) where rn = 1"
    )


FACT_SQL = f"fact as ({first_sql('select distinct * from (' + typed_sql() + ')')})"


def dim_sql(code: str, label: str, member: str, unknown: str, source: str = "raw", text: str | None = None) -> str:
    key = text or code_sql(code)
    return (
        f"select '{member}' as {code}, '{unknown}' as {label} union all "
        f"select k as {code}, min({label}) as {label} from (select {key} as k, {label} from {source} "
        f"where {code} is not null) where k is not null and k <> '{member}' group by k"
    )


DIM_SQL = {
    "dim_area": dim_sql("area_id", "area_name", "0", "Unknown Area"),
    "dim_crime": dim_sql("crm_cd", "crm_cd_desc", "0", "Unknown Crime"),
    "dim_status": dim_sql("status_id", "status_desc", "XX", "Unknown Status", text="trim(status_id)"),
    "dim_premise": dim_sql("premis_id", "premis_desc", "0", "Unknown Premise"),
    "dim_weapon": dim_sql("weapon_id", "weapon_desc", "0", "Unknown Weapon"),
    "dim_date": (
        "select distinct d as date_id, cast(year(d) as int) as year, cast(month(d) as int) as month, "
        "cast(day(d) as int) as day, cast(dayofweek(d) as int) as day_of_week, cast(quarter(d) as int) as quarter "
        f"from (select {date_sql('date_occ')} as d from raw) where d is not null"
    ),
    "dim_time": (
        "select distinct t as time_id, t // 100 as hour, case when t // 100 between 5 and 11 then 'Morning' "
        "when t // 100 between 12 and 16 then 'Afternoon' when t // 100 between 17 and 20 then 'Evening' "
        "else 'Night' end as time_of_day from (select cast(try_cast(time_occ as double) as int) as t from raw) "
        "where t is not null"
    ),
}


# table -> (key, its other columns) of the seven dimensions
DIM_PARTS = {
    "dim_area": ("area_id", ("area_name",)),
    "dim_crime": ("crm_cd", ("crm_cd_desc",)),
    "dim_status": ("status_id", ("status_desc",)),
    "dim_premise": ("premis_id", ("premis_desc",)),
    "dim_weapon": ("weapon_id", ("weapon_desc",)),
    "dim_date": ("date_id", ("year", "month", "day", "day_of_week", "quarter")),
    "dim_time": ("time_id", ("hour", "time_of_day")),
}


def stacked_sql(suffix: str = "") -> str:
    """All dimensions as one statement: (table_name, member, attributes), values as text."""
    return " union all ".join(
        f"select '{t}' as table_name, cast({key} as varchar) as member, "
        f"concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in others)}) as attributes from {t}{suffix}"
        for t, (key, others) in DIM_PARTS.items()
    )


def stacked(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``stacked_sql`` over Spark tables."""
    frames = [
        tables[t].select(
            F.lit(t).alias("table_name"), F.col(key).cast("string").alias("member"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in others]).alias("attributes"),
        )
        for t, (key, others) in DIM_PARTS.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def with_raw(body: str) -> str:
    return f"with {RAW_SQL} {body}"


def with_fact(body: str, *dims: str, **extra: str) -> str:
    """``body`` over the fact, the named dimensions and further named sub-queries."""
    parts = [RAW_SQL, FACT_SQL]
    parts += [f"{d} as ({DIM_SQL[d]})" for d in dims]
    parts += [f"{name} as ({text})" for name, text in extra.items()]
    return f"with {', '.join(parts)} {body}"


DAYS = "select date_occ as ds, count(*) as y from fact where date_occ is not null group by date_occ"


# ---------------------------------------------------------------- small tables from events
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('model_', user_id % 4) as model_name",
        "cast(ts as timestamp) as created_at",
        "value as mae",
        "value + 1 as rmse",
        "int(event_id % 500 + 100) as training_rows",
    )


METRICS_SQL = (
    "metrics as (select concat('model_', user_id % 4) as model_name, ts as created_at, value as mae, "
    "value + 1 as rmse, cast(event_id % 500 + 100 as int) as training_rows from events)"
)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(ts as timestamp) as ts",
        "concat('flow_', user_id % 5) as flow",
        "concat('task_', user_id % 7) as task",
        "case when event_type = 'error' then 'FAILED' else 'SUCCESS' end as status",
        "cast(ts as date) as logical_date",
        "concat('log/', event_id) as log_url",
        "case when event_type = 'error' then props else '' end as error_message",
    )


AUDIT_SQL = (
    "audit as (select ts, concat('flow_', user_id % 5) as flow, concat('task_', user_id % 7) as task, "
    "case when event_type = 'error' then 'FAILED' else 'SUCCESS' end as status, cast(ts as date) as logical_date, "
    "concat('log/', event_id) as log_url, case when event_type = 'error' then props else '' end as error_message "
    "from events)"
)


def frozen_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed forecast per event day, to check error measures exactly."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("ds"))
        .agg(F.count("*").alias("y"))
        .withColumn("yhat", F.expr("double(y + dayofmonth(ds) % 7 - 3)"))
    )


FORECAST_SQL = (
    "forecast as (select ds, y, cast(y + day(ds) % 7 - 3 as double) as yhat from "
    "(select cast(ts as date) as ds, count(*) as y from events group by 1))"
)
