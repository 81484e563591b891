"""Header mapping, scalar functions and row filters over the whole raw input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.functions.calendar import is_holiday
from caseloom.operators import series as S
from caseloom.plans import research
from caseloom.schemas import STAGING, STAGING_COLUMNS
from caseloom.sources import headers as H
from caseloom.sources.lake import latest_records
from caseloom.workload import fixture as fx
from caseloom.workload.registry import query

C = F.col
_CODE = fx.code_sql
_DATE = fx.date_sql
_INT_TIME = "cast(try_cast(time_occ as double) as int)"


def _projection(name: str, inputs: tuple[str, ...], columns: dict[str, tuple[Column, str]]) -> None:
    """Register ``select dr_no, <columns> from raw``; each column is (Spark, SQL)."""

    def run(spark, sf_dir) -> DataFrame:
        raw = fx.raw(spark, sf_dir, ("dr_no", *inputs))
        return raw.select("dr_no", *[spark_side().alias(c) for c, (spark_side, _) in columns.items()])

    listed = ", ".join(f"{sql} as {c}" for c, (_, sql) in columns.items())
    query(name, fx.with_raw(f"select dr_no, {listed} from raw"))(run)


# Spark columns are wrapped in lambdas: building one needs a running session.
_projection("p10_timestamps", ("date_occ", "date_rptd"), {
    c: (lambda c=c: X.to_timestamp_or_null(C(c)),
        f"coalesce(try_cast({c} as timestamp), try_strptime({c}, '%m/%d/%Y %I:%M:%S %p'))")
    for c in ("date_occ", "date_rptd")
})
_projection("p11_coerce_numeric", ("time_occ", "premis_id", "area_name"), {
    c: (lambda c=c: X.parse_number(C(c)), f"try_cast({c} as double)")
    for c in ("time_occ", "premis_id", "area_name")
})
_projection("p12_fill_defaults", ("weapon_id", "area_id"), {
    "weapon": (lambda: X.fill_default(X.parse_number(C("weapon_id")), 0.0),
               "coalesce(try_cast(weapon_id as double), 0)"),
    "area": (lambda: X.fill_default(X.parse_number(C("area_id")), -1.0), "coalesce(try_cast(area_id as double), -1)"),
})
_AGE_TEXT = "concat(cast(cast(vict_age as int) as varchar(20)), '.7')"
_projection("p13_standard_code", ("vict_age", "weapon_id"), {
    "age_code": (lambda: X.truncated_code(F.expr(_AGE_TEXT)),
                 f"cast(cast(trunc(try_cast({_AGE_TEXT} as double)) as int) as varchar)"),
    "weapon": (lambda: X.truncated_code(C("weapon_id")),
               "cast(cast(trunc(coalesce(try_cast(weapon_id as double), 0)) as int) as varchar)"),
})
_projection("p14_zero_code_null", ("weapon_id", "time_occ"), {
    "weapon": (lambda: X.standard_code(C("weapon_id")),
               "nullif(cast(cast(trunc(coalesce(try_cast(weapon_id as double), 0)) as int) as varchar), '0')"),
    "time_code": (lambda: X.standard_code(C("time_occ")),
                  "nullif(cast(cast(trunc(coalesce(try_cast(time_occ as double), 0)) as int) as varchar), '0')"),
})
_HALF = "concat(cast(cast(vict_age as int) as varchar(20)), '.5')"
_projection("p15_canonical_code", ("area_id", "premis_id", "weapon_id", "vict_age"), {
    "half": (lambda: X.canonical_code(F.expr(_HALF)), _CODE(_HALF)),
    **{c: (lambda c=c: X.canonical_code(C(c)), _CODE(c)) for c in ("area_id", "premis_id", "weapon_id")},
})
_projection("p16_default_member", ("area_id", "weapon_id", "status_id"), {
    "area_id": (lambda: X.or_unknown(X.canonical_code(C("area_id")), "0"), f"coalesce({_CODE('area_id')}, '0')"),
    "weapon_id": (lambda: X.or_unknown(X.canonical_code(C("weapon_id")), "0"),
                  f"coalesce({_CODE('weapon_id')}, '0')"),
    "status_id": (lambda: X.or_unknown(F.trim("status_id"), "XX"), "coalesce(trim(status_id), 'XX')"),
})
_projection("p17_blank_to_double", ("weapon_id", "premis_id"), {
    "weapon": (lambda: X.blank_to_double(F.coalesce(C("weapon_id"), F.lit("  "))),
               "try_cast(nullif(trim(coalesce(weapon_id, '  ')), '') as double)"),
    "premise": (lambda: X.blank_to_double(C("premis_id")), "try_cast(nullif(trim(premis_id), '') as double)"),
})
_projection("p18_dual_date", ("date_occ", "date_rptd"), {
    c: (lambda c=c: X.dual_format_date(C(c)), _DATE(c)) for c in ("date_occ", "date_rptd")
})
_projection("p19_time_code", ("time_occ",), {"time_id": (lambda: X.half_even_int(C("time_occ")), _INT_TIME)})
_projection("p20_hour", ("time_occ",), {
    "hour": (lambda: X.hour_of_code(X.half_even_int(C("time_occ"))), f"{_INT_TIME} // 100"),
})
_projection("p21_time_of_day", ("time_occ",), {
    "band": (lambda: X.time_of_day(X.hour_of_code(X.half_even_int(C("time_occ")))),
             f"case when {_INT_TIME} // 100 between 5 and 11 then 'Morning' when {_INT_TIME} // 100 between 12 and 16 "
             f"then 'Afternoon' when {_INT_TIME} // 100 between 17 and 20 then 'Evening' else 'Night' end"),
})
_projection("p22_padded_hour", ("time_occ",), {
    "hour": (lambda: X.padded_hour(C("time_occ")),
             "cast(substr(lpad(cast(cast(trunc(try_cast(time_occ as double)) as int) as varchar), 4, '0'), 1, 2) as int)"),
})
_projection("p23_cap_age", ("vict_age",), {
    "age": (lambda: X.cap(C("vict_age"), 80.0), "case when vict_age > 80 then 80 else vict_age end"),
})
_projection("p25_sanitise_numeric", ("weapon_desc", "premis_desc", "crm_cd_desc"), {
    c: (lambda c=c: X.sanitised_number(C(c)),
        f"try_cast(nullif(regexp_replace({c}, '[^0-9.-]', '', 'g'), '') as double)")
    for c in ("weapon_desc", "premis_desc", "crm_cd_desc")
})
_projection("p26_trim_key", ("status_id",), {
    "trimmed": (lambda: F.trim("dr_no"), "trim(dr_no)"),
    "status_id": (lambda: F.trim("status_id"), "trim(status_id)"),
})


@query("p24_date_parts", fx.with_raw(
    f"select d, cast(year(d) as int) as year, cast(month(d) as int) as month, cast(day(d) as int) as day, "
    "cast(dayofweek(d) as int) as day_of_week, cast(quarter(d) as int) as quarter "
    f"from (select {_DATE('date_rptd')} as d from raw)"))
def _date_parts(spark, sf_dir):
    days = fx.raw(spark, sf_dir, ("date_rptd",)).select(X.dual_format_date(C("date_rptd")).alias("d"))
    return days.select("d", *X.date_parts(C("d")))


@query("p28_date_format", "select event_id, strftime(ts, '%Y-%m-%d %H:%M') as minute from events")
def _minute(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", X.minute_text(C("ts")).alias("minute"))


@query("p29_fixed_decimals", "select event_id, printf('%.2f', value) as text from events")
def _two_decimals(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", X.two_decimals(C("value")).alias("text"))


@query("p30_kpi_text", fx.with_raw(
    "select area_name, format('{:,}', count(*)) as cases, cast(round_even(coalesce(avg(vict_age), 0), 0) as int) as age, "
    "substr(concat(area_name, ' ', area_name, ' area'), 1, 15) || '...' as label from raw group by area_name"))
def _kpi_text(spark, sf_dir):
    groups = fx.raw(spark, sf_dir, ("area_name", "vict_age")).groupBy("area_name").agg(
        F.count("*").alias("n"), F.avg("vict_age").alias("age"))
    long_label = F.concat(C("area_name"), F.lit(" "), C("area_name"), F.lit(" area"))
    return groups.select(
        "area_name", X.thousands(C("n")).alias("cases"), X.whole_age(C("age")).alias("age"),
        X.short_label(long_label).alias("label"))


# ---------------------------------------------------------------- header mapping
# How each kind of extract spells the raw columns.
DAILY_SPELLING = {v: k.upper().replace("_", " ") for k, v in H.DAILY_COLUMNS.items()}
RESEARCH_SPELLING = {
    **{v: f" {k.title().replace('_', '-')} " for k, v in H.DAILY_COLUMNS.items()},
    "dr_no": "DrNo", "date_occ": "DateOcc", "time_occ": "TimeOcc", "vict_age": "VictAge", "vict_sex": "Vict Sex",
}
HISTORICAL_SPELLING = {
    **{c: c.upper().replace("_", " ") for c in fx.RAW_COLUMNS},
    "area_id": "AREA", "premis_id": "Premis Cd", "weapon_id": "Weapon Used Cd", "status_id": "Status",
}


def spelled(raw: DataFrame, spelling: dict[str, str]) -> DataFrame:
    return raw.toDF(*[spelling.get(c, c) for c in raw.columns])


_DAILY_TARGETS = tuple(H.DAILY_COLUMNS.values())


@query("p4_daily_mapping", fx.with_raw(f"select {', '.join(_DAILY_TARGETS)} from raw"))
def _daily_mapping(spark, sf_dir):
    extract = spelled(fx.raw(spark, sf_dir), DAILY_SPELLING)
    return H.map_columns(extract, H.DAILY_COLUMNS, H.basic_header)


@query("p5_research_mapping", fx.with_raw("select * from raw"))
def _research_mapping(spark, sf_dir):
    extract = spelled(fx.raw(spark, sf_dir), RESEARCH_SPELLING)
    return H.map_columns(extract, H.RESEARCH_COLUMNS, H.snake_header, keep_unmapped=True)


@query("p6_historical_mapping", fx.with_raw("select " + ", ".join(
    c if c in fx.RAW_COLUMNS else f"cast(null as varchar) as {c}" for c in STAGING_COLUMNS) + " from raw"))
def _historical_mapping(spark, sf_dir):
    extract = spelled(fx.raw(spark, sf_dir), HISTORICAL_SPELLING)
    return H.conform(
        H.map_columns(extract, H.historical_columns(STAGING_COLUMNS), H.alphanumeric_header), STAGING)


# ---------------------------------------------------------------- filters
def _filtered(name: str, inputs: tuple[str, ...], keep, condition: str, columns: str) -> None:
    """Register a row filter; ``keep`` maps the raw DataFrame to the kept rows."""

    def run(spark, sf_dir) -> DataFrame:
        return keep(fx.raw(spark, sf_dir, inputs))

    query(name, fx.with_raw(f"select {columns} from raw where {condition}"))(run)


_DAY = _DATE("date_occ")
_filtered(
    "f1_cutoff", ("dr_no", "date_occ"),
    lambda raw: research.until_cutoff(
        raw.withColumn("date_occ", X.to_timestamp_or_null(C("date_occ"))), fx.CUTOFF
    ).withColumn("date_occ", C("date_occ").cast("date")),
    f"{_DAY} <= date '{fx.CUTOFF}'", f"dr_no, {_DAY} as date_occ")
_filtered(
    "f2_rolling_cutoff", ("dr_no", "date_occ"),
    lambda raw: S.until_day_before(raw.select("dr_no", X.dual_format_date(C("date_occ")).alias("ds")), fx.AS_OF),
    f"{_DAY} <= date '{fx.AS_OF}' - 1", f"dr_no, {_DAY} as ds")
_filtered("f3_null_island_strict", ("dr_no", "lat", "lon"), research.off_zero_coordinates,
          "coalesce(lat, 0) <> 0 and coalesce(lon, 0) <> 0", "dr_no, lat, lon")
_filtered("f4_null_island_sql", ("dr_no", "lat", "lon"),
          lambda raw: raw.where(X.off_null_island(C("lat"), C("lon"))), "lat <> 0 and lon <> 0", "dr_no, lat, lon")
_filtered("f5_positive_age", ("dr_no", "vict_age"), research.with_positive_age, "vict_age > 0", "dr_no, vict_age")
_filtered("f6_sex_domain", ("dr_no", "vict_sex"), research.with_known_sex, "vict_sex in ('M', 'F', 'X')",
          "dr_no, vict_sex")
_filtered("f7_key_not_null", ("dr_no", "area_id"), lambda raw: raw.where("area_id IS NOT NULL"),
          "area_id is not null", "dr_no, area_id")


@query("j7_holidays", fx.with_raw(
    "select ds, (f or (w = 4 and nf) or (w = 0 and pf) or (m = 1 and w = 0 and dd between 15 and 21) "
    "or (m = 2 and w = 0 and dd between 15 and 21) or (m = 5 and w = 0 and dd >= 25) or (m = 9 and w = 0 and dd <= 7) "
    "or (m = 10 and w = 0 and dd between 8 and 14) or (m = 11 and w = 3 and dd between 22 and 28)) as holiday from ("
    "select ds, month(ds) as m, day(ds) as dd, isodow(ds) - 1 as w, "
    + ", ".join(
        f"(strftime({d}, '%m%d') in ('0101', '0704', '1111', '1225') or (strftime({d}, '%m%d') = '0619' "
        f"and year({d}) >= 2021)) as {n}"
        for d, n in (("ds", "f"), ("cast(ds + to_days(1) as date)", "nf"), ("cast(ds - to_days(1) as date)", "pf")))
    + f" from (select distinct {_DATE('date_rptd')} as ds from raw))"))
def _holidays(spark, sf_dir):
    days = fx.raw(spark, sf_dir, ("date_rptd",)).select(X.dual_format_date(C("date_rptd")).alias("ds")).distinct()
    return days.select("ds", is_holiday("ds").alias("holiday"))


@query("s9_latest_n_extract", fx.with_raw(
    f"select dr_no, {_DAY} as date_occ from raw order by 2 desc nulls last, dr_no limit 2000"))
def _latest_records(spark, sf_dir):
    raw = fx.raw(spark, sf_dir, ("dr_no", "date_occ"))
    return latest_records(raw.withColumn("date_occ", X.dual_format_date(C("date_occ"))))
