"""Star queries: filters, joins, counts, tops, samples, quality rules, dashboard queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from caseloom.operators import quality, ranking
from caseloom.operators import series as S
from caseloom.operators.star import (
    StarFilter,
    bernoulli_sample,
    date_range,
    filtered_fact,
    hash_sample,
    with_labels,
)
from caseloom.plans import dashboard
from caseloom.workload import fixture as fx
from caseloom.workload import stores
from caseloom.workload.registry import query

START, END = date(1996, 1, 1), date(1998, 12, 31)
AREAS = ("NATION_1", "NATION_3", "NATION_7", "NATION_12")
CRIMES = ("ECONOMY", "LARGE", "Unknown Crime")
WEAPONS = ("Brand#2", "Brand#17", "Brand#9", "Unknown Weapon")
PREMISES = tuple(f"Supplier#{n:09d}" for n in range(20))

ALL_LISTS = StarFilter(START, END, AREAS, CRIMES, WEAPONS, PREMISES)
SOME_LISTS = StarFilter(START, END, AREAS, (), WEAPONS, ())
ONLY_DATES = StarFilter(START, END)

_LABEL_DIMS = ("dim_area", "dim_crime", "dim_weapon", "dim_premise", "dim_status")
_IN = {
    "areas": "da.area_name", "crimes": "dc.crm_cd_desc", "weapons": "dw.weapon_desc", "premises": "dp.premis_desc",
}
_STAR = (
    "from fact f left join dim_area da on f.area_id = da.area_id left join dim_crime dc on f.crm_cd = dc.crm_cd "
    "left join dim_weapon dw on f.weapon_id = dw.weapon_id left join dim_premise dp on f.premis_id = dp.premis_id "
)
_STAR5 = _STAR + "left join dim_status ds on f.status_id = ds.status_id "


def _where(chosen: StarFilter) -> str:
    clauses = []
    if chosen.start is not None:
        clauses.append(f"f.date_occ between date '{chosen.start}' and date '{chosen.end}'")
    for name, column in _IN.items():
        values = getattr(chosen, name)
        if values:
            clauses.append(f"{column} in ({', '.join(repr(v) for v in values)})")
    return f"where {' and '.join(clauses)} " if clauses else ""


def star_sql(body: str) -> str:
    return fx.with_fact(body, *_LABEL_DIMS)


# ---------------------------------------------------------------- filters and joins
@query("f8_date_range", fx.with_fact(
    f"select dr_no, date_occ from fact where date_occ between date '{START}' and date '{END}'"))
def _date_range(spark, sf_dir):
    return date_range(stores.fact(spark, sf_dir), START, END).select("dr_no", "date_occ")


def _star_filter(name: str, chosen: StarFilter) -> None:
    @query(f"f9_star_filter_{name}", star_sql(f"select f.dr_no, f.area_id, f.crm_cd {_STAR} {_where(chosen)}"))
    def _run(spark, sf_dir):
        return filtered_fact(stores.star(spark, sf_dir), chosen).select("dr_no", "area_id", "crm_cd")


_star_filter("none", StarFilter())
_star_filter("areas", StarFilter(START, END, areas=AREAS))
_star_filter("all", ALL_LISTS)


@query("f11_non_null_options", star_sql(
    "select 'weapon' as kind, weapon_desc as label from dim_weapon where weapon_desc is not null union "
    "select 'premise', premis_desc from dim_premise where premis_desc is not null"))
def _non_null_options(spark, sf_dir):
    star = stores.star(spark, sf_dir)
    weapons = ranking.options(star.weapon, "weapon_desc", keep_null=False)
    premises = ranking.options(star.premise, "premis_desc", keep_null=False)
    return weapons.select(F.lit("weapon").alias("kind"), F.col("weapon_desc").alias("label")).unionByName(
        premises.select(F.lit("premise").alias("kind"), F.col("premis_desc").alias("label")))


@query("j1_star4", star_sql(
    f"select f.dr_no, da.area_name, dc.crm_cd_desc, dw.weapon_desc, dp.premis_desc {_STAR}"))
def _star4(spark, sf_dir):
    star = stores.star(spark, sf_dir)
    return with_labels(star, star.fact, ["area", "crime", "weapon", "premise"]).select(
        "dr_no", "area_name", "crm_cd_desc", "weapon_desc", "premis_desc")


@query("j2_star5", star_sql(
    f"select f.dr_no, da.area_name, dc.crm_cd_desc, dw.weapon_desc, dp.premis_desc, ds.status_desc {_STAR5}"))
def _star5(spark, sf_dir):
    star = stores.star(spark, sf_dir)
    return with_labels(star, star.fact, ["area", "crime", "weapon", "premise", "status"]).select(
        "dr_no", "area_name", "crm_cd_desc", "weapon_desc", "premis_desc", "status_desc")


_BOUND = (
    "select da.area_name, f.vict_age, count(*) as n from fact_crime f "
    "left join dim_area da on f.area_id = da.area_id "
    "where f.date_occ between :start and :end and da.area_name <> :area group by da.area_name, f.vict_age"
)


@query("s12_parameterised_sql", star_sql(
    _BOUND.replace("fact_crime", "fact").replace(":start", f"date '{START}'").replace(":end", f"date '{END}'")
    .replace(":area", f"'{AREAS[0]}'")))
def _parameterised_sql(spark, sf_dir):
    return stores.incident_store(spark, sf_dir).sql(_BOUND, start=START, end=END, area=AREAS[0])


# ---------------------------------------------------------------- aggregates
@query("a1_count_avg", star_sql(
    f"select count(*) as total, avg(vict_age) as avg_age {_STAR} {_where(SOME_LISTS)}"))
def _count_avg(spark, sf_dir):
    return filtered_fact(stores.star(spark, sf_dir), SOME_LISTS).agg(
        F.count("*").alias("total"), F.avg("vict_age").alias("avg_age"))


@query("a2_counts_by_area", star_sql(f"select da.area_name, count(*) as n {_STAR} group by 1"))
def _counts_by_area(spark, sf_dir):
    """Counted by code first; only the per-code counts meet the labels."""
    star = stores.star(spark, sf_dir)
    by_code = ranking.group_counts(star.fact, "area_id")
    return with_labels(star, by_code, ["area"]).groupBy("area_name").agg(F.sum("n").alias("n"))


@query("a5_filtered_trend", star_sql(f"select f.date_occ, count(*) as n {_STAR} {_where(ALL_LISTS)} group by 1"))
def _filtered_trend(spark, sf_dir):
    days = S.daily_counts(filtered_fact(stores.star(spark, sf_dir), ALL_LISTS))
    return days.select(F.col("ds").alias("date_occ"), F.col("y").alias("n"))


@query("a6_date_span", fx.with_fact("select min(date_occ) as first_day, max(date_occ) as last_day from fact"))
def _date_span(spark, sf_dir):
    return ranking.span(stores.fact(spark, sf_dir), "date_occ")


@query("a7_row_count", fx.with_raw("select count(*) as n from raw"))
def _row_count(spark, sf_dir):
    return fx.raw(spark, sf_dir, ("dr_no",)).agg(F.count("*").alias("n"))


@query("a9_distinct", fx.with_raw("select distinct status_id, status_desc, vict_sex from raw"))
def _distinct(spark, sf_dir):
    columns = ("status_id", "status_desc", "vict_sex")
    return fx.raw(spark, sf_dir, columns).distinct()


# ---------------------------------------------------------------- quality
_LATE = f"{fx.date_sql('date_rptd')} < {fx.date_sql('date_occ')}"
_RULE_SQL = {
    "reported_before_occurred": f"count(*) filter (where {_LATE})",
    "negative_age": "count(*) filter (where vict_age < 0)",
    "null_island": "count(*) filter (where lat = 0 and lon = 0)",
}
_QUALITY_INPUTS = ("date_rptd", "date_occ", "vict_age", "lat", "lon")


@query("a8_violations", fx.with_raw(
    "select count(*) as total, " + ", ".join(f"{sql} as {n}" for n, sql in _RULE_SQL.items()) + " from raw"))
def _violations(spark, sf_dir):
    return quality.violation_counts(fx.raw(spark, sf_dir, _QUALITY_INPUTS))


@query("q3_reported_before", fx.with_raw(
    f"select count(*) as total, {_RULE_SQL['reported_before_occurred']} as reported_before_occurred from raw"))
def _reported_before(spark, sf_dir):
    return quality.violation_counts(fx.raw(spark, sf_dir, ("date_rptd", "date_occ")))


@query("q3_reported_before_lexical", fx.with_raw(
    "select count(*) as total, count(*) filter (where date_rptd < date_occ) as reported_before_occurred from raw"))
def _reported_before_lexical(spark, sf_dir):
    return quality.violation_counts(fx.raw(spark, sf_dir, ("date_rptd", "date_occ")), lexical=True)


@query("q4_negative_age", fx.with_raw(
    f"select count(*) as total, {_RULE_SQL['negative_age']} as negative_age from raw"))
def _negative_age(spark, sf_dir):
    return quality.violation_counts(fx.raw(spark, sf_dir, ("vict_age",)))


@query("q5_null_island", fx.with_raw(
    f"select count(*) as total, {_RULE_SQL['null_island']} as null_island from raw"))
def _null_island(spark, sf_dir):
    return quality.violation_counts(fx.raw(spark, sf_dir, ("lat", "lon")))


@query("q6_report", fx.with_raw(
    "select rule, violations, total from (" + " union all ".join(
        f"select '{n}' as rule, {sql} as violations, count(*) as total from raw" for n, sql in _RULE_SQL.items())
    + ") where violations > 0"))
def _report(spark, sf_dir):
    return quality.quality_report(fx.raw(spark, sf_dir, _QUALITY_INPUTS))


@query("q6_flagged_rows", fx.with_raw(
    f"select dr_no, concat_ws(',', case when {_LATE} then 'reported_before_occurred' end, "
    "case when vict_age < 0 then 'negative_age' end, case when lat = 0 and lon = 0 then 'null_island' end) "
    "as failed from raw"))
def _flagged_rows(spark, sf_dir):
    rows = quality.flag_rows(fx.raw(spark, sf_dir, ("dr_no", *_QUALITY_INPUTS)))
    return rows.select("dr_no", F.concat_ws(",", "failed_rules").alias("failed"))


# ---------------------------------------------------------------- tops, samples, lists
@query("o1_top_label", star_sql(
    f"select da.area_name {_STAR} {_where(ONLY_DATES)} group by 1 order by count(*) desc, 1 nulls last limit 1"))
def _top_label(spark, sf_dir):
    star = stores.star(spark, sf_dir)
    by_code = ranking.group_counts(filtered_fact(star, ONLY_DATES), "area_id")
    counts = with_labels(star, by_code, ["area"]).groupBy("area_name").agg(F.sum("n").alias("n"))
    return ranking.top_label(counts, "area_name")


@query("o2_recent_rows", fx.with_fact(
    "select dr_no, date_occ from fact order by date_occ desc nulls last, dr_no limit 1000"))
def _recent_rows(spark, sf_dir):
    return ranking.newest_rows(stores.fact(spark, sf_dir).select("dr_no", "date_occ"), "date_occ", "dr_no", 1000)


@query("o4_options", star_sql("select distinct crm_cd_desc from dim_crime"))
def _options(spark, sf_dir):
    return ranking.options(stores.star(spark, sf_dir).crime, "crm_cd_desc")


_HASH = "cast('0x' || substr(md5(f.dr_no), 1, 8) as bigint) % 100 < 10"


@query("x1_hash_sample", fx.with_fact(f"select dr_no, lat, lon from fact f where {_HASH}"))
def _hash_sample(spark, sf_dir):
    return hash_sample(stores.fact(spark, sf_dir)).select("dr_no", "lat", "lon")


@query("x1_bernoulli")
def _bernoulli(spark, sf_dir):
    return bernoulli_sample(stores.fact(spark, sf_dir), 0.1, seed=42).select("dr_no", "lat", "lon")


# ---------------------------------------------------------------- dashboard
def _top_sql(label: str, chosen: StarFilter) -> str:
    return (
        f"(select case when count(*) = 0 then '-' else min_by(l, {{'n': -n, 'z': l is null, 'l': l}}) end from "
        f"(select {label} as l, count(*) as n {_STAR} {_where(chosen)} group by 1))"
    )


def _kpi_sql(chosen: StarFilter) -> str:
    return star_sql(
        f"select count(*) as total, avg(f.vict_age) as avg_age, {_top_sql('da.area_name', chosen)} as top_area, "
        f"{_top_sql('dw.weapon_desc', chosen)} as top_weapon {_STAR} {_where(chosen)}")


def _kpis(name: str, chosen: StarFilter) -> None:
    @query(name, _kpi_sql(chosen))
    def _run(spark, sf_dir):
        return dashboard.kpis(stores.star(spark, sf_dir), chosen)


_kpis("d1_kpi", ONLY_DATES)
_kpis("d1_kpi_filtered", SOME_LISTS)
_kpis("d1_kpi_empty", StarFilter(START, END, areas=("no such area",)))


@query("d2_map_points", star_sql(
    f"select f.lat, f.lon, da.area_name, dc.crm_cd_desc {_STAR} {_where(SOME_LISTS)} and f.lat <> 0 and f.lon <> 0 "
    f"and {_HASH}"))
def _map_points(spark, sf_dir):
    return dashboard.map_points(stores.star(spark, sf_dir), SOME_LISTS, repeatable=True)


@query("d3_trend", star_sql(
    "select date_occ, n, avg(n) over (order by date_occ rows between 6 preceding and current row) as ma from "
    f"(select f.date_occ, count(*) as n {_STAR} {_where(ONLY_DATES)} group by 1)"))
def _trend(spark, sf_dir):
    return dashboard.trend(stores.star(spark, sf_dir), ONLY_DATES)


@query("d4_preview", star_sql(
    f"select f.dr_no, f.date_occ, da.area_name, dc.crm_cd_desc, dw.weapon_desc, ds.status_desc {_STAR5} "
    f"{_where(SOME_LISTS)} order by f.date_occ desc, f.dr_no limit 1000"))
def _preview(spark, sf_dir):
    return dashboard.preview(stores.star(spark, sf_dir), SOME_LISTS)


@query("d5_filter_options", star_sql(
    "select 'first_day' as option, cast(min(date_occ) as varchar) as value from fact union all "
    "select 'last_day', cast(max(date_occ) as varchar) from fact union all "
    "select 'area', area_name from (select distinct area_name from dim_area) union all "
    "select 'crime', crm_cd_desc from (select distinct crm_cd_desc from dim_crime) union all "
    "select 'weapon', weapon_desc from (select distinct weapon_desc from dim_weapon where weapon_desc is not null) "
    "union all select 'premise', premis_desc from "
    "(select distinct premis_desc from dim_premise where premis_desc is not null)"))
def _filter_options(spark, sf_dir):
    return dashboard.filter_options(stores.star(spark, sf_dir))


_LATEST = (
    "latest as (select model_name, created_at, mae, rmse, training_rows from (select *, row_number() over "
    "(partition by model_name order by created_at desc) as rn from metrics) where rn = 1)"
)


@query("w5_latest_per_group", f"with {fx.METRICS_SQL}, {_LATEST} select * from latest")
def _latest_per_group(spark, sf_dir):
    return dashboard.latest_metrics(fx.metrics(spark, sf_dir))


@query("d6_latest_metrics", f"with {fx.METRICS_SQL}, {_LATEST} select model_name, printf('%.2f', mae) as mae, "
       "printf('%.2f', rmse) as rmse, training_rows, strftime(created_at, '%Y-%m-%d %H:%M') as created_at from latest")
def _metrics_table(spark, sf_dir):
    return dashboard.metrics_table(dashboard.latest_metrics(fx.metrics(spark, sf_dir)))


@query("u3_unpivot_metrics", f"with {fx.METRICS_SQL} select model_name, created_at, 'mae' as metric, mae as error_value "
       "from metrics union all select model_name, created_at, 'rmse', rmse from metrics")
def _metric_rows(spark, sf_dir):
    return ranking.metric_rows(fx.metrics(spark, sf_dir))


@query("m15_champion", f"with {fx.METRICS_SQL}, {_LATEST} select model_name as champion from latest "
       "order by mae, rmse, model_name limit 1")
def _champion(spark, sf_dir):
    return dashboard.champion(dashboard.latest_metrics(fx.metrics(spark, sf_dir)))


@query("p30_dashboard_texts", _kpi_sql(ONLY_DATES).replace(
    "select count(*) as total, avg(f.vict_age) as avg_age,",
    "select format('{:,}', count(*)) as total_cases, "
    "concat(cast(cast(round_even(coalesce(avg(f.vict_age), 0), 0) as int) as varchar), ' Yrs') as avg_age,"
).replace(" as top_area", " as hotspot").replace(
    _top_sql("dw.weapon_desc", ONLY_DATES) + " as top_weapon",
    f"substr({_top_sql('dw.weapon_desc', ONLY_DATES)}, 1, 15) || '...' as top_weapon"))
def _kpi_texts(spark, sf_dir):
    return dashboard.kpi_texts(dashboard.kpis(stores.star(spark, sf_dir), ONLY_DATES))
