"""Loading the star schema: dimensions, fact, merges, referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.merge import merged, orphan_counts
from caseloom.plans import warehouse
from caseloom.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNKNOWN_MEMBERS
from caseloom.session import work_path
from caseloom.workload import fixture as fx
from caseloom.workload import stores
from caseloom.workload.registry import query

# table -> raw columns its rows are made of
_INPUTS = {
    "dim_area": ("area_id", "area_name"),
    "dim_crime": ("crm_cd", "crm_cd_desc"),
    "dim_status": ("status_id", "status_desc"),
    "dim_premise": ("premis_id", "premis_desc"),
    "dim_weapon": ("weapon_id", "weapon_desc"),
    "dim_date": ("date_occ",),
    "dim_time": ("time_occ",),
}


def _first_load(table: str):
    """Unknown members merged with the rows of the whole raw input."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        batch = warehouse.BATCH_ROWS[table](fx.raw(spark, sf_dir, _INPUTS[table]), False)
        if table not in UNKNOWN_MEMBERS:
            return batch
        return merged(warehouse.unknown_members(spark, table), batch, PRIMARY_KEYS[table])

    return run


for _n, _table in enumerate(_INPUTS, start=1):
    query(f"l{_n}_{_table}", fx.with_raw(fx.DIM_SQL[_table]))(_first_load(_table))


@query("l8_fact", fx.with_fact("select * from fact"))
def _fact(spark, sf_dir):
    needed = fx.FACT_COLUMNS
    return warehouse.fact_rows(fx.raw(spark, sf_dir, needed))


@query("l9_stored_fact", fx.with_fact("select * from fact"))
def _stored_fact(spark, sf_dir):
    """The fact as the stored, committed warehouse serves it."""
    return stores.fact(spark, sf_dir).drop("occ_year")


@query("l9_rejects", fx.with_raw(
    "select 'crm_cd' as name, count(*) as n from raw where trim(crm_cd_desc) <> '' union all "
    "select 'premis_id', count(*) from raw where premis_id like '1%' union all "
    "select 'date_occ', count(*) from raw where date_occ is not null and area_id like '1%'"))
def _rejects(spark, sf_dir):
    """What a load's commit says of values it could not read: texts as codes, codes beyond 32 bits, days that are none."""
    broken = stores.staging_table(spark, sf_dir).withColumns({
        "crm_cd": F.col("crm_cd_desc"),
        "premis_id": F.expr("case when premis_id like '1%' then concat('9', lpad(substr(premis_id, 1, 3), 12, '0')) else premis_id end"),
        "date_occ": F.expr("case when date_occ is not null and area_id like '1%' then concat('no day ', date_occ) else date_occ end"),
    })
    commit = warehouse.merge_staging(warehouse.create_store(spark, work_path(spark, "rejects")), broken)
    return spark.createDataFrame(list(commit.rejects.items()), "name string, n long")


# Two batches: even supplier numbers first, then all the others; keys occurring in both keep the
# row of the first batch.
_EVEN = "cast(substr(premis_id, length(premis_id) - 2, 1) as int) % 2 = 1"
_BATCH_SQL = {
    "b1": fx.first_sql(fx.typed_sql(f"(select * from raw where {_EVEN})")),
    "b2": fx.first_sql(fx.typed_sql(f"(select * from raw where not ({_EVEN}))")),
}


@query(
    "l9_second_batch",
    f"with {fx.RAW_SQL}, b1 as ({_BATCH_SQL['b1']}), b2 as ({_BATCH_SQL['b2']}) "
    "select * from b1 union all select * from b2 where dr_no not in (select dr_no from b1)",
)
def _second_batch(spark, sf_dir):
    staging = stores.staging_table(spark, sf_dir)
    store = warehouse.create_store(spark, work_path(spark, "two-batches"))
    warehouse.merge_staging(store, staging.where(F.expr(_EVEN)), batch="even suppliers")
    warehouse.merge_staging(store, staging.where(~F.expr(_EVEN)), batch="odd suppliers")
    return store.table("fact_crime").drop("occ_year")


@query(
    "j5_insert_if_absent",
    f"with {fx.RAW_SQL}, b1 as (select trim(dr_no) as dr_no, min(vict_age) as vict_age from raw where {_EVEN} "
    f"group by 1), b2 as (select trim(dr_no) as dr_no, min(vict_age) as vict_age from raw where not ({_EVEN}) "
    "group by 1) select * from b1 union all select * from b2 where dr_no not in (select dr_no from b1)",
)
def _insert_if_absent(spark, sf_dir):
    raw = fx.raw(spark, sf_dir, ("dr_no", "premis_id", "vict_age"))

    def first(part: DataFrame) -> DataFrame:
        return part.groupBy(F.trim("dr_no").alias("dr_no")).agg(F.min("vict_age").alias("vict_age"))

    return merged(first(raw.where(F.expr(_EVEN))), first(raw.where(~F.expr(_EVEN))), "dr_no")


@query(
    "w6_first_per_key",
    fx.with_raw(
        "select trim(dr_no) as dr_no, min(struct_pack(a := vict_age, b := lon)).a as vict_age, "
        "min(struct_pack(a := vict_age, b := lon)).b as lon from raw group by 1"
    ),
)
def _first_per_key(spark, sf_dir):
    from caseloom.operators.merge import first_per_key

    rows = fx.raw(spark, sf_dir, ("dr_no", "vict_age", "lon")).withColumn("dr_no", F.trim("dr_no"))
    return first_per_key(rows, "dr_no")


@query(
    "s21_unknown_members",
    fx.with_fact(
        "select u.dim, u.member, u.label, count(f.dr_no) as facts from (values "
        + ", ".join(
            f"('{t}', '{m}', '{label}')" for t, (m, label) in UNKNOWN_MEMBERS.items()
        )
        + ") u(dim, member, label) left join fact f on case u.dim when 'dim_area' then f.area_id "
        "when 'dim_crime' then f.crm_cd when 'dim_status' then f.status_id when 'dim_premise' then f.premis_id "
        "else f.weapon_id end = u.member group by 1, 2, 3"
    ),
)
def _unknown_members(spark, sf_dir):
    """Each seeded member with the number of facts that fell back on it."""
    store = stores.incident_store(spark, sf_dir)
    codes = {t: c for c, (t, _) in FOREIGN_KEYS.items()}
    counts = store.table("fact_crime").agg(
        *[F.count_if(F.col(codes[t]) == m).alias(t) for t, (m, _) in UNKNOWN_MEMBERS.items()]
    ).unpivot([], list(UNKNOWN_MEMBERS), "dim", "facts")
    members = None
    for t, (m, _) in UNKNOWN_MEMBERS.items():
        key, label = TABLES[t].names
        rows = store.table(t).where(F.col(key) == m).select(
            F.lit(t).alias("dim"), F.col(key).alias("member"), F.col(label).alias("label")
        )
        members = rows if members is None else members.unionByName(rows)
    return members.join(counts, "dim")


def _orphan_sql(column: str, dimension: str, key: str) -> str:
    return (
        f"select '{column}' as fk, cast({column} as varchar) as code, count(*) as facts from fact "
        f"where {column} is not null and {column} not in (select {key} from {dimension}_b1) group by 2"
    )


def _b1_dim_sql(table: str) -> str:
    return fx.DIM_SQL[table].replace("from raw", f"from (select * from raw where {_EVEN})")


@query(
    "j6_orphans",
    fx.with_fact(
        " union all ".join(_orphan_sql(c, t, k) for c, (t, k) in FOREIGN_KEYS.items()),
        **{f"{t}_b1": _b1_dim_sql(t) for t, _ in FOREIGN_KEYS.values()},
    ),
)
def _orphans(spark, sf_dir):
    """Whole fact against dimensions that know only the first of two batches."""
    first = stores.staging_table(spark, sf_dir).where(F.expr(_EVEN))
    dims = {}
    for table, _ in FOREIGN_KEYS.values():
        rows = warehouse.BATCH_ROWS[table](first, False)
        if table in UNKNOWN_MEMBERS:
            rows = merged(warehouse.unknown_members(spark, table), rows, PRIMARY_KEYS[table])
        dims[table] = rows
    return orphan_counts(stores.fact(spark, sf_dir), dims, FOREIGN_KEYS)
