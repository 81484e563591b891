"""Staging -> star schema: seven dimensions and one fact, insert-only, all or nothing."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import scalars as X
from caseloom.operators.merge import (
    first_label_per_code,
    first_per_key,
    insert_if_absent,
    orphan_counts,
    require_no_orphans,
)
from caseloom.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNKNOWN_MEMBERS
from caseloom.sources.store import Commit, Store


# ---------------------------------------------------------------- rows a batch brings
def _spellings(staging: DataFrame, *columns: str) -> DataFrame:
    """Distinct raw values with their ``_rows``, found by hashing on the map side."""
    return staging.groupBy(*columns).agg(F.count("*").alias("_rows"))


def _once_each(value: F.Column) -> F.Column:
    """A reading of ``_spellings``: asking for ``_rows`` keeps Spark from moving it, or a filter on it, back to every row."""
    return F.when(F.col("_rows") > 0, value)


def _coded_dimension(code: str, label: str) -> Callable[[DataFrame, bool], DataFrame]:
    def rows(staging: DataFrame, strict: bool = False) -> DataFrame:
        typed = _spellings(staging.where(F.col(code).isNotNull()), code, label).select(
            _once_each(X.canonical_code(F.col(code), strict)).alias(code), F.col(label).cast("string").alias(label)
        )
        return first_label_per_code(typed.where(F.col(code).isNotNull()), code, label)

    return rows


def status_rows(staging: DataFrame, strict: bool = False) -> DataFrame:
    typed = staging.where("status_id IS NOT NULL").select(
        F.trim("status_id").alias("status_id"), F.col("status_desc").cast("string").alias("status_desc")
    )
    return first_label_per_code(typed, "status_id", "status_desc")


def date_rows(staging: DataFrame, strict: bool = False) -> DataFrame:
    days = staging.select(X.date_of(staging, "date_occ").alias("date_id")).where("date_id IS NOT NULL")
    return days.distinct().select("date_id", *X.date_parts(F.col("date_id")))


def time_rows(staging: DataFrame, strict: bool = False) -> DataFrame:
    codes = _spellings(staging, "time_occ").select(_once_each(X.half_even_int(F.col("time_occ"), strict)).alias("time_id"))
    hour = X.hour_of_code(F.col("time_id"))
    distinct = codes.where("time_id IS NOT NULL").distinct()
    return distinct.select("time_id", hour.alias("hour"), X.time_of_day(hour).alias("time_of_day"))


def typed_facts(staging: DataFrame, strict: bool = False) -> DataFrame:
    """The fact projection of every staging row that has a record number."""

    def code(name: str, member: str) -> F.Column:
        return X.or_unknown(X.canonical_code(F.col(name), strict), member).alias(name)

    return staging.where("dr_no IS NOT NULL").select(
        F.trim(F.col("dr_no").cast("string")).alias("dr_no"),
        X.date_of(staging, "date_occ").alias("date_occ"),
        X.half_even_int(F.col("time_occ"), strict).alias("time_occ"),
        code("area_id", UNKNOWN_MEMBERS["dim_area"][0]),
        code("crm_cd", UNKNOWN_MEMBERS["dim_crime"][0]),
        X.or_unknown(F.trim("status_id"), UNKNOWN_MEMBERS["dim_status"][0]).alias("status_id"),
        code("premis_id", UNKNOWN_MEMBERS["dim_premise"][0]),
        code("weapon_id", UNKNOWN_MEMBERS["dim_weapon"][0]),
        *[X.double_of(staging, c, strict).alias(c) for c in ("lat", "lon", "vict_age")],
    )


def fact_rows(staging: DataFrame, strict: bool = False) -> DataFrame:
    return first_per_key(typed_facts(staging, strict), "dr_no")


# Table -> rows of a staging batch, unique on the table's key.
BATCH_ROWS: dict[str, Callable[[DataFrame, bool], DataFrame]] = {
    "dim_area": _coded_dimension("area_id", "area_name"),
    "dim_crime": _coded_dimension("crm_cd", "crm_cd_desc"),
    "dim_status": status_rows,
    "dim_premise": _coded_dimension("premis_id", "premis_desc"),
    "dim_weapon": _coded_dimension("weapon_id", "weapon_desc"),
    "dim_date": date_rows,
    "dim_time": time_rows,
    "fact_crime": fact_rows,
}


def unknown_members(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([UNKNOWN_MEMBERS[table]], TABLES[table])


def rejects(staging: DataFrame) -> DataFrame:
    """One row: per numeric column, how many non-blank texts are no numbers of its kind (codes and times are whole numbers
    of 32 bits) and so were read as NULL or the unknown member."""
    codes = ("area_id", "crm_cd", "premis_id", "weapon_id")
    names = (*codes, "time_occ", "lat", "lon", "vict_age")

    def bad(name: str) -> F.Column:
        text = F.trim(F.col(name).cast("string"))
        if name in codes:
            read = X.canonical_code(F.col(name), False)
        else:
            read = X.half_even_int(F.col(name), False) if name == "time_occ" else X.double_of(staging, name)
        return F.count_if((text != "") & read.isNull()).alias(name)

    present = [n for n in names if n in staging.columns]
    day = F.count_if(F.col("date_occ").isNotNull() & X.date_of(staging, "date_occ").isNull())
    return staging.agg(*[bad(n) for n in present], day.alias("date_occ"))


# ---------------------------------------------------------------- the load
def create_store(spark: SparkSession, root: str) -> Store:
    """A store holding the unknown members; an existing one is returned as it is."""
    store = Store(spark, root)
    if not store.commits():
        number, load = store.new_load()
        rows = _side_by_side(
            {t: lambda t=t: store.write(t, load, unknown_members(spark, t).coalesce(1)) for t in UNKNOWN_MEMBERS}
        )
        store.commit(number, load, rows, batch="unknown members")
    return store


def new_rows(store: Store, table: str, staging: DataFrame, strict: bool = False) -> DataFrame:
    """Rows the batch adds to a table: first of each key, keys the table holds left out.

    A table without rows holds no keys: nothing is compared then, and the batch is worked out once."""
    batch = BATCH_ROWS[table](staging, strict)
    if not store.holds(table):
        return batch
    return insert_if_absent(store.table(table), batch, PRIMARY_KEYS[table])


def merge_staging(
    store: Store,
    staging: DataFrame,
    batch: str | None = None,
    strict: bool = False,
    check_orphans: bool = False,
) -> Commit:
    """Merge one staging batch into all eight tables under one commit.

    ``staging`` should be a stored table: each dimension then scans just its own two columns of it.
    The eight writes are independent jobs and run side by side, so small dimension jobs fill the
    executors the fact job leaves idle.  A batch id that was committed before adds nothing, which
    makes replays after a lost driver harmless.
    """
    if batch is not None:
        for commit in store.commits():
            if commit.batch == batch:
                return commit
    number, load = store.new_load()

    def write(table: str) -> int:
        return store.write(table, load, new_rows(store, table, staging, strict))

    # The fact, by far the longest job, is submitted first; unreadable values are counted beside it.
    jobs = {t: lambda t=t: write(t) for t in reversed(BATCH_ROWS)}
    counts = _side_by_side({**jobs, "rejects": lambda: rejects(staging).first().asDict()})
    unread = {c: n for c, n in counts.pop("rejects").items() if n}

    if check_orphans:
        dimensions = {
            t: store.table(t).unionByName(store.loaded(t, [load])) for t, _ in FOREIGN_KEYS.values()
        }
        require_no_orphans(orphan_counts(store.loaded("fact_crime", [load]), dimensions, FOREIGN_KEYS))
    return store.commit(number, load, counts, batch, unread)


def _side_by_side(actions: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Results of Spark actions run concurrently; a failure is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        running = {name: pool.submit(action) for name, action in actions.items()}
    return {name: done.result() for name, done in running.items()}
