"""Files in, star schema out: the end-to-end jobs over the whole raw input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.plans import flows, snapshot
from caseloom.plans.warehouse import create_store
from caseloom.schemas import TABLES
from caseloom.session import configured, ship_package, small_splits, sweep, work_path
from caseloom.sources import headers as H
from caseloom.sources import lake
from caseloom.sources.registry import ModelRegistry, append_audit, error_log, read_audit
from caseloom.sources.store import Store
from caseloom.streaming.incremental import ingest_new_files, quarantined
from caseloom.workload import fixture as fx
from caseloom.workload import stores
from caseloom.workload.column_queries import DAILY_SPELLING, HISTORICAL_SPELLING, RESEARCH_SPELLING, spelled
from caseloom.workload.registry import query
from caseloom.workload.series_queries import AT, days_sql

# The daily path truncates codes where the warehouse rounds; on whole-number codes both agree.
_FACT = fx.with_fact("select * from fact")


# Extracts repeat their headers and labels in every record: packed they take a fraction of the disk for little time.
EXTRACT_PACKED = "snappy"
PACKED = "gzip"  # of JSON arrays, by far the largest files and split in no case: under half of that again


def _daily_lake(spark, sf_dir) -> str:
    """A lake holding the raw input as one JSON extract with daily headers, text values only."""
    raw = fx.raw(spark, sf_dir)
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    folder = work_path(spark, "lake")
    lake.land_extract(spelled(texts, DAILY_SPELLING), folder, "incident_extract", AT, EXTRACT_PACKED)
    return folder


_loaded: dict[tuple[str, str, str], Store] = {}


def _once(kind: str):
    """A load that runs once per application and data set for all queries that look at its tables."""

    def decorate(load):
        def run(spark, sf_dir) -> Store:
            key = (spark.sparkContext.applicationId, sf_dir, kind)
            if key not in _loaded:
                _loaded[key] = load(spark, sf_dir)
            return _loaded[key]

        return run

    return decorate


def _dimensions(store: Store):
    return fx.stacked({t: store.table(t) for t in fx.DIM_PARTS})


_ALL_DIMENSIONS = fx.with_fact(fx.stacked_sql(), *fx.DIM_SQL)


@_once("daily")
def _daily_store(spark, sf_dir) -> Store:
    store = create_store(spark, work_path(spark, "warehouse"))
    flows.daily_load(spark, _daily_lake(spark, sf_dir), work_path(spark, "staging"), store)
    return store


@query("e1_daily", _FACT)
def _daily(spark, sf_dir):
    return _daily_store(spark, sf_dir).table("fact_crime").drop("occ_year")


@query("e1_dimensions", _ALL_DIMENSIONS)
def _daily_dimensions(spark, sf_dir):
    return _dimensions(_daily_store(spark, sf_dir))


def _csv(spark, rows, path: str, compression: str = EXTRACT_PACKED) -> str:
    writer = rows.write.option("header", True).option("escape", '"').option("compression", compression)
    # Blanks around a value are part of the raw data.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@_once("historical")
def _historical_store(spark, sf_dir) -> Store:
    path = _csv(spark, spelled(fx.raw(spark, sf_dir), HISTORICAL_SPELLING), work_path(spark, "history.csv"))
    store = create_store(spark, work_path(spark, "warehouse"))
    flows.historical_load(spark, path, work_path(spark, "staging"), store)
    return store


@query("e2_historical", _FACT)
def _historical(spark, sf_dir):
    return _historical_store(spark, sf_dir).table("fact_crime").drop("occ_year")


@query("e2_dimensions", _ALL_DIMENSIONS)
def _historical_dimensions(spark, sf_dir):
    return _dimensions(_historical_store(spark, sf_dir))


@query("l9_dimensions", _ALL_DIMENSIONS)
def _stored_dimensions(spark, sf_dir):
    return _dimensions(stores.incident_store(spark, sf_dir))


_DAY = fx.date_sql("date_occ")


_RESEARCH_ROWS = (
    f"from (select * replace ({_DAY} as date_occ) from raw) where date_occ <= date '{fx.CUTOFF}' and lat <> 0 "
    "and lon <> 0 and vict_age > 0 and vict_sex in ('M', 'F', 'X')"
)


@query("e3_research", fx.with_raw(
    f"select dr_no, date_occ, lat, lon, vict_sex, case when vict_age > 80 then 80 else vict_age end as vict_age, "
    "cast(substr(lpad(cast(cast(trunc(try_cast(time_occ as double)) as int) as varchar), 4, '0'), 1, 2) as int) as hour "
    + _RESEARCH_ROWS))
def _research(spark, sf_dir):
    rows = _research_table(spark, sf_dir)
    return rows.select("dr_no", F.to_date("date_occ").alias("date_occ"), "lat", "lon", "vict_sex", "vict_age", "hour")


def _research_table(spark, sf_dir):
    folder = work_path(spark, "lake")
    _csv(spark, spelled(fx.raw(spark, sf_dir), RESEARCH_SPELLING), f"{folder}/history.csv")
    return flows.research_load(spark, folder, work_path(spark, "research"), "history.csv", fx.CUTOFF)


def _scored(models):
    """Metrics in a form that does not depend on the fitted values: are they the errors of the stored forecasts, worked out
    again, and is there one forecast for each of the last 90 days?"""
    again = models.holdout().groupBy("model_name", "created_at").agg(
        F.expr("avg(abs(y - yhat))").alias("mae2"), F.expr("sqrt(avg((y - yhat) * (y - yhat)))").alias("rmse2"), F.count_distinct("ds").alias("days"))
    both = models.metrics().join(again, ["model_name", "created_at"], "left")
    same = (F.abs(F.col("mae") - F.col("mae2")) < 1e-9) & (F.abs(F.col("rmse") - F.col("rmse2")) < 1e-9) & (F.col("mae") > 0) & (F.col("days") == 90)
    return both.select("model_name", "training_rows", F.coalesce(same, F.lit(False)).alias("scored"))


def _days_until(day) -> str:
    condition = "" if day is None else f" where ds <= date '{day}'"
    return f"(select cast(count(*) as int) from days{condition})"


_UNCUT, _CUT = _days_until(None), _days_until(fx.CUTOFF)


@query("e4_end_to_end", days_sql(
    f"select '{flows.CHAMPION}' as model_name, {_days_until(fx.AS_OF - timedelta(1))} as training_rows, "
    "false as scored"))
def _end_to_end(spark, sf_dir):
    models = ModelRegistry(spark, work_path(spark, "models"))
    store = create_store(spark, work_path(spark, "warehouse"))
    flows.end_to_end(
        spark, _daily_lake(spark, sf_dir), work_path(spark, "staging"), store, models, fx.AS_OF, AT)
    return _scored(models)


@query("e5_training", days_sql(
    f"select '{flows.CHAMPION}' as model_name, {_CUT} as training_rows, true as scored union all " + " union all ".join(
        f"select '{name}', {_CUT if cut else _UNCUT}, true" for name, (_, cut) in flows.VARIANTS.items())))
def _training(spark, sf_dir):
    models = ModelRegistry(spark, work_path(spark, "models"))
    series = flows.fact_series(stores.incident_store(spark, sf_dir))
    flows.weekly_training(series, models, AT, fx.CUTOFF)
    return _scored(models)


@query("e6_research_training", fx.with_raw(" union all ".join(
    f"select '{name}' as model_name, (select cast(count(distinct date_occ) as int) {_RESEARCH_ROWS}) as training_rows, "
    "true as scored" for name in flows.RESEARCH_VARIANTS)))
def _research_training(spark, sf_dir):
    models = ModelRegistry(spark, work_path(spark, "models"))
    flows.research_training(_research_table(spark, sf_dir), models, AT)
    return _scored(models)


# ---------------------------------------------------------------- mixed formats
SHARES = 4
FILES = 8  # files of a quarter of the records
ARRAY_RECORDS = 100_000  # records of a JSON array: Spark reads an array whole, so more records make more files, not longer arrays


@_once("sources")
def _sources(spark, sf_dir):
    """What the raw input is made of and the share of each record number, written once and read back for each share."""
    share = F.pmod(F.xxhash64(F.trim(_number_of_sources())), F.lit(SHARES))
    # A task keeps a file open for each share instead of sorting its rows by them.
    with small_splits(spark), configured(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(SHARES)}):
        stored = lake.replace_table(fx.sources(spark, sf_dir).withColumn("share", share), work_path(spark, "sources"), "share")
    sweep(spark)
    return stored


def _texts(sources: DataFrame) -> DataFrame:
    """The raw input with daily headers, text values only."""
    return spelled(sources.select(*[fx.raw_column(c).cast("string").alias(c) for c in fx.RAW_COLUMNS]), DAILY_SPELLING)


def _number_of_sources() -> Column:
    return fx.raw_column("dr_no").cast("string")


def _number() -> Column:
    return F.col(DAILY_SPELLING.get("dr_no", "dr_no"))


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one JSON array of all records of a partition, which pass one batch at a time."""
    begun = False
    for batch in batches:
        records = batch.column(0)
        if not len(records):
            continue
        if not begun:
            yield _lines(pa.array(["["]))
            yield _lines(records[:1])
            records = records[1:]
        begun = True
        yield _lines(pc.binary_join_element_wise("", records, ","))
    if begun:
        yield _lines(pa.array(["]"]))


def _lines(values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values], names=["value"])


def _land_share(
    spark, rows, share: int, folder: str, number: Column | None = None, texts: Callable[[DataFrame], DataFrame] | None = None
) -> int:
    """A quarter of the records as JSON lines, JSON arrays, CSV, or gzipped CSV with its columns the other way round, all rows
    of a record number in one file.  Returns the number of files; only that of arrays grows with the records.

    ``rows`` are texts, or rows with that ``number`` which ``texts`` turns into texts after they have met in their file."""
    rows = rows.where(F.col("share") == share).drop("share")
    files = FILES if share != 1 else max(FILES, -(-rows.count() // ARRAY_RECORDS))
    rows = rows.repartition(files, F.trim(_number() if number is None else number))
    rows = rows if texts is None else texts(rows)
    with small_splits(spark):
        if share == 0:
            rows.write.option("compression", EXTRACT_PACKED).json(f"{folder}/lines.json")
        elif share == 1:
            ship_package(spark)
            arrays = rows.select(F.to_json(F.struct(*rows.columns)).alias("record")).mapInArrow(_as_array, "value string")
            arrays.write.mode("append").option("compression", PACKED).text(f"{folder}/array.json")
        elif share == 2:
            _csv(spark, rows, f"{folder}/plain.csv", compression="none")
        else:
            columns = rows.columns[::-1]
            _csv(spark, rows.select(*columns), f"{folder}/turned.csv", compression="gzip")
    sweep(spark)
    return files


def _land_sources(spark, sources, share: int, folder: str, of: int | None = None) -> int:
    """One share of the records in its form, or the share ``of`` in the form of ``share``."""
    if of is not None:
        sources = sources.where(F.col("share") == of).withColumn("share", F.lit(share))
    return _land_share(spark, sources, share, folder, _number_of_sources(), _texts)


@query("s4_mixed_lake", fx.with_raw(
    "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in fx.RAW_COLUMNS if c not in fx.DOUBLES) + " from raw"))
def _mixed_lake(spark, sf_dir):
    """One lake object of JSON lines, JSON arrays and two kinds of CSV, read back by column name."""
    folder = work_path(spark, "mixed")
    sources = _sources(spark, sf_dir)
    for share in range(SHARES):
        _land_sources(spark, sources, share, folder)
    read = lake.read_lake(spark, folder)
    return H.map_columns(read, {DAILY_SPELLING.get(c, c): c for c in fx.RAW_COLUMNS if c not in fx.DOUBLES})


@query("s1_json_array", fx.with_raw("select area_id, count(*) as n, count(distinct dr_no) as numbers from raw group by 1"))
def _json_array(spark, sf_dir):
    """All raw incidents as JSON arrays, one per file.  They land a share at a time: the shuffle files of one lie on disk, not of all."""
    folder = work_path(spark, "arrays")
    for share in range(SHARES):
        _land_sources(spark, _sources(spark, sf_dir), 1, folder, of=share)
    read = H.map_columns(lake.read_lake(spark, f"{folder}/array.json"), {DAILY_SPELLING.get(c, c): c for c in fx.RAW_COLUMNS})
    return read.groupBy("area_id").agg(F.count("*").alias("n"), F.count_distinct("dr_no").alias("numbers"))


@_once("streamed")
def _streamed_store(spark, sf_dir) -> Store:
    """All raw incidents arrive as files of four kinds; two runs of the stream, with several batches each, load each file once."""
    sources, folder = _sources(spark, sf_dir), work_path(spark, "lake")
    store = create_store(spark, work_path(spark, "warehouse"))
    places = [work_path(spark, name) for name in ("staging", "checkpoint", "quarantine")]
    for shares in ((0, 2), (1, 3)):
        landed = sum(_land_sources(spark, sources, share, folder) for share in shares)
        per_batch = -(-landed * 6 // (2 * FILES))  # 6 of 16 files; of more files the same share
        ingest_new_files(spark, folder, store, *places, files_per_batch=per_batch).awaitTermination()
    if not quarantined(spark, places[-1]).isEmpty():
        raise ValueError("records of the test tables were set aside")
    return store


@query("st1_incremental", _FACT)
def _incremental(spark, sf_dir):
    return _streamed_store(spark, sf_dir).table("fact_crime").drop("occ_year")


@query("st1_members", fx.with_fact(f"select table_name, member from ({fx.stacked_sql()})", *fx.DIM_SQL))
def _incremental_members(spark, sf_dir):
    """Members of the seven dimensions; which label a code keeps depends on the batch that brings it first."""
    return _dimensions(_streamed_store(spark, sf_dir)).select("table_name", "member")


# ---------------------------------------------------------------- audit and snapshots
@query("s17_error_log_view", f"with {fx.AUDIT_SQL} select ts, flow, task, log_url, error_message as error_details "
       "from audit where status = 'FAILED'")
def _error_log(spark, sf_dir):
    path = work_path(spark, "audit")
    append_audit(fx.audit(spark, sf_dir), path)
    return error_log(read_audit(spark, path))


@query("s16_audit_summary", f"with {fx.AUDIT_SQL} select flow, task, status, count(*) as runs, "
       "count(*) filter (where error_message <> '') as with_message from audit group by 1, 2, 3")
def _audit_summary(spark, sf_dir):
    path = work_path(spark, "audit")
    append_audit(fx.audit(spark, sf_dir), path)
    return read_audit(spark, path).groupBy("flow", "task", "status").agg(
        F.count("*").alias("runs"), F.count_if(F.col("error_message") != "").alias("with_message"))


_snapshots: dict[tuple[str, str], tuple[str, ModelRegistry, Store, ModelRegistry]] = {}


def _restored(spark, sf_dir) -> tuple[str, ModelRegistry, Store, ModelRegistry]:
    """Snapshot of the loaded store and a trained model, and the store and registry restored from it; once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _snapshots:
        store = stores.incident_store(spark, sf_dir)
        models = ModelRegistry(spark, work_path(spark, "models"))
        flows.train_champion(flows.fact_series(store), models, AT, fx.CUTOFF)
        folder = flows.snapshot_store(store, models, work_path(spark, "snapshots"), AT)
        _snapshots[key] = (folder, models, *flows.restore_store(spark, folder, work_path(spark, "restored")))
    return _snapshots[key]


@query("s18_snapshot", fx.with_fact(
    "select 'fact_crime' as name, count(*) as rows from fact union all " + " union all ".join(
        f"select '{t}', count(*) from {t}" for t in fx.DIM_SQL)
    + " union all select * from (values ('model_registry', 1), ('model_metrics', 1), ('model_holdout', 90))", *fx.DIM_SQL))
def _snapshot(spark, sf_dir):
    folder = _restored(spark, sf_dir)[0]
    return snapshot.read_manifest(spark, folder).select(F.col("table").alias("name"), "rows")


@query("s18_checksums", "select unnest([" + ", ".join(f"'{t}'" for t in TABLES) + "]) as name, true as equal")
def _checksums(spark, sf_dir):
    """Does every restored table have the checksum that the manifest holds?"""
    folder, _, store, _ = _restored(spark, sf_dir)
    found = [snapshot.fingerprint(store.table(t)).select(F.lit(t).alias("name"), "rows", "checksum") for t in TABLES]
    expected = snapshot.read_manifest(spark, folder).withColumnRenamed("table", "name").withColumn("equal", F.lit(True))
    return reduce(DataFrame.unionByName, found).join(expected, ["name", "rows", "checksum"], "left").select(
        "name", F.coalesce("equal", F.lit(False)).alias("equal"))


@query("s19_restore", _FACT)
def _restore(spark, sf_dir):
    return _restored(spark, sf_dir)[2].table("fact_crime").drop("occ_year")


@query("s19_dimensions", _ALL_DIMENSIONS)
def _restored_dimensions(spark, sf_dir):
    return _dimensions(_restored(spark, sf_dir)[2])


@query("s19_model", f"select cast(d as date) as ds, true as equal from unnest(generate_series(date '{fx.AS_OF}', "
       f"date '{fx.AS_OF + timedelta(89)}', interval 1 day)) t(d)")
def _restored_model(spark, sf_dir):
    """90 days served by the stored and by the restored champion."""
    _, models, _, restored = _restored(spark, sf_dir)
    one, other = (flows.forecast_for(m, flows.CHAMPION, fx.AS_OF).select("ds", F.col("yhat").alias(n)) for m, n in ((models, "a"), (restored, "b")))
    return one.join(other, "ds").select("ds", (F.col("a") == F.col("b")).alias("equal"))
