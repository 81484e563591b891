from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from caseloom.plans import flows, research, snapshot
from caseloom.plans.warehouse import create_store
from caseloom.schemas import TABLES
from caseloom.sources.lake import EmptyInput
from caseloom.sources.registry import ModelRegistry, append_audit, audit_record, error_log, read_audit
from caseloom.streaming.incremental import ingest_new_files, quarantined

FIELDS = ["DR NO", "AREA", "Area Name", "Crm Cd", "Date Occ", "Time Occ", "Vict Age", "LAT", "LON"]


def record(number, day="2020-01-08T00:00:00.000", area="07"):
    return dict(zip(FIELDS, [str(number), area, f"Area {area}", "510.0", day, "2230", "30", "34.5", "-118.2"]))


def write(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, records)))


def test_daily_load_reads_the_newest_object(spark, tmp_path):
    import os

    lake = tmp_path / "lake"
    write(lake, "old.json", [record(1)])
    (lake / "new.json").write_text(json.dumps([record(2), record(3, "bad", "0")]))
    os.utime(lake / "old.json", (1, 1))
    store = create_store(spark, str(tmp_path / "w"))
    flows.daily_load(spark, str(lake), str(tmp_path / "staging"), store)
    rows = {r["dr_no"]: r for r in store.table("fact_crime").collect()}
    assert set(rows) == {"2", "3"}
    assert (rows["2"]["area_id"], rows["2"]["crm_cd"], rows["2"]["time_occ"]) == ("7", "510", 2230)
    assert rows["2"]["date_occ"] == date(2020, 1, 8)
    assert rows["3"]["date_occ"] is None and rows["3"]["area_id"] == "0"


def test_empty_inputs_stop_before_writing(spark, tmp_path):
    store = create_store(spark, str(tmp_path / "w"))
    with pytest.raises(EmptyInput):
        flows.daily_load(spark, str(tmp_path / "none"), str(tmp_path / "s"), store)
    write(tmp_path / "lake", "x.csv", [])
    (tmp_path / "lake" / "x.csv").write_text("DR NO,AREA\n")
    with pytest.raises(EmptyInput):
        flows.daily_load(spark, str(tmp_path / "lake"), str(tmp_path / "s"), store)
    assert not (tmp_path / "s").exists()


def test_historical_load_reports_and_loads(spark, tmp_path):
    csv = tmp_path / "history.csv"
    csv.write_text(
        "\ufeffDR_NO,Date Rptd,DATE OCC,TIME OCC,AREA,Part 1-2,Vict Age,Status,LAT,LON\n"
        "1,01/01/2020 12:00:00 AM,01/05/2020 12:00:00 AM,0930,07,2,-4,IC,0,0\n"
        "2,01/09/2020 12:00:00 AM,01/05/2020 12:00:00 AM,NA,08,1,x,,34.1,-118\n")
    store = create_store(spark, str(tmp_path / "w"))
    result = flows.historical_load(spark, str(csv), str(tmp_path / "staging"), store)
    assert sorted(r["rule"] for r in result.report.collect()) == [
        "negative_age", "null_island", "reported_before_occurred"]
    staged = spark.read.parquet(str(tmp_path / "staging"))
    assert len(staged.columns) == 25
    assert sorted(r["part_1_2"] for r in staged.collect()) == ["1", "2"]
    rows = {r["dr_no"]: r for r in store.table("fact_crime").collect()}
    assert rows["2"]["status_id"] == "XX" and rows["2"]["vict_age"] is None and rows["1"]["vict_age"] == -4.0


def test_refreshed_file_is_loaded_again(spark, tmp_path):
    csv, header = tmp_path / "history.csv", "DR_NO,DATE OCC,TIME OCC,AREA\n"
    store = create_store(spark, str(tmp_path / "w"))
    load = lambda: flows.historical_load(spark, str(csv), str(tmp_path / "staging"), store)
    csv.write_text(header + "1,01/05/2020,0930,07\n")
    first = load()
    load()  # the same file again adds nothing
    assert store.table("fact_crime").count() == 1
    csv.write_text(header + "1,01/05/2020,0930,08\n2,01/06/2020,1000,09\n")
    load()
    rows = {r["dr_no"]: r["area_id"] for r in store.table("fact_crime").collect()}
    assert rows == {"1": "7", "2": "9"}
    assert {r["area_id"] for r in store.table("dim_area").collect()} == {"0", "7", "8", "9"}
    assert store.table("dim_date").count() == 2 and store.table("dim_time").count() == 2
    assert first.report.count() >= 0  # values, not a plan over staging that a later load overwrites


def test_research_rules(spark, tmp_path):
    columns = "drno string, dateocc string, lat string, lon string, `Vict-Age` string, victsex string, ` Extra ` string"
    rows = [
        ("keep", "2023-12-31", "34.1", "-118", "95", "F", "e"),
        ("late", "2023-12-31 00:01:00", "34.1", "-118", "30", "F", "e"),
        ("nodate", "x", "34.1", "-118", "30", "F", "e"),
        ("zero", "2023-01-01", "0", "-118", "30", "F", "e"),
        ("nolat", "2023-01-01", None, "-118", "30", "F", "e"),
        ("noage", "2023-01-01", "34.1", "-118", None, "F", "e"),
        ("sex", "2023-01-01", "34.1", "-118", "30", "H", "e"),
    ]
    out = research.clean(spark.createDataFrame(rows, columns)).collect()
    assert [(r["dr_no"], r["vict_age"], r["hour"], r["extra"]) for r in out] == [("keep", 80.0, 0, "e")]
    no_sex = spark.createDataFrame(rows, columns).drop("victsex")
    assert research.clean(no_sex).count() == 2


def schema():
    return T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])


def test_stream_loads_every_file_once(spark, tmp_path):
    lake = tmp_path / "lake"
    store = create_store(spark, str(tmp_path / "w"))

    def run():
        ingest_new_files(spark, str(lake), store, str(tmp_path / "staging"), str(tmp_path / "ck"), str(tmp_path / "q"),
                         files_per_batch=1).awaitTermination()

    write(lake, "a.json", [record(1), record(2)])
    write(lake, "b.json", [record(2, "2021-01-01"), record(3)])
    run()
    assert sorted(r["dr_no"] for r in store.table("fact_crime").collect()) == ["1", "2", "3"]
    commits = len(store.commits())
    run()
    assert len(store.commits()) == commits
    write(lake, "c.json", [record(4, area="09")])
    run()
    assert store.table("fact_crime").count() == 4
    assert {r["area_id"] for r in store.table("dim_area").collect()} == {"0", "7", "9"}


def test_stream_equals_batch_on_disjoint_files(spark, tmp_path):
    lake = tmp_path / "lake"
    for n in range(3):
        write(lake, f"{n}.json", [record(n * 10 + i, area=str(n + 1)) for i in range(4)])
    streamed = create_store(spark, str(tmp_path / "s"))
    ingest_new_files(spark, str(lake), streamed, str(tmp_path / "st"), str(tmp_path / "ck"), str(tmp_path / "q"),
                     files_per_batch=2, schema=schema()).awaitTermination()
    batch = create_store(spark, str(tmp_path / "b"))
    from caseloom.plans.warehouse import merge_staging

    merge_staging(batch, flows.daily_staging(spark.read.schema(schema()).json(str(lake))))
    for t in ("fact_crime", "dim_area", "dim_date"):
        assert sorted(map(str, streamed.table(t).collect())) == sorted(map(str, batch.table(t).collect()))


def test_stream_takes_every_format_and_sets_broken_records_aside(spark, tmp_path):
    lake = tmp_path / "lake"
    store = create_store(spark, str(tmp_path / "s"))

    def run():
        ingest_new_files(spark, str(lake), store, str(tmp_path / "st"), str(tmp_path / "ck"), str(tmp_path / "q"),
                         files_per_batch=3).awaitTermination()

    def csv(name, fields, rows):
        lines = [",".join(fields), *(",".join(r[f] for f in fields) for r in rows)]
        (lake / name).write_text("\n".join(lines) + "\n")

    write(lake, "a.json", [record(1), record(2)])
    (lake / "b.json").write_text(json.dumps([record(3), record(4)]))
    csv("c.csv", FIELDS, [record(5), record(6, area="08")])
    csv("d e[1]%20.csv", FIELDS[::-1], [record(7), record(8)])
    run()
    assert sorted(r["dr_no"] for r in store.table("fact_crime").collect()) == list("12345678")
    assert {r["area_id"] for r in store.table("dim_area").collect()} == {"0", "7", "8"}
    assert quarantined(spark, str(tmp_path / "q")).count() == 0

    (lake / "f.json").write_text(json.dumps(record(9)) + "\nno record\n")
    (lake / "g.csv").write_text('DR NO,AREA,Area Name\n10,07,"x, y"\n11,07,x,too,many\n12,07\n')
    (lake / "h.json").write_text("[1, ")
    (lake / "i.csv").write_text("")
    (lake / "k.json").write_text("nothing but noise\n")
    run()
    rows = {r["dr_no"]: r for r in store.table("fact_crime").collect()}
    assert set(rows) == {*"123456789", "10", "12"}
    broken = {(r["file"].rsplit("/", 1)[1], r["record"]) for r in quarantined(spark, str(tmp_path / "q")).collect()}
    assert broken == {("f.json", "no record"), ("g.csv", "11,07,x,too,many"), ("h.json", "[1, "), ("k.json", "nothing but noise")}
    commits = len(store.commits())
    run()
    assert len(store.commits()) == commits


def test_snapshot_restores_exactly_and_detects_damage(spark, table, tmp_path):
    tables = {"a": table("k string, v double", [("x", 1.0), ("y", None)]), "b": table("n int", [])}
    folder = snapshot.snapshot(spark, tables, str(tmp_path / "snaps"), datetime(2024, 1, 2, 3, 4, 5))
    assert folder.endswith("20240102_030405")
    assert {r["table"]: r["rows"] for r in snapshot.read_manifest(spark, folder).collect()} == {"a": 2, "b": 0}
    snapshot.restore(spark, folder, str(tmp_path / "back"))
    back = spark.read.parquet(str(tmp_path / "back" / "a"))
    assert sorted(back.collect(), key=str) == sorted(tables["a"].collect(), key=str)

    table("k string, v double", [("x", 2.0), ("y", None)]).write.mode("overwrite").parquet(f"{folder}/a")
    with pytest.raises(snapshot.SnapshotMismatch, match="a:"):
        snapshot.restore(spark, folder, str(tmp_path / "other"))
    assert not (tmp_path / "other").exists()


def test_a_restored_folder_opens_as_store_and_registry(spark, tmp_path):
    from datetime import timedelta

    from caseloom.operators import forecast as M

    lake = tmp_path / "lake"
    write(lake, "a.json", [record(i, f"2020-01-{1 + i % 28:02d}", area=str(i % 3)) for i in range(60)])
    store = create_store(spark, str(tmp_path / "w"))
    flows.daily_load(spark, str(lake), str(tmp_path / "staging"), store)
    models = ModelRegistry(spark, str(tmp_path / "m"))
    series = spark.createDataFrame([(date(2020, 1, 1) + timedelta(i), 10 + i % 7) for i in range(150)], "ds date, y bigint")
    for n, recipe in enumerate((M.Boosted(rounds=5), M.Boosted(rounds=5), M.Additive(changepoints=2, yearly=1))):
        models.publish("m" if n < 2 else "additive", M.train_and_evaluate(series, recipe), datetime(2024, 1, 1 + n))
    folder = flows.snapshot_store(store, models, str(tmp_path / "snaps"), datetime(2024, 1, 9))
    names = len(spark.read.parquet(f"{folder}/_files").collect())
    assert len([p for p in (tmp_path / "snaps" / "blobs").iterdir() if not p.name.startswith(".")]) < names  # equal contents once
    again, registry = flows.restore_store(spark, folder, str(tmp_path / "back"))
    for t in TABLES:
        assert sorted(map(str, again.table(t).collect())) == sorted(map(str, store.table(t).collect()))
    assert sorted(registry.metrics().collect()) == sorted(models.metrics().collect())
    for name in ("m", "additive"):
        want, got = (flows.forecast_for(r, name, date(2020, 7, 1), 5).orderBy("ds").collect() for r in (models, registry))
        assert got == want and len(got) == 5
        assert registry.latest_row(name).first()["path"].startswith(str(tmp_path / "back"))
    write(lake, "b.json", [record(1000)])
    flows.daily_load(spark, str(lake), str(tmp_path / "staging"), again)
    assert again.table("fact_crime").count() == 61
    with pytest.raises(ValueError, match="in use"):
        flows.restore_store(spark, folder, str(tmp_path / "back"))
    damaged = next(p for p in (tmp_path / "snaps" / "blobs").iterdir() if not p.name.startswith("."))
    damaged.write_bytes(b"other")
    (damaged.parent / f".{damaged.name}.crc").unlink(missing_ok=True)
    with pytest.raises(snapshot.SnapshotMismatch, match="files"):
        flows.restore_store(spark, folder, str(tmp_path / "third"))
    assert create_store(spark, str(tmp_path / "third" / "warehouse")).table("fact_crime").count() == 0


def test_fingerprint_ignores_order_and_partitioning(spark):
    one = spark.range(1000).selectExpr("id", "string(id % 7) as s")
    assert snapshot.fingerprint(one).first() == snapshot.fingerprint(
        one.orderBy("s").repartition(5).select("s", "id")).first()


def test_audit_trail(spark, tmp_path):
    path = str(tmp_path / "audit")
    at = datetime(2024, 1, 2, 3)
    rows = [(at, "f", "load", "SUCCESS", at.date(), "log/1", "ignored"), (at, "f", "merge", "FAILED", at.date(), "log/2", "boom")]
    append_audit(audit_record(spark, rows), path)
    append_audit(audit_record(spark, [(datetime(2024, 1, 3), "f", "load", "SUCCESS", at.date(), "log/3", None)]), path)
    trail = read_audit(spark, path)
    assert trail.count() == 3
    assert {r["task"]: r["error_message"] for r in trail.collect()} == {"load": "", "merge": "boom"}
    assert [tuple(r) for r in error_log(trail).collect()] == [(at, "f", "merge", "log/2", "boom")]


def test_snapshot_of_the_store(spark, tmp_path):
    store = create_store(spark, str(tmp_path / "w"))
    models = ModelRegistry(spark, str(tmp_path / "m"))
    folder = flows.snapshot_store(store, models, str(tmp_path / "snaps"), datetime(2024, 1, 1))
    assert snapshot.read_manifest(spark, folder).count() == 11
