from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseloom.operators import merge
from caseloom.plans import warehouse
from caseloom.schemas import FOREIGN_KEYS, STAGING, TABLES
from caseloom.sources.headers import conform
from caseloom.sources.lake import replace_table
from caseloom.sources.store import Store

RAW = "dr_no string, date_occ string, time_occ string, area_id string, area_name string, lat string, vict_age string"


def staging(table, rows):
    df = table(RAW, rows)
    return conform(df.withColumns({"lat": F.col("lat").try_cast("double"),
                                   "vict_age": F.col("vict_age").try_cast("double")}), STAGING)


def test_first_per_key_takes_the_smallest_row_nulls_last(table):
    rows = table("k string, a int, b string", [("x", None, "a"), ("x", 2, "z"), ("x", 2, "y"), ("y", None, None)])
    assert sorted(merge.first_per_key(rows, "k").collect()) == [("x", 2, "y"), ("y", None, None)]


def test_first_per_key_prunes_before_the_shuffle(table):
    plan = merge.first_per_key(table("k string, a int", [("x", 1)]), "k")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_per_key_against_brute_force_with_a_hot_key(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', string(id % 200)) as k", "int(id * 37 % 1000) as a",
                                        "string(id % 17) as b")
    want = {}
    for k, a, b in rows.collect():
        want[k] = min(want.get(k, (a, b)), (a, b))
    assert {r["k"]: (r["a"], r["b"]) for r in merge.first_per_key(rows, "k").collect()} == want


def test_insert_if_absent_and_rerun(table):
    target, batch = table("k string, v int", [("a", 1)]), table("k string, v int", [("a", 2), ("b", 3)])
    once = merge.merged(target, batch, "k")
    assert sorted(once.collect()) == [("a", 1), ("b", 3)]
    assert merge.insert_if_absent(once, batch, "k").isEmpty()


@pytest.mark.parametrize("limit, semi", [("4k", True), ("-1", False)])
def test_small_batches_prefilter_the_target(spark, table, tmp_path, limit, semi):
    target = spark.range(5000).selectExpr("string(id) as k", "1 as v")
    batch = replace_table(table("k string, v int", [("7", 2), ("new", 3)]), str(tmp_path / "batch"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        added = merge.insert_if_absent(target, batch, "k")
        assert ("LeftSemi" in added._jdf.queryExecution().toString()) == semi
        assert added.collect() == [("new", 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans(table):
    fact = table("area_id string, time_occ int", [("1", 5), ("1", 5), ("2", 7), (None, None)])
    keys = {"area_id": ("dim_area", "area_id"), "time_occ": ("dim_time", "time_id")}
    dims = {"dim_area": table("area_id string", [("2",)]), "dim_time": table("time_id int", [(5,)])}
    found = merge.orphan_counts(fact, dims, keys)
    assert sorted(found.collect()) == [("area_id", "1", 2), ("time_occ", "7", 1)]
    with pytest.raises(merge.OrphanFacts, match="area_id: 2, time_occ: 1"):
        merge.require_no_orphans(found)
    merge.require_no_orphans(found.limit(0))


ROWS = [
    (" 1 ", "01/08/2020 12:00:00 AM", "930.0", "07", "West", "34.5", "20"),
    ("1", "2020-01-08", "0930", "7.0", "Vest", "34.5", "30"),
    ("2", None, None, None, None, None, None),
    ("3", "bad", "x", "x", "Nowhere", "x", "x"),
    (None, "2020-01-09", "1200", "3", "East", "1", "1"),
]


def test_load_of_awkward_rows(spark, table, tmp_path):
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    commit = warehouse.merge_staging(store, staging(table, ROWS), batch="b1", check_orphans=True)
    fact = {r["dr_no"]: r for r in store.table("fact_crime").collect()}
    assert set(fact) == {"1", "2", "3"}
    assert (fact["1"]["area_id"], fact["1"]["time_occ"], fact["1"]["vict_age"]) == ("7", 930, 20.0)
    assert str(fact["1"]["date_occ"]) == "2020-01-08" and fact["1"]["occ_year"] == 2020
    assert (fact["2"]["area_id"], fact["2"]["status_id"], fact["2"]["date_occ"]) == ("0", "XX", None)
    assert (fact["3"]["area_id"], fact["3"]["time_occ"], fact["3"]["date_occ"]) == ("0", None, None)
    areas = {r["area_id"]: r["area_name"] for r in store.table("dim_area").collect()}
    assert areas == {"0": "Unknown Area", "7": "Vest", "3": "East"}
    assert sorted(map(tuple, store.table("dim_time").collect())) == [(930, 9, "Morning"), (1200, 12, "Afternoon")]
    assert {str(r["date_id"]): r["day_of_week"] for r in store.table("dim_date").collect()} == {
        "2020-01-08": 3, "2020-01-09": 4}
    assert commit.rows["fact_crime"] == 3

    rejected = warehouse.rejects(staging(table, ROWS)).first()
    assert (rejected["area_id"], rejected["time_occ"], rejected["date_occ"]) == (1, 1, 1)


def test_rerun_adds_nothing_and_first_rows_stay(spark, table, tmp_path):
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    warehouse.merge_staging(store, staging(table, ROWS))
    before = {t: Counter(map(tuple, store.table(t).collect())) for t in TABLES}
    again = warehouse.merge_staging(store, staging(table, ROWS))
    assert again.rows == {}
    assert {t: Counter(map(tuple, store.table(t).collect())) for t in TABLES} == before

    changed = [("1", "2021-05-05", "1200", "7", "Renamed", "1", "1"), ("9", "2021-05-05", "100", "8", "New", "1", "1")]
    warehouse.merge_staging(store, staging(table, changed))
    fact = {r["dr_no"]: str(r["date_occ"]) for r in store.table("fact_crime").collect()}
    assert fact["1"] == "2020-01-08" and fact["9"] == "2021-05-05"
    areas = {r["area_id"]: r["area_name"] for r in store.table("dim_area").collect()}
    assert areas["7"] == "Vest" and areas["8"] == "New"


def test_batch_id_is_committed_once(spark, table, tmp_path):
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    first = warehouse.merge_staging(store, staging(table, ROWS), batch="b")
    assert warehouse.merge_staging(store, staging(table, ROWS), batch="b") == first
    assert len(store.commits()) == 2


def test_strict_load_fails_and_stays_invisible(spark, table, tmp_path):
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        warehouse.merge_staging(store, staging(table, ROWS), strict=True)
    assert store.table("fact_crime").isEmpty() and store.table("dim_area").count() == 1
    assert len(store.commits()) == 1
    warehouse.merge_staging(store, staging(table, ROWS))
    assert store.table("fact_crime").count() == 3


def test_every_code_of_the_fact_has_its_member(spark, table, tmp_path):
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    warehouse.merge_staging(store, staging(table, ROWS))
    dims = {t: store.table(t) for t, _ in FOREIGN_KEYS.values()}
    assert merge.orphan_counts(store.table("fact_crime"), dims, FOREIGN_KEYS).isEmpty()


def test_of_two_writers_the_second_must_repeat(spark, table, tmp_path):
    one, two = Store(spark, str(tmp_path / "w")), Store(spark, str(tmp_path / "w"))
    (number, load), (same, other) = one.new_load(), two.new_load()
    assert number == same and load != other
    names = "area_id string, area_name string"
    kept = one.write("dim_area", load, table(names, [("1", "West")]))
    lost = two.write("dim_area", other, table(names, [("1", "Other")]))
    one.commit(number, load, {"dim_area": kept})
    with pytest.raises(Exception, match="[Ee]xist"):
        two.commit(same, other, {"dim_area": lost})
    assert two.table("dim_area").collect() == [("1", "West")]


def test_create_store_twice(spark, tmp_path):
    warehouse.create_store(spark, str(tmp_path / "w"))
    store = warehouse.create_store(spark, str(tmp_path / "w"))
    assert store.table("dim_status").collect() == [("XX", "Unknown Status")]
    assert store.table("fact_crime").columns[-1] == "occ_year"
