"""Steps whose cost must grow with the input only: what is sorted, moved or held at once."""

from __future__ import annotations

import gzip
import json
from collections import Counter
from datetime import datetime

import pytest
from conftest import TINY
from pyspark.sql import functions as F

from caseloom.operators.merge import first_label_per_code
from caseloom.plans import warehouse
from caseloom.plans.warehouse import create_store, merge_staging, new_rows
from caseloom.schemas import STAGING
from caseloom.session import SPLIT_BYTES, small_splits
from caseloom.sources import lake
from caseloom.sources.headers import conform
from caseloom.workload import fixture, flow_queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_are_folded_by_hashing_before_any_sort(spark, table):
    rows = table("c string, l string", [("1", "b"), ("1", "a"), ("2", None), ("2", None), (None, "x")])
    found = first_label_per_code(rows, "c", "l")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("1", "a"), ("2", None), (None, "x")], key=str)
    plan = _plan(found)
    assert "HashAggregate(keys=[c" in plan and plan.count("Aggregate(keys") == 4, plan


def test_a_table_without_rows_is_not_compared(spark, table, tmp_path):
    store = create_store(spark, str(tmp_path / "store"))
    staging = conform(table("dr_no string, area_id string, area_name string", [("1", "7", "a"), ("1", "8", "b"), (None, "0", "c")]), STAGING)
    plan = _plan(new_rows(store, "fact_crime", staging))
    assert "Join" not in plan and plan.count("Window [") == 1
    merge_staging(store, staging, batch="one")
    assert "Join" in _plan(new_rows(store, "fact_crime", staging))
    assert new_rows(store, "fact_crime", staging).count() == 0
    assert {r["area_id"] for r in store.table("dim_area").collect()} == {"0", "7", "8"}


def test_json_arrays_are_more_not_longer_with_more_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flow_queries, "ARRAY_RECORDS", 10)
    monkeypatch.setattr(flow_queries, "PACKED", "none")
    texts = spark.range(400).select(
        F.col("id").cast("string").alias(flow_queries.DAILY_SPELLING.get("dr_no", "dr_no")), F.lit('a "b",\n]').alias("note"), F.lit(1).alias("share"))
    assert flow_queries._land_share(spark, texts, 1, str(tmp_path)) == 40
    arrays = [json.loads(f.read_text()) for f in tmp_path.glob("array.json/part-*")]
    assert len(arrays) > flow_queries.FILES and sum(map(len, arrays)) == 400 and max(map(len, arrays)) < 50
    read = lake.read_lake(spark, str(tmp_path / "array.json"))
    assert read.count() == 400 and {r["note"] for r in read.select("note").distinct().collect()} == {'a "b",\n]'}


def _small_tables(table, folder) -> str:
    """Six tables of a few rows; some line items come twice, have no order, or hold NULL."""
    items = [(o, o % 3, o % 2, n, float(o), "AN"[n % 2], "F", datetime(1997, 1, 1 + o)) for o in range(20) for n in (1, 2)]
    items += items[:7] + [(99, 0, 0, 1, 1.0, "A", "F", datetime(1997, 1, 1)), (3, 1, 1, None, None, None, None, None)]
    for name, ddl, rows in (
        ("nation", "n_nationkey int, n_name string", [(0, "here"), (1, "there")]),
        ("customer", "c_custkey long, c_nationkey int", [(0, 0), (1, 1), (2, None)]),
        ("supplier", "s_suppkey long, s_name string", [(0, "one"), (1, "two")]),
        ("part", "p_partkey long, p_size int, p_type string, p_brand string", [(0, 1, "a", "Brand#1"), (1, 2, "b", "Brand#2"), (2, None, None, None)]),
        ("orders", "o_orderkey long, o_custkey long", [(o, o % 3) for o in range(20)]),
        ("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
         "l_linestatus string, l_shipdate timestamp", items),
    ):
        table(ddl, rows).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_rows_become_text_after_they_have_met_in_their_file(spark, table, tmp_path, monkeypatch):
    tables = _small_tables(table, tmp_path / "tables")
    dealt, plain = [], flow_queries._texts
    monkeypatch.setattr(flow_queries, "_texts", lambda rows: (dealt.append(rows), plain(rows))[1])
    monkeypatch.setattr(flow_queries, "work_path", lambda spark, *parts: str(tmp_path.joinpath(*parts)))
    raw = fixture.raw(spark, tables)
    found = flow_queries._json_array(spark, tables)
    expected = raw.groupBy("area_id").agg(F.count("*"), F.count_distinct("dr_no"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert len(dealt) == flow_queries.SHARES and len(list(tmp_path.glob("sources/share=*"))) > 1  # a share's shuffle files at a time
    assert all(d._jdf.queryExecution().optimizedPlan().toString().startswith("RepartitionByExpression") for d in dealt)
    assert "l_shipdate" in dealt[0].columns and not set(dealt[0].columns) & {*fixture.RAW_COLUMNS, "l_tax", "o_custkey"}
    unpacked = [gzip.decompress(f.read_bytes()) for f in tmp_path.glob("arrays/array.json/part-*.gz")]
    arrays = [json.loads(text) for text in unpacked if text]  # Spark writes an empty file where a share's first part is empty
    assert sum(map(len, arrays)) == raw.count() > 0
    number = flow_queries.DAILY_SPELLING.get("dr_no", "dr_no")
    files = Counter(n for array in arrays for n in {str(r.get(number)).strip() for r in array})
    assert set(files.values()) == {1}


def test_wide_shuffles_read_small_splits(spark):
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    with small_splits(spark):
        assert int(spark.conf.get(key)) == SPLIT_BYTES
    assert spark.conf.get(key) == before
    spark.conf.set(key, "1m")
    try:
        with small_splits(spark):
            assert int(spark.conf.get(key)) == 1 << 20
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_packed_extracts_keep_their_format(spark, tmp_path):
    folder = f"{tmp_path}/extract.json"
    spark.range(5).select(F.col("id").cast("string")).write.option("compression", "snappy").json(folder)
    names = [str(p) for p in tmp_path.glob("extract.json/part-*.json.snappy")]
    assert names and {lake.format_of(spark, n, otherwise="csv") for n in names} == {"json_lines"}
    assert lake.read_lake(spark, folder).count() == 5


def _below(plan: str, mark: str) -> str:
    """Lines of a printed plan below the first line that holds ``mark``."""
    lines = plan.splitlines()
    k = next(i for i, line in enumerate(lines) if mark in line)
    depth = len(lines[k]) - len(lines[k].lstrip(" :+-"))
    inside = []
    for line in lines[k + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        inside.append(line)
    return "\n".join(inside)


def test_line_items_do_not_travel_to_customers(spark):
    """Orders find their customers before they meet line items."""
    plan = fixture.raw(spark, TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in _below(plan, "Join Inner, (o_custkey")


def test_an_extract_is_worked_out_once(spark, table, tmp_path, monkeypatch):
    rows = table("dr_no string", [("1",), ("2",)])
    looked_at = []
    plain = type(rows).isEmpty
    monkeypatch.setattr(type(rows), "isEmpty", lambda df: (looked_at.append(df), plain(df))[1])
    path = lake.land_extract(rows, str(tmp_path), "extract", datetime(2024, 5, 1))
    assert all(df is not rows for df in looked_at) and spark.read.json(path).count() == 2
    with pytest.raises(lake.EmptyInput):
        lake.land_extract(rows.where("dr_no = '3'"), str(tmp_path), "empty", datetime(2024, 5, 1))
    assert [p.name for p in tmp_path.iterdir()] == ["extract_20240501_000000.json"]


def test_codes_are_read_once_per_spelling(spark, table):
    staging = table("area_id string, area_name string, time_occ string", [("07", "b", "0930"), ("7.0", "a", "930.0"), (None, "c", None), ("x", "d", "?")] * 3)
    for name, found in (("dim_area", [("7", "a")]), ("dim_time", [(930, 9)])):
        rows = warehouse.BATCH_ROWS[name](staging, False)
        plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
        last = max(k for k, line in enumerate(plan) if "Aggregate [" in line)
        assert not any("cast" in line for line in plan[last:])
        assert [tuple(r)[:2] for r in rows.collect()] == found
