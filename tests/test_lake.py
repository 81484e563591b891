from __future__ import annotations

import json
import os
from datetime import datetime

import pytest

from caseloom.sources import headers as H
from caseloom.sources import lake


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_json_array_and_lines_are_told_apart(spark, tmp_path):
    records = [{"dr_no": "1", "lat": 34.1}, {"dr_no": "2", "crm_cd": 510}]
    array = write(tmp_path / "a.json", " \n" + json.dumps(records))
    lines = write(tmp_path / "b.json", "\n".join(map(json.dumps, records)))
    for path, fmt in ((array, "json_array"), (lines, "json_lines")):
        assert lake.format_of(spark, path) == fmt
        df = lake.read_lake(spark, path)
        assert dict(df.dtypes) == {"dr_no": "string", "lat": "string", "crm_cd": "string"}
        assert sorted((r["dr_no"], r["lat"], r["crm_cd"]) for r in df.collect()) == [
            ("1", "34.1", None), ("2", None, "510")]


def test_csv_is_text_with_missing_markers(spark, tmp_path):
    path = write(tmp_path / "x.CSV", 'A,B C,D\n007,NA,"say ""hi"", ok"\n,null, x \n')
    rows = lake.read_lake(spark, path).collect()
    assert [tuple(r) for r in rows] == [("007", None, 'say "hi", ok'), (None, None, " x ")]


def test_csv_with_quoted_newline(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n1,"two\nlines"\n')
    assert lake.read_csv(spark, path, quoted_newlines=True).collect() == [("1", "two\nlines")]


def test_header_probe(spark, tmp_path):
    path = write(tmp_path / "h.csv", "DR_NO,Part 1-2\n1,2\n")
    assert lake.csv_header(spark, path, H.alphanumeric_header) == ["drno", "part12"]


def test_latest_object_goes_by_modification_time(spark, tmp_path):
    old = write(tmp_path / "lake" / "zzz.json", "[]")
    new = write(tmp_path / "lake" / "aaa.json" / "part-0.json", "{}")
    os.utime(old, (1_000, 1_000))
    os.utime(new, (2_000, 2_000))
    root = str(tmp_path / "lake")
    assert lake.latest_object(spark, root) == f"{root}/aaa.json"
    os.utime(old, (3_000, 3_000))
    assert lake.latest_object(spark, f"file://{root}/") == f"file://{root}/zzz.json"
    assert lake.preferred_object(spark, root, "aaa.json") == f"{root}/aaa.json"
    assert lake.preferred_object(spark, root, "none.csv") == f"{root}/zzz.json"


def test_empty_lake(spark, tmp_path):
    empty = tmp_path / "lake"
    empty.mkdir()
    assert lake.latest_object(spark, str(empty)) is None
    assert lake.latest_object(spark, str(tmp_path / "missing")) is None
    with pytest.raises(lake.EmptyInput):
        lake.preferred_object(spark, str(empty), "x.csv")


def test_extracts_are_timestamped_and_never_overwritten(spark, table, tmp_path):
    rows = table("dr_no string", [("1",), ("2",)])
    at = datetime(2024, 1, 2, 3, 4, 5)
    path = lake.land_extract(rows, str(tmp_path), "extract", at)
    assert path.endswith("extract_20240102_030405.json")
    assert lake.read_lake(spark, path).count() == 2
    with pytest.raises(Exception, match="already exists"):
        lake.land_extract(rows, str(tmp_path), "extract", at)
    with pytest.raises(lake.EmptyInput):
        lake.land_extract(rows.limit(0), str(tmp_path), "empty", at)


def test_latest_records(table):
    rows = table("dr_no string, date_occ string", [("1", "2024-01-01"), ("2", "2024-01-03"), ("3", None)])
    assert [r["dr_no"] for r in lake.latest_records(rows, n=1).collect()] == ["2"]


def test_replace_table(spark, table, tmp_path):
    path = str(tmp_path / "staging")
    lake.replace_table(table("a string", [("1",), ("2",)]), path)
    assert lake.replace_table(table("b int", [(3,)]), path).collect() == [(3,)]


def test_each_file_is_read_in_its_own_format(spark, tmp_path):
    import gzip

    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("dr_no,area\n1,x\n")
    (folder / "b.json").write_text(" " * 100 + "\n[\n {\"dr_no\": 2, \"area\": \"y\"}\n]\n")
    (folder / "c.json").write_text('{"dr_no": 3}\n{"dr_no": 4, "lat": 1.5}\n')
    with gzip.open(folder / "d.json.gz", "wt") as f:
        f.write('\n  [{"dr_no": 5},\n {"dr_no": 6}]')
    rows = lake.read_lake(spark, str(folder))
    assert sorted(r["dr_no"] for r in rows.collect()) == list("123456")
    (folder / "e.json").write_text("this is no record\n")
    with pytest.raises(ValueError):
        lake.read_lake(spark, str(folder))


def test_csv_parts_are_matched_by_name(spark, tmp_path):
    import gzip

    write(tmp_path / "m" / "a.csv", "dr_no,area\n1,x\n")
    write(tmp_path / "m" / "b.csv", "area,dr_no\ny,2\n")
    write(tmp_path / "m" / "below" / "c d[1].csv", "\nlat,DR_NO\n3.5,3\n")
    write(tmp_path / "m" / "empty.csv", "")
    with gzip.open(tmp_path / "m" / "e.csv.gz", "wt") as f:
        f.write("dr_no,lat\n4,4.5\n")
    for rows in (lake.read_lake(spark, str(tmp_path / "m")), lake.read_csv(spark, str(tmp_path / "m"))):
        assert sorted((r["dr_no"], r["area"], r["lat"]) for r in rows.collect()) == [
            ("1", "x", None), ("2", "y", None), ("3", None, "3.5"), ("4", None, "4.5")]
    with pytest.raises(lake.EmptyInput):
        lake.read_csv(spark, [])


def test_files_without_an_ending_go_by_their_object_or_the_rule(spark, tmp_path):
    part = write(tmp_path / "x.csv" / "part-0", "a,b\n1,2\n")
    assert lake.format_of(spark, part, str(tmp_path / "x.csv")) == "csv"
    assert lake.read_lake(spark, str(tmp_path / "x.csv")).collect() == [("1", "2")]
    data = write(tmp_path / "x.dat", "a,b\n1,2\n")
    assert lake.read_lake(spark, data, otherwise="csv").collect() == [("1", "2")]
    with pytest.raises(ValueError):
        lake.read_lake(spark, data)


def test_broken_json_is_refused_with_a_schema_too(spark, tmp_path):
    path = write(tmp_path / "x.json", '{"a": "1"}\nno record\n')
    schema = spark.createDataFrame([], "a string").schema
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        lake.read_lake(spark, path, schema=schema).collect()
    with pytest.raises(ValueError):
        lake.read_lake(spark, path)
