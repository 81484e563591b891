from __future__ import annotations

import pytest

from caseloom.operators import quality
from caseloom.sources.lake import EmptyInput

COLUMNS = "date_rptd string, date_occ string, vict_age string, lat string, lon string"
ROWS = [
    ("01/02/2020 12:00:00 AM", "01/01/2020", "20", "34", "-118"),
    ("01/01/2020 12:00:00 AM", "2020-01-05", "-1 yrs", "0.0", "0"),
    ("12/31/2019", "01/01/2020", None, "0", "-118"),
    (None, "01/01/2020", "x", None, "0"),
]


def test_all_rules_in_one_scan(table):
    counts = quality.violation_counts(table(COLUMNS, ROWS))
    assert counts.first().asDict() == {
        "total": 4, "reported_before_occurred": 2, "negative_age": 1, "null_island": 1}
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_lexical_comparison_differs(table):
    assert quality.violation_counts(table(COLUMNS, ROWS), lexical=True).first()["reported_before_occurred"] == 1


def test_report_lists_violated_rules_only(table):
    df = table(COLUMNS, ROWS[:1])
    assert quality.quality_report(df).isEmpty()
    rows = sorted(map(tuple, quality.quality_report(table(COLUMNS, ROWS)).collect()))
    assert rows == [("negative_age", 1, 4), ("null_island", 1, 4), ("reported_before_occurred", 2, 4)]


def test_rules_need_their_columns(table):
    assert [r.name for r in quality.rules(table("lat double, vict_age double", [(0.0, 1.0)]))] == ["negative_age"]


def test_flags(table):
    flags = [r["failed_rules"] for r in quality.flag_rows(table(COLUMNS, ROWS)).collect()]
    assert flags == [[], ["reported_before_occurred", "negative_age", "null_island"], ["reported_before_occurred"], []]


def test_staging_must_exist_and_hold_rows(spark, table, tmp_path):
    with pytest.raises(quality.MissingStaging):
        quality.require_staging(spark, str(tmp_path / "none"))
    with pytest.raises(quality.MissingStaging):
        quality.require_staging(spark, "no_such_table")
    df = table("a int", [(1,)])
    df.limit(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(EmptyInput):
        quality.require_staging(spark, str(tmp_path / "empty"))
    df.createOrReplaceTempView("staging_view")
    assert quality.require_staging(spark, "staging_view").count() == 1
