from __future__ import annotations

from datetime import date

import pytest

from caseloom.operators import ranking
from caseloom.operators.star import Star, StarFilter, bernoulli_sample, date_range, filtered_fact, with_labels
from caseloom.plans import dashboard


@pytest.fixture
def star(table):
    fact = table(
        "dr_no string, date_occ date, area_id string, crm_cd string, weapon_id string, premis_id string, "
        "status_id string, lat double, lon double, vict_age double",
        [
            ("1", date(2020, 1, 1), "1", "10", "0", "5", "AA", 34.0, -118.0, 30.0),
            ("2", date(2020, 1, 2), "1", "11", "7", "5", "AA", 0.0, -118.0, None),
            ("3", date(2020, 1, 2), "2", "10", "7", "6", "IC", 34.0, -118.0, 41.0),
            ("4", date(2020, 1, 4), "9", "10", "0", "6", "IC", None, -118.0, 20.0),
            ("5", None, "1", "10", "0", "6", "IC", 34.0, -118.0, 20.0),
        ],
    )
    return Star(
        fact,
        table("area_id string, area_name string", [("1", "West"), ("2", "East"), ("3", None)]),
        table("crm_cd string, crm_cd_desc string", [("10", "Theft"), ("11", "Arson")]),
        table("weapon_id string, weapon_desc string", [("0", "Unknown Weapon"), ("7", "Knife")]),
        table("premis_id string, premis_desc string", [("5", "Street"), ("6", "Bank")]),
        table("status_id string, status_desc string", [("AA", "Arrest"), ("IC", "Open")]),
    )


YEAR = StarFilter(date(2020, 1, 1), date(2020, 12, 31))


def keys(df):
    return sorted(r["dr_no"] for r in df.collect())


def test_lists_are_combined_and_empty_ones_ignored(star):
    assert keys(filtered_fact(star, StarFilter())) == ["1", "2", "3", "4", "5"]
    assert keys(filtered_fact(star, YEAR)) == ["1", "2", "3", "4"]
    assert keys(filtered_fact(star, StarFilter(YEAR.start, YEAR.end, areas=["West"], crimes=["Theft"]))) == ["1"]
    assert keys(filtered_fact(star, StarFilter(weapons=["Knife"], premises=["Bank", "none"]))) == ["3"]


def test_hostile_label_is_just_a_value(star):
    assert keys(filtered_fact(star, StarFilter(areas=["x') OR 1=1 --"]))) == []


def test_unused_dimensions_are_not_read(star):
    plan = filtered_fact(star, StarFilter(areas=["West"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_range_also_prunes_the_storage_partition(table):
    fact = table("date_occ date, occ_year int", [(date(2020, 5, 5), 2020), (date(2019, 5, 5), 2019)])
    kept = date_range(fact, date(2020, 1, 1), date(2020, 12, 31))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "occ_year" in plan and kept.collect() == [(date(2020, 5, 5), 2020)]


def test_labels_are_outer_joined(star):
    rows = with_labels(star, star.fact, ["area", "status"])
    assert {r["dr_no"]: r["area_name"] for r in rows.collect()}["4"] is None
    assert rows.count() == 5


def test_kpis(star):
    row = dashboard.kpis(star, YEAR).first()
    assert tuple(row) == (4, 91.0 / 3, "West", "Knife")
    texts = dashboard.kpi_texts(dashboard.kpis(star, YEAR)).first()
    assert tuple(texts) == ("4", "30 Yrs", "West", "Knife...")


def test_kpis_without_rows(star):
    assert tuple(dashboard.kpis(star, StarFilter(areas=["none"])).first()) == (0, None, "-", "-")


def test_null_group_can_win(star):
    only_unknown = StarFilter(date(2020, 1, 4), date(2020, 1, 4))
    assert dashboard.kpis(star, only_unknown).first()["top_area"] is None


def test_top_label(table):
    counts = table("l string, n bigint", [("b", 3), ("a", 3), (None, 3), ("c", 1)])
    assert ranking.top_label(counts, "l").first()[0] == "a"
    assert ranking.top_label(counts.where("n > 9"), "l").first()[0] == "-"
    assert ranking.top_label(counts.where("l IS NULL"), "l").first()[0] is None


def test_trend_and_preview(star):
    assert [tuple(r) for r in dashboard.trend(star, YEAR).collect()] == [
        (date(2020, 1, 1), 1, 1.0), (date(2020, 1, 2), 2, 1.5), (date(2020, 1, 4), 1, 4 / 3)]
    top = dashboard.preview(star, YEAR, n=2).collect()
    assert [(r["dr_no"], r["area_name"], r["status_desc"]) for r in top] == [("4", None, "Open"), ("2", "West", "Arrest")]


def test_map_points_leave_out_zero_and_missing_places(star):
    points = dashboard.map_points(star, YEAR, percent=100, seed=1)
    assert sorted(r["crm_cd_desc"] for r in points.collect()) == ["Theft", "Theft"]


def test_filter_options(star):
    rows = [tuple(r) for r in dashboard.filter_options(star).collect()]
    assert rows == [
        ("area", "East"), ("area", "West"), ("area", None), ("crime", "Arson"), ("crime", "Theft"),
        ("first_day", "2020-01-01"), ("last_day", "2020-01-04"), ("premise", "Bank"), ("premise", "Street"),
        ("weapon", "Knife"), ("weapon", "Unknown Weapon")]


def test_bernoulli_fraction(spark):
    n = 40_000
    kept = bernoulli_sample(spark.range(n), 0.1, seed=7).count()
    assert abs(kept - n * 0.1) < 4 * (n * 0.1 * 0.9) ** 0.5


def test_latest_per_group(table):
    rows = table("model_name string, created_at timestamp, mae double", [])
    assert ranking.latest_per_group(rows, ["model_name"], "created_at").isEmpty()
    from datetime import datetime

    rows = table("model_name string, created_at timestamp, mae double",
                 [("a", datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 1, 2), 5.0), ("b", datetime(2023, 1, 1), 2.0)])
    latest = ranking.latest_per_group(rows, ["model_name"], "created_at")
    assert sorted((r["model_name"], r["mae"]) for r in latest.collect()) == [("a", 5.0), ("b", 2.0)]
    assert latest.columns == rows.columns
    timeless = table("model_name string, created_at timestamp, mae double",
                     [("a", None, 9.0), ("a", datetime(2024, 1, 1), 1.0), ("c", None, 3.0)])
    latest = ranking.latest_per_group(timeless, ["model_name"], "created_at")
    assert sorted((r["model_name"], r["mae"]) for r in latest.collect()) == [("a", 1.0), ("c", 3.0)]
