from __future__ import annotations

import pytest

from caseloom.schemas import STAGING, STAGING_COLUMNS
from caseloom.sources import headers as H


@pytest.mark.parametrize(
    "raw, basic, snake, alnum",
    [
        ("Crm Cd Desc", "crm_cd_desc", "crm_cd_desc", "crmcddesc"),
        (" Part 1-2 ", "_part_1-2_", "part_1_2", "part12"),
        ("\ufeffDR_NO", "\ufeffdr_no", "\ufeffdr_no", "drno"),
    ],
)
def test_header_rules(raw, basic, snake, alnum):
    assert (H.basic_header(raw), H.snake_header(raw), H.alphanumeric_header(raw)) == (basic, snake, alnum)


def test_normalise_headers(table):
    df = table("`A B` string, `C-D` string", [("1", "2")])
    assert H.normalise_headers(df, H.snake_header).columns == ["a_b", "c_d"]


def test_daily_mapping_keeps_known_columns_only(table):
    df = table("`AREA` string, `Dr No` string, other string", [("07", "1", "x")])
    mapped = H.map_columns(df, H.DAILY_COLUMNS, H.basic_header)
    assert mapped.columns == ["dr_no", "area_id"]
    assert mapped.collect() == [("1", "07")]


def test_two_spellings_of_one_target_are_coalesced_in_header_order(table):
    df = table("AREA string, area_id string", [("1", "9"), (None, "8")])
    mapped = H.map_columns(df, H.historical_columns(STAGING_COLUMNS), H.alphanumeric_header)
    assert [r["area_id"] for r in mapped.collect()] == ["1", "8"]


def test_research_mapping_keeps_unmapped(table):
    df = table("DrNo string, ` Note ` string, VictSex string", [("1", "n", "F")])
    mapped = H.map_columns(df, H.RESEARCH_COLUMNS, H.snake_header, keep_unmapped=True)
    assert mapped.columns == ["dr_no", "vict_sex", "note"]


def test_conform_gives_the_25_columns(table):
    df = table("lat string, dr_no string, extra int", [("34.5", "7", 1)])
    out = H.conform(df, STAGING)
    assert out.columns == list(STAGING_COLUMNS) and len(out.columns) == 25
    row = out.first()
    assert (row["dr_no"], row["lat"], row["crm_cd"]) == ("7", 34.5, None)


def test_ensure_columns(table):
    out = H.ensure_columns(table("a string", [("x",)]), ["a", "b"])
    assert out.collect() == [("x", None)]


def test_names_with_dots_and_backticks(table):
    df = table("`a.b` string, `c``d` string", [("1", "2")])
    assert H.map_columns(df, {"a.b": "x", "c`d": "y"}).collect() == [("1", "2")]
