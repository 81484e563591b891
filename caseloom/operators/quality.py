"""Data-quality rules over staging rows, all counted in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.scalars import date_of, null_island_both_zero, sanitised_number
from caseloom.sources import files
from caseloom.sources.lake import EmptyInput


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    violated: Column


class MissingStaging(ValueError):
    """The staging table does not exist."""


def _number(staging: DataFrame, name: str) -> Column:
    kind = dict(staging.dtypes).get(name)
    return F.col(name) if kind in ("double", "float", "int", "bigint") else sanitised_number(F.col(name))


def rules(staging: DataFrame, lexical: bool = False) -> list[Rule]:
    """The rules whose columns are present.

    ``lexical`` compares the two dates as text, the way an untyped staging table does; by default
    they are parsed first.
    """
    found = set(staging.columns)
    wanted: list[Rule] = []
    if {"date_rptd", "date_occ"} <= found:
        pair = (
            [F.col(c).cast("string") for c in ("date_rptd", "date_occ")]
            if lexical
            else [date_of(staging, c) for c in ("date_rptd", "date_occ")]
        )
        wanted.append(Rule("reported_before_occurred", ("date_rptd", "date_occ"), pair[0] < pair[1]))
    if "vict_age" in found:
        wanted.append(Rule("negative_age", ("vict_age",), _number(staging, "vict_age") < 0))
    if {"lat", "lon"} <= found:
        both = null_island_both_zero(_number(staging, "lat"), _number(staging, "lon"))
        wanted.append(Rule("null_island", ("lat", "lon"), both))
    return wanted


def violation_counts(staging: DataFrame, lexical: bool = False) -> DataFrame:
    """One row: the total and one count per rule."""
    checks = [F.count_if(r.violated).alias(r.name) for r in rules(staging, lexical)]
    return staging.agg(F.count("*").alias("total"), *checks)


def quality_report(staging: DataFrame, lexical: bool = False) -> DataFrame:
    """(rule, violations, total), one row per violated rule; informational, never blocks a load."""
    names = [r.name for r in rules(staging, lexical)]
    return (
        violation_counts(staging, lexical)
        .unpivot("total", names, "rule", "violations")
        .where("violations > 0")
        .select("rule", "violations", "total")
    )


def flag_rows(staging: DataFrame, lexical: bool = False) -> DataFrame:
    """Rows unchanged plus ``failed_rules``, the names of the rules each one violates."""
    names = [F.when(r.violated, F.lit(r.name)) for r in rules(staging, lexical)]
    return staging.withColumn("failed_rules", F.array_compact(F.array(*names)))


def require_staging(spark: SparkSession, name_or_path: str) -> DataFrame:
    """The staging table, which must exist and hold rows."""
    is_path = "/" in name_or_path
    found = files.exists(spark, name_or_path) if is_path else spark.catalog.tableExists(name_or_path)
    if not found:
        raise MissingStaging(f"{name_or_path} not found")
    staging = spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)
    if staging.isEmpty():
        raise EmptyInput(f"{name_or_path} is empty")
    return staging
