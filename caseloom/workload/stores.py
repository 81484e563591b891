"""Star schemas built from the test tables in the shared folder, one per data set and application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.operators.star import Star
from caseloom.plans.warehouse import create_store, merge_staging
from caseloom.schemas import STAGING
from caseloom.session import work_path
from caseloom.sources.headers import conform
from caseloom.sources.lake import replace_table
from caseloom.sources.store import Store
from caseloom.workload import fixture

_stores: dict[tuple[str, str], Store] = {}
_staging: dict[tuple[str, str], DataFrame] = {}


def staging_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw incidents in the staging layout, written once per application and read back."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staging:
        rows = conform(fixture.raw(spark, sf_dir), STAGING)
        _staging[key] = replace_table(rows, work_path(spark, "staging"))
    return _staging[key]


def build_store(spark: SparkSession, sf_dir: str) -> Store:
    store = create_store(spark, work_path(spark, "warehouse"))
    merge_staging(store, staging_table(spark, sf_dir), batch=sf_dir)
    return store


def incident_store(spark: SparkSession, sf_dir: str) -> Store:
    """The loaded store; queries of one application share it, as dashboard users share a warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        _stores[key] = build_store(spark, sf_dir)
    return _stores[key]


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star.of(incident_store(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).fact
