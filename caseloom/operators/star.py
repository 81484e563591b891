"""Filters and joins over the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalars import in_hash_sample
from caseloom.sources.store import FACT_PARTITION, Store

# dimension -> (key, label)
LABELS = {
    "area": ("area_id", "area_name"),
    "crime": ("crm_cd", "crm_cd_desc"),
    "weapon": ("weapon_id", "weapon_desc"),
    "premise": ("premis_id", "premis_desc"),
    "status": ("status_id", "status_desc"),
}


@dataclass(frozen=True)
class Star:
    """The fact and its labelled dimensions (each unique on its key)."""

    fact: DataFrame
    area: DataFrame
    crime: DataFrame
    weapon: DataFrame
    premise: DataFrame
    status: DataFrame

    @classmethod
    def of(cls, store: Store) -> "Star":
        return cls(
            store.table("fact_crime"), *[store.table(f"dim_{d}") for d in LABELS]
        )

    def dimension(self, name: str) -> DataFrame:
        return getattr(self, name)


@dataclass(frozen=True)
class StarFilter:
    """Inclusive date range and label lists; an empty list filters nothing."""

    start: date | None = None
    end: date | None = None
    areas: Sequence[str] = field(default=())
    crimes: Sequence[str] = field(default=())
    weapons: Sequence[str] = field(default=())
    premises: Sequence[str] = field(default=())

    def labels(self) -> dict[str, Sequence[str]]:
        lists = {
            "area": self.areas, "crime": self.crimes, "weapon": self.weapons, "premise": self.premises,
        }
        return {name: values for name, values in lists.items() if values}


def date_range(fact: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """``date_occ BETWEEN start AND end``, also on the storage partition so whole years are skipped."""
    conditions: list[Column] = []
    day = F.col("date_occ")
    if start is not None:
        conditions.append(day >= F.lit(start))
    if end is not None:
        conditions.append(day <= F.lit(end))
    if FACT_PARTITION in fact.columns:
        year = F.col(FACT_PARTITION)
        conditions += [year >= start.year] if start is not None else []
        conditions += [year <= end.year] if end is not None else []
    for condition in conditions:
        fact = fact.where(condition)
    return fact


def filtered_fact(star: Star, chosen: StarFilter) -> DataFrame:
    """Facts passing the filter, without widening them by any dimension.

    Label lists are turned into keys on the dimension first; the fact then meets a semi join with
    that short key list.  Dimensions nobody filters on are not read.
    """
    fact = date_range(star.fact, chosen.start, chosen.end)
    for name, values in chosen.labels().items():
        key, label = LABELS[name]
        keys = star.dimension(name).where(F.col(label).isin(*values)).select(key)
        fact = fact.join(keys, key, "left_semi")
    return fact


def with_labels(star: Star, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left outer join to the named dimensions, and only those.

    No broadcast hint: Spark compares each dimension's size with its limit and otherwise shuffles,
    splitting hot codes through its skew-join rule.
    """
    for name in names:
        key, label = LABELS[name]
        rows = rows.join(star.dimension(name).select(key, label), key, "left")
    return rows


def mapped_points(fact: DataFrame) -> DataFrame:
    """Facts with both coordinates present and non-zero."""
    return fact.where((F.col("lat") != 0) & (F.col("lon") != 0))


def bernoulli_sample(fact: DataFrame, fraction: float = 0.1, seed: int | None = None) -> DataFrame:
    return fact.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(fact: DataFrame, key: str = "dr_no", percent: int = 10) -> DataFrame:
    """Sample that depends on the key alone: the same rows on every run and every cluster."""
    return fact.where(in_hash_sample(F.col(key), percent))
