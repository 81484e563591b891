"""Insert-only merging: first row per key, insert-if-absent, referential checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import broadcast_limit, estimated_bytes


def first_per_key(rows: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order`` (default: every other column), NULLs last.

    The total order makes the winner repeatable.  ``row_number() = 1`` right under the filter lets
    Spark add a window group limit before the shuffle, so each map task sends at most one row per
    key: a key owning a third of all rows costs no more than any other.
    """
    order = [c for c in rows.columns if c != key] if order is None else order
    window = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_label_per_code(rows: DataFrame, code: str, label: str) -> DataFrame:
    """``first_per_key`` for (code, label) pairs: distinct pairs first (map-side), then the least label.

    Spark drops a plain ``distinct`` under a minimum, and a minimum of text is found by sorting: every row would be sorted.
    The count keeps the pairs, which are found by hashing.
    """
    pairs = rows.groupBy(code, label).agg(F.count("*").alias("_rows")).where("_rows > 0")
    return pairs.groupBy(code).agg(F.min(label).alias(label))


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The rows of ``batch`` (unique on ``key``) whose key the target does not hold yet.

    A batch within Spark's broadcast limit first reduces the target's key column to its own keys by
    a semi join: the target is then scanned but never shuffled.  With a larger batch that step would
    only add a shuffle, so both key columns are shuffled once and anti-joined.
    """
    keys = target.select(key)
    wanted = batch.select(key)
    if estimated_bytes(wanted) <= broadcast_limit(batch.sparkSession) < estimated_bytes(keys):
        keys = keys.join(wanted, key, "left_semi")
    return batch.join(keys, key, "left_anti")


def merged(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target after the insert-only merge of ``batch``; existing rows stay as they are."""
    return target.unionByName(insert_if_absent(target, batch, key))


def orphan_counts(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], foreign_keys: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Facts per foreign-key value that its dimension lacks: (fk, code, facts).

    All keys are counted in one pass over the fact; only the distinct codes are then compared with
    the dimensions, so neither the fact nor a hot code is ever shuffled row by row.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(column).alias("fk"), F.col(column).cast("string").alias("code"))
                for column in foreign_keys
            ]
        )
    ).alias("pair")
    used = (
        fact.select(pairs)
        .select("pair.*")
        .where("code IS NOT NULL")
        .groupBy("fk", "code")
        .agg(F.count("*").alias("facts"))
    )
    known = None
    for column, (dimension, key) in foreign_keys.items():
        members = dimensions[dimension].select(
            F.lit(column).alias("fk"), F.col(key).cast("string").alias("code")
        )
        known = members if known is None else known.unionByName(members)
    return used.join(known, ["fk", "code"], "left_anti")


class OrphanFacts(ValueError):
    """Facts point at dimension members that do not exist."""


def require_no_orphans(orphans: DataFrame) -> None:
    worst = orphans.groupBy("fk").agg(F.sum("facts").alias("facts")).orderBy("fk").collect()
    if worst:
        raise OrphanFacts(", ".join(f"{r['fk']}: {r['facts']}" for r in worst))
