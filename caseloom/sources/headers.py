"""Header normalisation and mapping of raw extracts onto the staging columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw column -> staging column, daily extracts (after ``basic_header``).
DAILY_COLUMNS = {
    "dr_no": "dr_no",
    "area": "area_id",
    "area_name": "area_name",
    "crm_cd": "crm_cd",
    "crm_cd_desc": "crm_cd_desc",
    "status": "status_id",
    "status_desc": "status_desc",
    "premis_cd": "premis_id",
    "premis_desc": "premis_desc",
    "weapon_used_cd": "weapon_id",
    "weapon_desc": "weapon_desc",
    "date_occ": "date_occ",
    "time_occ": "time_occ",
    "vict_age": "vict_age",
    "lat": "lat",
    "lon": "lon",
}

# Additional spellings accepted for research extracts (after ``snake_header``).
RESEARCH_COLUMNS = {
    **DAILY_COLUMNS,
    "drno": "dr_no",
    "dateocc": "date_occ",
    "timeocc": "time_occ",
    "victage": "vict_age",
    "vict_sex": "vict_sex",
    "victsex": "vict_sex",
    "vict_descent": "vict_descent",
    "victdescent": "vict_descent",
}

# Second spellings of historical headers (after ``alphanumeric_header``); every staging
# column is also found under its own name without underscores.
HISTORICAL_ALIASES = {
    "area": "area_id",
    "premiscd": "premis_id",
    "weaponusedcd": "weapon_id",
    "status": "status_id",
}


def basic_header(name: str) -> str:
    return name.lower().replace(" ", "_")


def snake_header(name: str) -> str:
    return basic_header(name.strip()).replace("-", "_")


def alphanumeric_header(name: str) -> str:
    """Letters and digits only, so blanks, punctuation and a byte order mark all vanish."""
    return re.sub("[^a-z0-9]", "", name.lower())


def historical_columns(targets: Sequence[str]) -> dict[str, str]:
    return {**{alphanumeric_header(t): t for t in targets}, **HISTORICAL_ALIASES}


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalise_headers(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def map_columns(
    df: DataFrame,
    mapping: Mapping[str, str],
    rule: Callable[[str], str] = str,
    keep_unmapped: bool = False,
) -> DataFrame:
    """Rename by ``mapping[rule(header)]``; absent targets are simply missing from the result.

    Several headers may hit one target (raw and cleaned spelling side by side); the first non-null
    value in header order wins, so no duplicate columns can arise.  Targets come in mapping order,
    unmapped columns (only with ``keep_unmapped``) after them in header order.
    """
    sources: dict[str, list[Column]] = {}
    rest: dict[str, list[Column]] = {}
    for header in df.columns:
        name = rule(header)
        bucket = sources if name in mapping else rest
        bucket.setdefault(mapping.get(name, name), []).append(_quoted(header))
    ordered = [t for t in dict.fromkeys(mapping.values()) if t in sources]

    def pick(found: list[Column]) -> Column:
        return F.coalesce(*found) if len(found) > 1 else found[0]

    columns = [pick(sources[t]).alias(t) for t in ordered]
    if keep_unmapped:
        columns += [pick(found).alias(name) for name, found in rest.items() if name not in sources]
    return df.select(*columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order; missing ones as typed NULLs."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def ensure_columns(df: DataFrame, names: Sequence[str], kind: str = "string") -> DataFrame:
    """Add the columns that are not there yet as typed NULLs."""
    missing = {n: F.lit(None).cast(kind) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df
