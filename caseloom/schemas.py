"""Fixed schemas: staging, star schema, audit trail, model tables."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """'name KIND, ...' to a schema, without needing a running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# The staging layout, 25 columns in this order.
STAGING_COLUMNS = (
    "dr_no", "date_rptd", "date_occ", "time_occ", "area_id", "area_name", "rpt_dist_no", "part_1_2",
    "crm_cd", "crm_cd_desc", "mocodes", "vict_age", "vict_sex", "vict_descent", "premis_id",
    "premis_desc", "weapon_id", "weapon_desc", "status_id", "status_desc", "crm_cd_1", "location",
    "cross_street", "lat", "lon",
)
NUMERIC_STAGING_COLUMNS = ("vict_age", "lat", "lon")

STAGING = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in NUMERIC_STAGING_COLUMNS else T.StringType())
        for c in STAGING_COLUMNS
    ]
)

# The star schema.
TABLES: dict[str, T.StructType] = {
    name: _struct(ddl)
    for name, ddl in {
        "dim_area": "area_id STRING, area_name STRING",
        "dim_crime": "crm_cd STRING, crm_cd_desc STRING",
        "dim_status": "status_id STRING, status_desc STRING",
        "dim_premise": "premis_id STRING, premis_desc STRING",
        "dim_weapon": "weapon_id STRING, weapon_desc STRING",
        "dim_date": "date_id DATE, year INT, month INT, day INT, day_of_week INT, quarter INT",
        "dim_time": "time_id INT, hour INT, time_of_day STRING",
        "fact_crime": (
            "dr_no STRING, date_occ DATE, time_occ INT, area_id STRING, crm_cd STRING, "
            "status_id STRING, premis_id STRING, weapon_id STRING, lat DOUBLE, lon DOUBLE, "
            "vict_age DOUBLE"
        ),
    }.items()
}

PRIMARY_KEYS = {
    "dim_area": "area_id",
    "dim_crime": "crm_cd",
    "dim_status": "status_id",
    "dim_premise": "premis_id",
    "dim_weapon": "weapon_id",
    "dim_date": "date_id",
    "dim_time": "time_id",
    "fact_crime": "dr_no",
}

# fact column -> (dimension, dimension key)
FOREIGN_KEYS = {
    "area_id": ("dim_area", "area_id"),
    "crm_cd": ("dim_crime", "crm_cd"),
    "status_id": ("dim_status", "status_id"),
    "premis_id": ("dim_premise", "premis_id"),
    "weapon_id": ("dim_weapon", "weapon_id"),
    "date_occ": ("dim_date", "date_id"),
    "time_occ": ("dim_time", "time_id"),
}

# The member every dimension starts with; facts without a code point at it.
UNKNOWN_MEMBERS = {
    "dim_area": ("0", "Unknown Area"),
    "dim_crime": ("0", "Unknown Crime"),
    "dim_status": ("XX", "Unknown Status"),
    "dim_premise": ("0", "Unknown Premise"),
    "dim_weapon": ("0", "Unknown Weapon"),
}

AUDIT = _struct(
    "ts TIMESTAMP, flow STRING, task STRING, status STRING, logical_date DATE, "
    "log_url STRING, error_message STRING"
)
MODEL_REGISTRY = _struct("model_name STRING, created_at TIMESTAMP, path STRING")
MODEL_METRICS = _struct(
    "model_name STRING, created_at TIMESTAMP, mae DOUBLE, rmse DOUBLE, training_rows INT"
)
HOLDOUT_FORECASTS = _struct("model_name STRING, created_at TIMESTAMP, ds DATE, y DOUBLE, yhat DOUBLE")
